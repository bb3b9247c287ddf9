"""Command line: run a recipe job, a profile job, or watch a landing prefix.

    python -m ladle run --landing PATH --table DB.T --recipe FILE [--format F] [--upload-type U]
    python -m ladle profile --landing PATH --report PATH [--format F]
    python -m ladle watch --landing PATH --table DB.T --outcomes DB.O --checkpoint PATH --recipe FILE [--messages PATH]

Keys for encryption and hashing steps are read from files named in
``--secret ID=FILE`` (one per key id), never from the command line itself.
"""

from __future__ import annotations

import argparse
import json
import sys

from ladle.plans.recipe import RecipeContext, load_recipe
from ladle.session import build_session


def _ctx(args) -> RecipeContext:
    secrets = {}
    for item in args.secret or []:
        key_id, _, path = item.partition("=")
        with open(path, "rb") as f:
            secrets[key_id] = f.read()  # the whole file: a key may hold any byte
    return RecipeContext(secrets=secrets, seed=args.seed,
                         day_first_when_ambiguous=args.day_first_when_ambiguous)


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="ladle")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("run", "profile", "watch"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=True)
        s.add_argument("--format", default="CsvWithHeaderRow")
        s.add_argument("--upload-type", default="Incremental")
        if name in ("run", "watch"):
            s.add_argument("--table", required=True)
            s.add_argument("--table-location")
            s.add_argument("--recipe")
            s.add_argument("--secret", action="append")
            s.add_argument("--seed", type=int, default=42)
            s.add_argument("--day-first-when-ambiguous", action="store_true")
        if name == "run":
            s.add_argument("--manifest", help="table of the files taken in; only new files are read")
        if name == "profile":
            s.add_argument("--report", required=True)
        if name == "watch":
            s.add_argument("--outcomes", required=True)
            s.add_argument("--checkpoint", required=True)
            s.add_argument("--quiet-seconds", type=float, default=60)
            s.add_argument("--messages", help="folder of queue messages about landed files; runs are launched by them")
            s.add_argument("--rejects", help="table of the messages' records that cannot be used (with --messages)")
            s.add_argument("--max-files", type=int, default=30, help="files taken in per trigger; more wait for the next")
    args = p.parse_args(argv)
    spark = spark or build_session()
    if args.cmd == "run" and args.manifest:
        from ladle.sources.manifest import IncrementalJob
        job = IncrementalJob(spark, args.landing, args.table, args.manifest, load_recipe(spark, args.recipe), _ctx(args), args.format,
                             args.table_location)
        out = job.run()
        print(json.dumps(out, default=str))
        return 0 if all(o["state"] == "SUCCEEDED" for o in out) else 1
    if args.cmd == "run":
        from ladle.plans.job import run_recipe_job
        out = run_recipe_job(spark, args.landing, args.table, load_recipe(spark, args.recipe), _ctx(args),
                             args.format, args.upload_type, args.table_location)
        print(json.dumps(out, default=str))
        return 0 if out["state"] == "SUCCEEDED" else 1
    if args.cmd == "profile":
        from ladle.plans.job import run_profile_job
        _, _, path = run_profile_job(spark, args.landing, args.report, args.format, args.upload_type)
        print(json.dumps({"report": path}))
        return 0
    from ladle.streaming.connector import Connector, NotifiedConnector
    if args.messages:
        n = NotifiedConnector(spark, args.messages, args.landing, args.table, args.outcomes, args.rejects or f"{args.table}_rejects",
                              args.checkpoint, recipe=load_recipe(spark, args.recipe), ctx=_ctx(args), fmt=args.format,
                              table_location=args.table_location, gap_seconds=args.quiet_seconds, max_files_per_trigger=args.max_files)
        n.start()
        spark.streams.awaitAnyTermination()
        return 0
    c = Connector(spark, args.landing, args.table, args.outcomes, args.checkpoint,
                  recipe=load_recipe(spark, args.recipe), ctx=_ctx(args), fmt=args.format,
                  upload_type=args.upload_type, table_location=args.table_location, gap_seconds=args.quiet_seconds,
                  max_files_per_trigger=args.max_files)
    c.start().awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
