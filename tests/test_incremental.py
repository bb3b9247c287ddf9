"""Batch runs over new files only, and the keyed table."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ladle.sinks.keyed import KeyedTable
from ladle.sources.manifest import IncrementalJob


def land(folder, name, rows):
    (folder / name).write_text("id,v\n" + "".join(f"{i},{v}\n" for i, v in rows))


def job(spark, tmp_path, **more):
    (tmp_path / "in").mkdir(exist_ok=True)
    name = f"default.inc_{uuid.uuid4().hex[:10]}"
    return IncrementalJob(spark, str(tmp_path / "in"), name, f"{name}_files", **more)


def rows(spark, j):
    return sorted((r.id, r.v) for r in spark.read.table(j.table).collect())


def test_each_run_takes_only_new_files(spark, tmp_path):
    j = job(spark, tmp_path)
    assert j.run() == []
    land(tmp_path / "in", "a.csv", [(1, "x"), (2, "y")])
    (tmp_path / "in" / "empty-file-object").write_text("")
    assert [o["rows_written"] for o in j.run()] == [2]
    assert j.run() == []
    land(tmp_path / "in", "b.csv", [(3, "z")])
    land(tmp_path / "in", "c.csv", [(4, "z")])
    assert [o["rows_written"] for o in j.run()] == [2]
    assert rows(spark, j) == [("1", "x"), ("2", "y"), ("3", "z"), ("4", "z")]
    land(tmp_path / "in", "b.csv", [(3, "z"), (5, "new")])  # written anew: it is taken again
    j.run()
    assert rows(spark, j)[2:] == [("3", "z"), ("3", "z"), ("4", "z"), ("5", "new")]


def test_batches_are_bounded(spark, tmp_path):
    j = job(spark, tmp_path, max_files=2)
    for i in range(5):
        land(tmp_path / "in", f"{i}.csv", [(i, "x")])
    assert [o["rows_written"] for o in j.run()] == [2, 2, 1]
    assert len(rows(spark, j)) == 5


@pytest.mark.parametrize("where", ["before", "after"])
def test_a_run_that_breaks_off_is_repeated_with_its_files(spark, tmp_path, monkeypatch, where):
    import ladle.sources.manifest as m
    j, real = job(spark, tmp_path), m.run_recipe_job
    land(tmp_path / "in", "a.csv", [(1, "x"), (2, "y")])

    def broken(*a, **k):
        if where == "after":
            real(*a, **k)  # the rows are written, but the batch is not done
        raise RuntimeError("lost")

    monkeypatch.setattr(m, "run_recipe_job", broken)
    with pytest.raises(RuntimeError):
        j.run()
    monkeypatch.setattr(m, "run_recipe_job", real)
    land(tmp_path / "in", "b.csv", [(3, "z")])  # comes between: a batch of its own
    assert [o["rows_written"] for o in j.run()] == [2, 1]
    assert rows(spark, j) == [("1", "x"), ("2", "y"), ("3", "z")]
    assert j.run() == []


def test_a_failed_recipe_leaves_the_batch_open(spark, tmp_path):
    j = job(spark, tmp_path, recipe=[{"Action": {"Operation": "MASK_RANGE", "Parameters": {"sourceColumns": "[\"gone\"]", "firstN": "1"}}}])
    land(tmp_path / "in", "a.csv", [(1, "x")])
    assert [o["state"] for o in j.run()] == ["FAILED"]
    j.recipe = None
    assert [o["state"] for o in j.run()] == ["SUCCEEDED"] and rows(spark, j) == [("1", "x")]


# ---- keyed table ----------------------------------------------------------------

SCHEMA = "k string, at long, v string"


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_last_write_wins_over_batches(spark, tmp_path):
    rng = random.Random(2)
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"], buckets=7)
    with pytest.raises(FileNotFoundError):
        t.read()
    want = {}
    for batch in range(4):
        data = [(rng.choice([None, *"abcdefghij"]), rng.choice([None, *range(20)]), f"{batch}.{i}") for i in range(30)]
        # rows of one batch that tie in key and order: any may stay, so there are none
        data = list({(k, at): (k, at, v) for k, at, v in data}.values())
        t.upsert(spark.createDataFrame(data, SCHEMA).repartition(3), f"b{batch}")
        for k, at, v in data:
            if k not in want or (at is not None, at or 0) >= (want[k][0] is not None, want[k][0] or 0):
                want[k] = (at, v)
    assert {r.k: (r.at, r.v) for r in t.read().collect()} == want and t.read().count() == len(want)
    before = files(tmp_path / "t")
    assert t.upsert(spark.createDataFrame([("a", 99, "again")], SCHEMA), "b2") == 4  # a batch that was applied already
    assert files(tmp_path / "t") == before


def test_untouched_files_keep_their_names(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"], buckets=8)
    t.upsert(spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("at"), F.lit("old").alias("v")))
    first = {f.split("/data/")[1] for d in t._current()[1].values() for f in files(tmp_path / "t" / d)}
    t.upsert(spark.createDataFrame([("7", 2, "new"), ("7", 1, "older")], SCHEMA))
    second = {f.split("/data/")[1] for d in t._current()[1].values() for f in files(tmp_path / "t" / d)}
    assert len(first) == len(second) == 8 and len(first & second) == 7
    assert files(tmp_path / "t" / "data") == {str(tmp_path / "t" / "data" / f) for f in first | second}
    assert {r.v for r in t.read().where("k = '7'").collect()} == {"new"} and t.read().count() == 200


def test_a_broken_upsert_leaves_the_version_before(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"], buckets=2)
    t.upsert(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    bad = spark.createDataFrame([("a", 2, "y")], SCHEMA).withColumn("v", F.raise_error("stop").cast("string"))
    with pytest.raises(Exception, match="stop"):
        t.upsert(bad)
    assert [tuple(r) for r in t.read().collect()] == [("a", 1, "x")]
    t.upsert(spark.createDataFrame([("b", 1, "z", 5)], SCHEMA + ", more int"))  # a batch with one column more
    assert sorted(map(tuple, t.read().select("k", "v", "more").collect())) == [("a", "x", None), ("b", "z", 5)]
    t.upsert(spark.createDataFrame([], SCHEMA))
    assert t.read().count() == 2
