"""Sources and sinks: formats, newest file, placeholders, prefixes, entity landing."""

import os
import time

import pytest

from ladle.session import scratch_dir
from ladle.sinks.tables import ensure_database, write_profile, write_single_json, write_table
from ladle.sources.entities import ENTITIES, land_entity, stringify
from ladle.sources.files import check_combination, latest_file, read_inbound


def _local(path: str) -> str:
    return path.replace("file:", "")


def _write(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode())
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_csv_crlf_without_final_newline(spark):
    root = _local(scratch_dir(spark, "t"))
    _write(f"{root}/inbound/a.csv", "email,n\r\njwhite@domain.com,1\r\nmhall@domain.com,2")
    df = read_inbound(spark, f"{root}/inbound/", "CsvWithHeaderRow")
    assert [tuple(r) for r in df.orderBy("n").collect()] == [("jwhite@domain.com", "1"), ("mhall@domain.com", "2")]
    assert dict(df.dtypes) == {"email": "string", "n": "string"}
    nohdr = read_inbound(spark, f"{root}/inbound/", "CSV", column_names=["a", "b"])
    assert nohdr.count() == 3 and nohdr.columns == ["a", "b"]


def test_json_document_and_lines(spark):
    root = _local(scratch_dir(spark, "t"))
    _write(f"{root}/doc/a.json", '[\n {"a": 1,\n  "b": "x"},\n {"a": 2, "b": "y"}\n]')
    _write(f"{root}/lines/a.json", '{"a": 1, "b": "x"}\n{"a": 2, "b": "y"}\n')
    _write(f"{root}/doc/empty-file-object", "")
    _write(f"{root}/lines/empty-file-object", "")
    doc = read_inbound(spark, f"{root}/doc/", "JSON")
    lines = read_inbound(spark, f"{root}/lines/", "JSONMultiLine")
    assert sorted(tuple(r) for r in doc.select("a", "b").collect()) == [(1, "x"), (2, "y")]
    assert sorted(tuple(r) for r in lines.select("a", "b").collect()) == [(1, "x"), (2, "y")]


def test_bulk_reads_newest_file_and_skips_placeholder(spark):
    root = _local(scratch_dir(spark, "t"))
    now = time.time()
    _write(f"{root}/inbound/old.csv", "v\r\nold", now - 100)
    _write(f"{root}/inbound/new.csv", "v\r\nnew", now - 10)
    _write(f"{root}/inbound/empty-file-object", "", now)
    assert latest_file(spark, f"{root}/inbound/").endswith("new.csv")
    assert [r.v for r in read_inbound(spark, f"{root}/inbound/", "CsvWithHeaderRow", "Bulk").collect()] == ["new"]
    inc = read_inbound(spark, f"{root}/inbound/", "CsvWithHeaderRow", "Incremental")
    assert sorted(r.v for r in inc.collect()) == ["new", "old"]


def test_connector_combinations():
    check_combination("pull", "Bulk", "JSONMultiLine")
    check_combination("push", "Incremental", "JSON")
    with pytest.raises(ValueError):
        check_combination("pull", "Incremental", "JSONMultiLine")
    with pytest.raises(ValueError):
        check_combination("push", "Bulk", "Parquet")


def test_entity_landing_and_single_file(spark):
    assert len(ENTITIES) == 23
    df = spark.createDataFrame([("ClickEvent", 1, {"a": 1}), ("OpenEvent", 2, {"a": 2})],
                               "entity string, n int, m map<string,int>")
    out = land_entity(df, "ClickEvent", "entity")
    assert dict(out.dtypes) == {"entity": "string", "n": "string", "m": "string"}
    assert [tuple(r) for r in out.collect()] == [("ClickEvent", "1", '{"a":1}')]
    with pytest.raises(ValueError):
        land_entity(df, "Nope")
    root = scratch_dir(spark, "t")
    write_single_json(out, f"{root}/flow-out")
    files = [f for f in os.listdir(_local(f"{root}/flow-out")) if f.endswith(".json")]
    assert len(files) == 1


def test_table_append_and_profile_location(spark):
    root = scratch_dir(spark, "t")
    ensure_database(spark, "ladle_test")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_table(df, "ladle_test.t1", location=f"{root}/transform/t1")
    write_table(df, "ladle_test.t1", location=f"{root}/transform/t1")
    assert spark.read.table("ladle_test.t1").count() == 2
    from ladle.operators.profile import profile
    out = write_profile(profile(df), f"{root}/transform/t1")
    assert spark.read.json(out).count() == 2


def test_stringify_nested(spark):
    df = spark.createDataFrame([(1, [1, 2], ("x", 2.5))], "a int, b array<int>, c struct<s:string,d:double>")
    assert stringify(df).first().asDict() == {"a": "1", "b": "[1,2]", "c": '{"s":"x","d":2.5}'}


def test_recipe_and_profile_jobs(spark):
    import json
    from ladle.plans.job import run_profile_job, run_recipe_job
    root = _local(scratch_dir(spark, "job"))
    _write(f"{root}/inbound/a.csv", "email,phone\r\njwhite@domain.com,408 496-7223\r\nmhall@domain.com,n/a")
    recipe = json.dumps([{"Action": {"Operation": "MASK_RANGE", "Parameters": {
        "sourceColumns": "[\"email\"]", "firstN": "5", "alphabet": "[\"WHITESPACE\",\"SYMBOLS\"]"}}}])
    name = "ladle_job.t_" + os.path.basename(root).replace("-", "_")
    ok = run_recipe_job(spark, f"{root}/inbound/", name, recipe, table_location=f"{root}/transform/t")
    assert ok["state"] == "SUCCEEDED" and ok["rows_written"] == 2
    bad = run_recipe_job(spark, f"{root}/missing/", name, recipe)
    assert bad["state"] == "FAILED" and bad["cause"]
    prof, ents, out = run_profile_job(spark, f"{root}/inbound/", f"{root}/transform/t")
    assert {r.column_name for r in prof.collect()} == {"email", "phone"}
    found = {(r.column_name, r.entity_type): r.n_matches for r in ents.collect()}
    assert found[("email", "EMAIL")] == 2 and found[("phone", "PHONE_NUMBER")] == 1
    assert spark.read.json(out).count() == 2


def test_table_schema_evolves_across_runs(spark):
    root = scratch_dir(spark, "t")
    ensure_database(spark, "ladle_test")
    name = "ladle_test.evolve_" + os.path.basename(_local(root)).replace("-", "_")
    write_table(spark.createDataFrame([(1, "a")], "id int, v string"), name, location=f"{root}/transform/e")
    write_table(spark.createDataFrame([("b", 2, 9.5)], "v string, id int, extra double"), name)
    write_table(spark.createDataFrame([(3,)], "id int"), name)
    rows = sorted((r.id, r.v, r.extra) for r in spark.read.table(name).collect())
    assert rows == [(1, "a", None), (2, "b", 9.5), (3, None, None)]


def test_command_line_run_and_profile(spark, capsys):
    import json
    from ladle.__main__ import main
    root = _local(scratch_dir(spark, "cli"))
    _write(f"{root}/inbound/a.csv", "email\r\njwhite@domain.com")
    _write(f"{root}/recipe.json", json.dumps([{"Action": {"Operation": "CRYPTOGRAPHIC_HASH", "Parameters": {
        "secretId": "s1", "sourceColumns": "[\"email\"]"}}}]))
    _write(f"{root}/key.bin", "k" * 32)
    table = "ladle_cli.t_" + os.path.basename(root).replace("-", "_")
    rc = main(["run", "--landing", f"{root}/inbound/", "--table", table, "--table-location", f"{root}/transform/t",
               "--recipe", f"{root}/recipe.json", "--secret", f"s1={root}/key.bin"], spark=spark)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 0 and out["rows_written"] == 1
    assert len(spark.read.table(table).first().email) == 44
    assert main(["profile", "--landing", f"{root}/inbound/", "--report", f"{root}/transform/t"], spark=spark) == 0


def _file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_header_is_the_first_record_by_place(spark, tmp_path):
    """A data row may equal its own file's header or another's."""
    _file(tmp_path / "in", "a.csv", "id,name\n1,x\nname,id\nid,name\n2,y\n")
    _file(tmp_path / "in", "b.csv", "name,id\nz,3\nid,name\n")
    _file(tmp_path / "in", "c.csv", "")
    got = read_inbound(spark, str(tmp_path / "in"))
    assert sorted(map(tuple, got.select("id", "name").collect())) == [
        ("1", "x"), ("2", "y"), ("3", "z"), ("id", "name"), ("name", "id"), ("name", "id")]


def test_more_headers_than_any_cap(spark, tmp_path):
    for i in range(60):
        _file(tmp_path / "in", f"{i}.csv", f"id,v{i}\n{i},{i * i}\n")
    got = read_inbound(spark, str(tmp_path / "in"))
    assert len(got.columns) == 61
    assert sorted((int(r.id), [v for k, v in r.asDict().items() if k != "id" and v]) for r in got.collect()) == [
        (i, [str(i * i)]) for i in range(60)]


def test_headers_are_found_without_reading_the_files(spark, tmp_path):
    """Of a file in several splits only the first lines of each split are read."""
    from ladle.sources import files as fs
    _file(tmp_path / "in", "a.csv", "id,name\n" + "".join(f"{i},{'x' * 40}\n" for i in range(60000)))
    _file(tmp_path / "in", "b.csv", "name,id\n" + "".join(f"{'y' * 40},{i}\n" for i in range(1000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        seen = spark.sparkContext.accumulator(0)
        real = fs._first_record

        def counted(multi_line):
            def work(batches):
                def count():
                    for b in batches:
                        seen.add(b.num_rows)
                        yield b
                yield from real(multi_line)(count())
            return work

        fs._first_record = counted
        try:
            heads = {r.file[-5:]: list(r.names) for r in fs.file_headers(spark, str(tmp_path / "in")).collect()}
        finally:
            fs._first_record = real
        assert heads == {"a.csv": ["id", "name"], "b.csv": ["name", "id"]}
        assert 0 < seen.value <= 16 * fs.HEAD_LINES
        assert read_inbound(spark, str(tmp_path / "in")).where("id is not null and length(name) = 40").count() == 61000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("size", ["64", "200", "1k", "64k"])
def test_quoted_line_breaks_over_many_splits(spark, tmp_path, size):
    """A file is cut anywhere, inside quotes too; the rows are those of Spark's reader of whole files."""
    import csv
    import random
    rng = random.Random(7)
    (tmp_path / "in").mkdir()
    rows = []
    for name, columns in (("a.csv", ["id", "note", "x"]), ("b.csv", ["x", "id"])):
        with open(tmp_path / "in" / name, "w", newline="") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(columns)
            for i in range(120):
                note = "".join(rng.choice(['"', "\n", ",", "ab", "é", "\n\n", ' "q" ']) for _ in range(rng.randint(0, 12)))
                note = "long\n" * 90 if i == 60 else note
                row = {"id": f"{name}{i}", "note": note, "x": rng.choice(["", "y", "1\n2"])}
                w.writerow([row[c] for c in columns])
                rows.append((row["id"], row["note"] or None if "note" in columns else None, row["x"] or None))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_inbound(spark, str(tmp_path / "in"), multi_line="split")
        assert got.columns == ["id", "x", "note"] or set(got.columns) == {"id", "x", "note"}
        assert sorted(map(tuple, got.select("id", "note", "x").collect()), key=str) == sorted(rows, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_quoted_split_odd_files(spark, tmp_path):
    _file(tmp_path / "in", "a.csv", 'id,v\r\n1,"two\r\nlines"\r\n')
    _file(tmp_path / "in", "b.csv", "")
    got = read_inbound(spark, str(tmp_path / "in"), multi_line="split").collect()
    assert [(r.id, r.v.replace("\r", "")) for r in got] == [("1", "two\nlines")]
    with pytest.raises(ValueError):
        read_inbound(spark, str(tmp_path / "in"), "JSON", multi_line="split")
    _file(tmp_path / "in", "c.csv", 'id,v\n1,"open\n')
    with pytest.raises(ValueError, match="inside quotes"):
        read_inbound(spark, str(tmp_path / "in"), multi_line="split")
