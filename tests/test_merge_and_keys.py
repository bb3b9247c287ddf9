"""Profiles merged from sketches, key rings, single flight on a hot key."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ladle.operators.crypto import decrypt, decrypt_ring, encrypt
from ladle.operators.profile import merge_profiles, profile, profile_sketches
from ladle.sinks.tables import read_sketches, write_sketches
from ladle.streaming import flight

SCHEMA = "i int, d double, m decimal(20,2), s string, day date, flag boolean, l array<int>, b binary, none string"


def _rows(n, seed):
    rng = random.Random(seed)
    day = lambda: f"20{rng.randint(10, 30)}-0{rng.randint(1, 9)}-11"
    return [(rng.choice([None, rng.randint(-500, 500)]), rng.choice([None, rng.gauss(5, 3), 0.0, -0.0]), str(rng.randint(-999, 999)),
             rng.choice([None, "", f"é{rng.randint(0, 400)}"]), day(), rng.choice([True, None]), [rng.randint(0, 9)], bytes([rng.randint(0, 9)]), None)
            for _ in range(n)]


def _frame(spark, rows):
    text = SCHEMA.replace("decimal(20,2)", "string").replace("day date", "day string")
    return spark.createDataFrame(rows, text).withColumns({"m": F.col("m").cast("decimal(20,2)"), "day": F.col("day").cast("date")})


def test_merged_profile_equals_the_profile_of_all(spark, tmp_path):
    parts = [_rows(700, 1), _rows(1, 2), [], _rows(300, 3)]
    for i, rows in enumerate(parts):
        write_sketches(profile_sketches(_frame(spark, rows)), str(tmp_path), str(i))
    write_sketches(profile_sketches(_frame(spark, parts[3])), str(tmp_path), "3")  # a drop profiled again
    got = {r.column_name: r for r in merge_profiles(read_sketches(spark, str(tmp_path)), quantiles=[0.0, 0.5, 1.0]).collect()}
    whole = _frame(spark, sum(parts, []))
    want = {r.column_name: r for r in profile(whole, exact_distinct=True).collect()}
    assert set(got) == set(want)
    for c, w in want.items():
        g = got[c]
        assert (g.data_type, g.n_rows, g.n_null) == (w.data_type, w.n_rows, w.n_null)
        assert abs(g.n_distinct - w.n_distinct) <= max(1, 0.05 * w.n_distinct)
        if c not in ("l", "b"):
            assert (g.min_value, g.max_value) == (w.min_value, w.max_value), c
        for x, y in ((g.mean, w.mean), (g.stddev, w.stddev)):
            assert (x is None) == (y is None) and (x is None or math.isclose(float(x), float(y), rel_tol=1e-9 if c != "m" else 1e-6)), c  # an average of decimals is a decimal
    d = sorted(r[1] for r in sum(parts, []) if r[1] is not None)
    low, mid, high = got["d"].quantiles
    assert (low, high) == (d[0], d[-1])
    assert np.searchsorted(d, mid) <= 0.55 * len(d) and np.searchsorted(d, mid, side="right") >= 0.45 * len(d)
    assert got["s"].quantiles is None


def test_columns_that_some_parts_lack_and_empty_parts(spark):
    a = spark.createDataFrame([(1, "x"), (3, "y")], "n int, s string")
    b = spark.createDataFrame([(5,)], "n int")
    got = {r.column_name: r for r in merge_profiles(profile_sketches(a).unionByName(profile_sketches(b))).collect()}
    assert (got["n"].n_rows, got["n"].mean, got["n"].stddev, got["n"].max_value) == (3, 3.0, 2.0, "5")
    assert (got["s"].n_rows, got["s"].n_distinct, got["s"].mean) == (2, 2, None)
    (r,) = merge_profiles(profile_sketches(a.limit(0).select("n")), quantiles=[0.5]).collect()
    assert (r.n_rows, r.n_null, r.n_distinct, r.min_value, r.mean, r.stddev) == (0, 0, 0, None, None, None)


def test_key_ring_finds_each_value_its_key(spark):
    k = [bytes([i]) * 32 for i in range(5)]
    df = spark.createDataFrame([(i, None if i == 6 else f"väl{i}") for i in range(8)], "i int, v string")
    enc = (F.when(F.col("i") % 4 == 0, encrypt(spark, F.col("v"), "a", k[0], True)).when(F.col("i") % 4 == 1, encrypt(spark, F.col("v"), "a", k[1], False))
           .when(F.col("i") % 4 == 2, encrypt(spark, F.col("v"), "bé", k[2], True)).otherwise(encrypt(spark, F.col("v"), "c", k[3], True)))
    rows = df.select("i", "v", enc.alias("e"))
    ring = {"a": [k[0], k[1], k[4]], "bé": [k[2]], "c": [k[4]]}  # c's key in the ring is not the one used
    got = {r.i: r.p for r in rows.select("i", decrypt_ring(spark, F.col("e"), ring).alias("p")).collect()}
    assert got == {i: None if i == 6 or i % 4 == 3 else f"väl{i}" for i in range(8)}
    one = {r.i: r.p for r in rows.where("i % 4 = 0").select("i", decrypt(spark, F.col("e"), k[0]).alias("p")).collect()}
    assert one == {0: "väl0", 4: "väl4"}
    assert [r[0] for r in rows.select(decrypt_ring(spark, F.col("e"), {})).collect()] == [None] * 8


def test_key_ring_gives_null_for_anything_else(spark):
    k = bytes(32)
    good = spark.range(1).select(encrypt(spark, F.lit("x"), "a", k, True)).first()[0]
    flipped = good[:-6] + ("A" if good[-6] != "A" else "B") + good[-5:]
    odd = ["", "no base64!", "AQ==", "AQABYQ==", flipped, "Aw" + good[2:], "////", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([good, *odd])], "i int, e string")
    got = [r.p for r in rows.select("i", decrypt_ring(spark, F.col("e"), {"a": [k]}).alias("p")).orderBy("i").collect()]
    assert got == ["x"] + [None] * len(odd)


def _greedy(times, run):
    out, free = [], None
    for t in sorted(times):
        out.append(free is None or t >= free)
        free = t + run if out[-1] else free
    return out


@pytest.mark.parametrize("spacing,run,n", [(1, 60, 20000), (7, 60, 3000), (100, 60, 500), (0, 60, 300), (1, 10**6, 3000)])
def test_evenly_spaced_requests_of_one_key(spark, spacing, run, n):
    """Every chunk's map has no more rows than requests within one run of its start."""
    df = spark.range(n).select(F.lit("k").alias("key"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * spacing).alias("ts"), "id")
    got = flight.single_flight(df, "key", "ts", run, tiebreak="id", chunk_rows=max(50, n // 8))
    marks = [r.started for r in got.orderBy("id").collect()]
    assert marks == _greedy([i * spacing for i in range(n)], run)


def test_a_run_takes_some_time(spark):
    with pytest.raises(ValueError):
        flight.single_flight(spark.range(1).selectExpr("'k' AS key", "timestamp_seconds(id) AS ts"), "key", "ts", 0)


def test_map_rows_are_bounded_by_one_run():
    step = 1_000_000
    chunk = pd.DataFrame({"__key": "k", "__chunk": 0, "__t": np.arange(200_000) * step})
    assert len(flight._exit_map(60 * step)(chunk)) <= 61
    rng = np.random.default_rng(1)
    t = np.sort(rng.integers(0, 10**12, 5000))
    rows = flight._exit_map(60 * step)(pd.DataFrame({"__key": "k", "__chunk": 0, "__t": t}))
    assert len(rows) <= 1 + (t < t[0] + 60 * step).sum()
