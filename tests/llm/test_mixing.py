import random

import pytest
from pyspark.sql import functions as F

from ladle.llm import mixing as mx
from ladle.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, make  # noqa: F401


def slow_targets(sizes):
    """Reshare the excess round by round."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = budget - sum(2 * sizes[s] for s in full)
        total = sum(w[s] for s in names if s not in full)
        t = {s: 2 * sizes[s] if s in full else left * w[s] / total for s in names}
        over = {s for s in names if s not in full and t[s] >= 2 * sizes[s]}
        if not over:
            return t
        full |= over
        if len(full) == len(names):
            return {s: 2.0 * sizes[s] for s in names}


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_resharing(spark, seed):
    r = random.Random(seed)
    sizes = {s: r.choice([0, r.randrange(1, 10 ** r.randrange(1, 7))]) for s in [None, "b", "a", "é", "Z", "aa", "z"]}
    if not sum(sizes.values()):
        sizes["a"] = 5
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {x.source: x.target for x in mx.targets(df).collect()}
    want = slow_targets(sizes)
    assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for s in sizes)


def check(rows, docs):
    per = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0) <= (r.taken == 0)
        x = per.setdefault(r.source, [0, 0.0, 0])
        x[0] += r.taken
        x[1] = r.target
        x[2] = max(x[2], r.size)
    for taken, target, largest in per.values():
        assert abs(taken - target) <= largest / 2 + 1e-6


def with_source(plan, docs):
    return plan.join(docs.select("doc_id", "source").distinct(), "doc_id").collect()


def test_every_source_meets_its_target(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first = QUERIES["op6_pareto_mix"](spark, SF_SMALL)
    check(with_source(first, docs), docs)
    assert sorted(first.collect()) == sorted(QUERIES["op6_pareto_mix"](spark, SF_SMALL).collect())


def test_hot_source_and_repeated_rows(spark, make, monkeypatch):
    monkeypatch.setattr(mx, "FINAL_ROWS", 10)  # the cut goes down to the tie-break's digits
    rows = [(1, "the same row again", "en", "hot")] * 300 + [(i, "w " * (i % 7 + 1), "en", f"s{i % 5}") for i in range(2, 300)]
    docs = make(rows, 4)
    got = mx.plan(docs).collect()
    assert len(got) == len(rows)
    hot = [r for r in got if r.doc_id == 1]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 2
    check(with_source(mx.plan(docs.where("doc_id > 1")), docs), docs)


def test_odd_rows_and_mix(spark, make):
    docs = make([(*r, "en", None if i % 4 == 0 else f"s{i % 3}") for i, r in enumerate(ODD)], 1)
    plan = mx.plan(docs).collect()
    assert len(plan) == len(ODD)
    mixed = mx.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.agg(F.sum(mx.words("text"))).first()[0] == sum(r.taken for r in plan)
    assert mx.plan(docs.limit(0)).count() == 0 and mx.mix(docs.limit(0)).count() == 0


def test_weights_tilt_the_sample(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("s").alias("source"),
                                    F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("grade"))
    got = mx.plan(docs, share=0.5, weight="grade").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n")).collect()
    n = {r.odd: r.n for r in got}
    assert abs(n[0] + n[1] - 2000) <= 1 and 2.4 < n[0] / n[1] < 3.7


def test_cut_equals_a_sort(spark, monkeypatch):
    monkeypatch.setattr(mx, "FINAL_ROWS", 3)
    r = random.Random(3)
    rows = [(f"k{r.randrange(3)}", r.choice([5, 9, r.randrange(1 << 52)]), r.randrange(1 << 52), r.randrange(9)) for _ in range(400)]
    need = {"k0": 100.0, "k1": 0.0, "k2": 1e9}
    df = spark.createDataFrame(rows, "source string, a long, b long, size long")
    cuts = {x.source: (x.cut_a, x.cut_b) for x in mx.cut(df, spark.createDataFrame(list(need.items()), "source string, need double")).collect()}
    for k in need:
        own, run, want = sorted(x[1:] for x in rows if x[0] == k), 0, []
        for a, b, s in own:
            if run + s / 2 <= need[k]:
                want.append((a, b))
            run += s
        assert [x[:2] for x in own if x[:2] <= cuts[k]] == want


def test_repeated_ids_are_mixed_alike_however_rows_are_split(spark, make):
    """Rows that share an id, and rows that are alike, over 3 and 7 partitions: the same rows are taken."""
    r = random.Random(8)
    rows = [(r.randrange(40), "w " * r.randrange(1, 30), "en", r.choice("abc")) for _ in range(1500)]
    rows += [(7, "same text", "en", "a")] * 400 + [(8, "x", "en", r.choice("ab")) for _ in range(60)]

    def taken(parts):
        r.shuffle(rows)
        return sorted((x.doc_id, x.size, round(x.target, 6), x.taken) for x in mx.plan(make(rows, parts)).collect())

    def mixed(parts):
        return sorted((x.doc_id, x.text, x.source) for x in mx.mix(make(rows, parts)).collect())

    assert taken(3) == taken(7)
    assert mixed(3) == mixed(7)
