import numpy as np
import pytest

from ladle.llm import quality as ql
from ladle.llm.queries import QUERIES
from llm_rows import ODD, make  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return QUERIES["op8_quality"](spark, sf_dir).join(labels, "doc_id", "left").toPandas()


def test_labelled_rows_are_told_apart(scored):
    assert len(scored) == 10000
    good, bad = scored[(scored.quality == 1) & (scored.toxic == 0)], scored[scored.quality == 0]
    assert good.rejected.mean() < 0.005 and bad.rejected.mean() > 0.97


def test_sample_is_the_top_k_by_key(scored):
    some = scored[scored.n_grams > 0]
    k = int((some.weight >= 0).sum())
    assert (~scored.rejected).sum() == k
    assert some[~some.rejected].sample_key.min() > some[some.rejected].sample_key.max()
    assert abs(np.mean(some.sample_key - some.weight / ql.TEMPERATURE) - 0.5772) < 0.05  # mean of Gumbel noise


def test_held_out_rows(spark):
    """Labels of every third row are withheld; the rest must still tell those rows apart."""
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = ql.scores(docs, labels.where("doc_id % 3 <> 0")).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good, bad = got[(got.quality == 1) & (got.toxic == 0)], got[got.quality == 0]
    assert good.rejected.mean() < 0.01 and bad.rejected.mean() > 0.95


def test_log_ratio_by_hand():
    counts = np.zeros((2, ql.BUCKETS))
    counts[0, :4], counts[1, :4] = [10, 20, 30, 40], [5, 0, 10, 5]
    g = np.array([0, 1, 1, 3])

    def slow(own):
        n = {0: 1, 1: 2, 3: 1} if own else {}
        total = 20 - (4 if own else 0)
        return sum(np.log((((counts[1, x] - n.get(x, 0)) / total) + 0.05 * counts[0, x] / 100) / 1.05 / (counts[0, x] / 100)) for x in g)

    assert ql.log_ratio(g, counts, counts.sum(axis=1), False) == pytest.approx(slow(False))
    g = np.array([0, 3])
    assert ql.log_ratio(g, counts, counts.sum(axis=1), True) == pytest.approx(
        np.log(((4 / 18) + 0.05 * 0.1) / 1.05 / 0.1) + np.log(((4 / 18) + 0.05 * 0.4) / 1.05 / 0.4))


def test_odd_rows(spark, make):
    docs = make(ODD, 1)
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 0), (9, 1, 0), (None, 1, 1), (8, None, None), (10, 1, None)], LABELS)
    got = ql.scores(docs, labels).collect()
    assert len(got) == len(ODD)
    assert all(r.rejected for r in got if r.doc_id in (1, 2, 3))
    kept = ql.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r.rejected for r in got)
    assert {r.doc_id for r in ql.keep_good(docs, labels.limit(0)).collect()} == {None, 5, 8, 9, 10, -4}
    assert ql.keep_good(docs.limit(0), labels).count() == 0
