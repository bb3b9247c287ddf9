"""Quality classifier by importance resampling.

Two generative models of hashed n-grams (single tokens and pairs, in
``BUCKETS`` buckets; all pairs of a token with itself share one) are counted:
the target model over labelled documents of good quality, the raw model over
all documents.  The target model is mixed with a share ``BACKOFF`` of the raw
one, so n-grams it has not seen have a bounded cost.  A document's log
importance is the sum over its n-grams of ``log p_target - log p_raw``; a
labelled good document is left out of the target model when it is scored.

Long documents have larger sums, so the weight that is sampled is the sum
above ``tau`` per n-gram plus the labels' log odds of good to bad,
``w = sum - tau * n + odds``; ``tau`` is set on the labelled rows where the two
classes are best told apart.  Documents are drawn
without replacement with probability proportional to ``exp(w / temperature)``:
each gets the key ``w / temperature + Gumbel noise`` and the ``k`` largest keys
are the sample, ``k`` being the number of documents with ``w >= 0``.  Documents
outside the sample are rejected.

Labels: at most ``LABEL_ROWS`` labelled rows are used, by a hash of the id
(16 bytes each, broadcast); the raw model, all scores and the sample cover
all documents.  The k-th largest key is found by histograms, not by a sort.

Defined cases: null or empty texts have no n-gram and are rejected; null ids have no label; an id with several labels counts as bad
if one is; the noise depends on id and text, so rows that repeat both are
kept or rejected together; without good labels
all ratios, tau and odds are 0 (nothing with a token is rejected), without bad
ones tau is the lowest good score;
other columns are kept by ``keep_good`` and ignored by ``scores``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import saved
from ladle.llm.mixing import cut, tie_break

BUCKETS = 1 << 16
LABEL_ROWS = 200_000
TEMPERATURE = 0.25
BACKOFF = 0.05
SEED = 42
MEMO = 150_000
GRID = 2_000  # bins of the mean log ratio from -10 to 10
TOKEN = regex.compile(r"\w+|[^\w\s]+")

#: Hash of every pair of a token with itself.
REPEAT = np.uint64(0x517CC1B727220A95)

GOOD, BAD, UNKNOWN = 1, 0, -1


class Grams:
    """Hashed n-grams of a text; token hashes are kept in a bounded memo."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int64)
        tokens = TOKEN.findall(text.lower())
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for t in set(tokens).difference(memo):
            memo[t] = zlib.crc32(t.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
        with np.errstate(over="ignore"):
            pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xBF58476D1CE4E5B9)
            pair[h[:-1] == h[1:]] = REPEAT
            one = h * np.uint64(0x94D049BB133111EB)
        return (np.concatenate([one, pair]) >> np.uint64(48)).astype(np.int64)


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """(id, t, cls, b): all rows with class 1, 0 or -1 (not labelled), and a tie-break."""
    good = (F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)
    known = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("lid"))
             .agg(good.cast("int").alias("cls")).orderBy(F.xxhash64("lid", F.lit(SEED))).limit(LABEL_ROWS))
    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), tie_break(F.col(key), F.col(text)).alias("b"))
    return d.join(F.broadcast(saved(known, "labels")), F.col("id") == F.col("lid"), "left").select(
        "id", "t", "b", F.coalesce("cls", F.lit(UNKNOWN)).alias("cls"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = Grams()
    counts = np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        for t, c in zip(b.column(0), b.column(1).to_pylist()):
            own = np.bincount(grams(t.as_py()), minlength=BUCKETS)
            counts[0] += own
            if c == GOOD:
                counts[1] += own
    model, bucket = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(model), pa.array(bucket), pa.array(counts[model, bucket])],
                                     ["model", "bucket", "n"])


def models(rows: DataFrame) -> np.ndarray:
    """Counts of every bucket in all (0) and in good (1) documents; at most 2 x BUCKETS sums reach the driver."""
    sums = rows.select("t", "cls").mapInArrow(_count, "model long, bucket long, n long").groupBy("model", "bucket").agg(
        F.sum("n").alias("n"))
    counts = np.zeros((2, BUCKETS))
    for r in sums.toLocalIterator():
        counts[r.model, r.bucket] = r.n
    return counts


def log_ratio(grams: np.ndarray, counts: np.ndarray, sums: np.ndarray, own: bool) -> float:
    """Sum of log p_target - log p_raw; ``own``: the document is one of the target's and is left out of it."""
    raw, good, total = counts[0][grams] / sums[0], counts[1][grams], sums[1]
    if own:
        _, back, n = np.unique(grams, return_inverse=True, return_counts=True)
        good, total = good - n[back], total - len(grams)
    if total <= 0:
        return 0.0
    return float(np.log((good / total + BACKOFF * raw) / (1 + BACKOFF) / raw).sum())


def _scorer(counts: np.ndarray):
    sums = counts.sum(axis=1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in batches:
            sizes, ratios = [], []
            for t, c in zip(b.column(1), b.column(3).to_pylist()):  # one document's n-grams at a time
                g = grams(t.as_py())
                sizes.append(len(g))
                ratios.append(log_ratio(g, counts, sums, c == GOOD) if len(g) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(sizes, pa.int64()), pa.array(ratios, pa.float64())],
                ["id", "b", "cls", "n_grams", "log_ratio"])

    return work


def fit(scored: DataFrame) -> tuple[float, float]:
    """(tau, odds): log odds of the labelled classes, and the mean that then best tells them apart."""
    labelled = scored.where("cls >= 0 and n_grams > 0")
    n = {r.cls: r["count"] for r in labelled.groupBy("cls").count().collect()}
    if not n.get(GOOD):
        return 0.0, 0.0
    odds = max(math.log(n[GOOD] / n[BAD]), 0.0) if n.get(BAD) else 0.0
    mean = (F.col("log_ratio") + odds) / F.col("n_grams")
    at = F.least(F.greatest(F.floor((mean + 10) * (GRID / 20)), F.lit(0)), F.lit(GRID - 1))
    hist = np.zeros((2, GRID))
    for r in labelled.groupBy("cls", at.alias("bin")).count().collect():
        hist[r.cls, int(r.bin)] = r["count"]
    lost = np.concatenate([[0], np.cumsum(hist[GOOD])]) / n[GOOD]  # good rows below each edge
    if not n.get(BAD):
        return float(np.flatnonzero(hist[GOOD])[0] * 20 / GRID - 10), odds
    kept = 1 - np.concatenate([[0], np.cumsum(hist[BAD])]) / n[BAD]
    cost = GOOD_WEIGHT * lost + kept
    best = np.flatnonzero(cost == cost.min())
    return float(best[len(best) // 2] * 20 / GRID - 10), odds


#: Losing a good document costs so many times keeping a bad one.
GOOD_WEIGHT = 20.0


def gumbel(b: Column) -> Column:
    return -F.log(-F.log((b.cast("double") + 0.5) / F.lit(float(1 << 52))))


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_grams, log_ratio, weight, sample_key and rejected of every row (and its tie-break ``b``)."""
    rows = _labelled(docs, labels, key, text)
    counts = models(rows)
    scored = saved(rows.select("id", "t", "b", "cls").mapInArrow(
        _scorer(counts), "id long, b long, cls int, n_grams long, log_ratio double"), "quality-scores")
    tau, odds = fit(scored)
    weight = F.col("log_ratio") - F.lit(tau) * F.col("n_grams") + F.lit(odds)
    keyed = (scored.withColumn("weight", weight).withColumn("sample_key", F.col("weight") / TEMPERATURE + gumbel(
        F.shiftrightunsigned(F.xxhash64("b", F.lit(SEED)), 12))))
    # a falling 52-bit image of the key: 2 / pi * atan keeps the order and is finest near zero
    a = F.floor((F.lit(0.5) - F.atan(F.col("sample_key") / 1000.0) / math.pi) * F.lit(float((1 << 52) - 1))).cast("long")
    ranked = keyed.withColumn("a", a).withColumn("all", F.lit("all"))
    k = keyed.where("n_grams > 0 and weight >= 0").count()
    need = docs.sparkSession.createDataFrame([("all", float(k))], "all string, need double")
    once = ranked.where("n_grams > 0").groupBy("all", "a", "b").agg(F.count(F.lit(1)).alias("size"))  # repeated rows as one
    at = cut(once, need, key="all").first()
    inside = F.lit(False) if at is None or not k else (F.col("n_grams") > 0) & (
        (F.col("a") < at.cut_a) | ((F.col("a") == at.cut_a) & (F.col("b") <= at.cut_b)))
    return ranked.select(F.col("id").alias(key), "n_grams", "log_ratio", "weight", "sample_key", (~inside).alias("rejected"), "b")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rejected rows; only ids and tie-breaks of rejected rows are joined."""
    s = scores(docs, labels, key, text)
    out = saved(s.where("rejected").select(F.col(key).cast("long").alias("__id"), F.col("b").alias("__b")).distinct(), "rejected")
    if not (n := out.count()):
        return docs
    side = F.broadcast(out) if n <= BROADCAST_ROWS else out
    own = tie_break(F.col(key), F.col(text))
    return (docs.withColumn("__tie", own).join(side, F.col(key).cast("long").eqNullSafe(F.col("__id")) & (
        F.col("__tie") == F.col("__b")), "left_anti").select(*docs.columns))


BROADCAST_ROWS = 1_000_000  # of 16 bytes each
