"""Document fingerprints: one-permutation MinHash in DataFrame functions only.

* Words are cut at white space and hashed once; a shingle of five words is
  one hash of its five word hashes (fewer words: one shingle of all).
* One permutation: the top 7 bits of a shingle's hash name one of 128 bins,
  and each bin keeps its smallest hash.  Sorting the hashes brings each
  bin's smallest to the front of its stretch.
* Optimal densification: an empty bin ``b`` tries the bins ``a_b + t * c_b``
  (mod 128, ``c_b`` odd, so it reaches all) for t = 0, 1, ... and copies the
  first that is filled.  The probes depend on the bin alone, so equal bins
  are filled alike in all documents.
* The low 8 bits of each bin are stored, as 256 hex digits.  Two unrelated
  bins agree by chance with probability 1/256; the estimate
  ``(matches/128 - 1/256) / (1 - 1/256)`` corrects for that.

``next_fingerprints`` pairs each document with the next in descending id.
Ids are cut into chunks of contiguous order (quantiles, subdivided evenly),
so no task sorts more than a chunk; the first row of each chunk is also
sent to the chunk before, which makes the order one ring.

Defined cases: null text is empty; a text without words has one shingle,
the empty one, so empty texts are alike and unlike others; null ids come
last in descending order; rows of one id are ordered by a hash of the text,
and an id with very many rows is cut by that hash; a single document is its
own next; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import SPACE_WORD, attach_small, saved, text_or_empty, total_bytes

SHINGLE = 5
BINS = 128
BIN_SHIFT = 57  # 64 - log2(BINS)
LOW_BITS = 8
QUANTILES = 64
CHUNK_BYTES = 4 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, though ``body`` uses it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _probes() -> tuple[list[int], list[int]]:
    """Per bin: first bin tried, and the inverse (mod BINS) of the odd step."""
    x, first, inverse = 0x9E3779B97F4A7C15, [], []
    for _ in range(BINS):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        first.append(x >> 40 & BINS - 1)
        inverse.append(pow((x >> 50 & BINS - 1) | 1, -1, BINS))
    return first, inverse


def _longs(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    def hashes(w: Column) -> Column:
        n = F.size(w)
        one = F.array(F.xxhash64(w))
        many = F.transform(F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))),
                           lambda i: F.xxhash64(*[w[i + k] for k in range(shingle)]))
        return F.when(n < shingle, one).otherwise(many)

    words = F.split(F.ltrim(text), r"[\x20\x09-\x0D]+")
    return let(F.transform(words, lambda w: F.xxhash64(w)), hashes)


def fingerprint(text: Column) -> Column:
    """256 hex digits: the low 8 bits of 128 densified bins."""
    bin_of = lambda h: F.shiftrightunsigned(h, BIN_SHIFT).cast("int")
    low = lambda h: h.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    first, inverse = _probes()
    start, step = _longs(first), _longs(inverse)
    digits = _longs([f"{v:02x}" for v in range(1 << LOW_BITS)])

    def smallest(s: Column) -> Column:
        return F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(s[F.greatest(i - 1, F.lit(0))])))

    def dense(f: Column, bins: Column) -> Column:
        def fill(b: Column) -> Column:
            at = F.array_position(bins, b).cast("int")
            tried = F.transform(f, lambda h: F.pmod((bin_of(h) - start[b]) * step[b], F.lit(BINS)).cast("long")
                                * (1 << LOW_BITS) + low(h))
            return F.when(at > 0, low(f[at - 1])).otherwise(low(F.array_min(tried)))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: digits[fill(b).cast("int")]), "")

    return let(F.sort_array(shingle_hashes(text)),
               lambda s: let(smallest(s), lambda f: let(F.transform(f, bin_of), lambda bins: dense(f, bins))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two fingerprints, 0 to 1, corrected for chance matches."""
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)),
                           lambda i: F.substr(a, 2 * i + 1, F.lit(2)) == F.substr(b, 2 * i + 1, F.lit(2))))
    chance = 1.0 / (1 << LOW_BITS)
    return F.greatest((same / F.lit(float(BINS)) - chance) / (1 - chance), F.lit(0.0))


def _case_tree(x: Column, cuts: list, lo: int, hi: int, leaf: Callable[[int], Column]) -> Column:
    """``leaf(number of cuts <= x)`` by binary search in nested conditions."""
    if lo == hi:
        return leaf(lo)
    mid = (lo + hi) // 2
    return F.when(x >= F.lit(cuts[mid]), _case_tree(x, cuts, mid + 1, hi, leaf)).otherwise(_case_tree(x, cuts, lo, mid, leaf))


def chunk_of(d: DataFrame, chunks: int) -> Column:
    """Chunk numbers that ascend with (id, tie) of ``d``; null ids are below all."""
    got = d.where("id is not null").agg(F.percentile_approx(
        "id", [i / QUANTILES for i in range(QUANTILES + 1)], 10_000)).first()[0]
    if not got:
        return F.lit(0).cast("long")
    cuts = sorted(set(got))
    parts = max(1, -(-chunks // QUANTILES))
    weight = {c: got.count(c) for c in cuts}  # an id that is several quantiles has that share of the rows

    def even(x: Column, lo: float, hi: float, n: int) -> Column:
        return F.least(F.greatest(F.floor((x.cast("double") - lo) / (hi - lo) * n), F.lit(0)), F.lit(n - 1)).cast("long")

    def leaf(k: int) -> Column:
        if k == 0:
            return F.lit(0).cast("long")
        base, c = 3 * k, cuts[k - 1]
        tie = even(F.col("tie"), -2.0 ** 63, 2.0 ** 63, parts * weight[c]) if weight[c] > 1 else F.lit(0)
        after = even(F.col("id"), c, cuts[k], parts) if k < len(cuts) else F.lit(0)
        return F.when(F.col("id") == c, F.lit(base * (1 << 32)) + tie).otherwise(F.lit((base + 1) * (1 << 32)) + after)

    return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(_case_tree(F.col("id"), cuts, 0, len(cuts), leaf)).cast("long")


def next_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document, its own fingerprint, its edited text's, and how alike they and the next document are."""
    spark = docs.sparkSession
    d = docs.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("t")).withColumn("tie", F.xxhash64("t"))
    chunks = max(total_bytes(d, "t") // chunk_bytes, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = d.withColumn("chunk", chunk_of(d, chunks))
    heads = d.groupBy("chunk").agg(F.max(F.struct("id", "tie")).alias("h"))
    # in descending order a chunk's first row follows the last row of the chunk above it; the ring closes at the top
    w = Window.orderBy("chunk")
    heads = saved(heads.select("chunk", "h.id", "h.tie", F.coalesce(F.lead("chunk").over(w), F.min("chunk").over(
        Window.partitionBy())).alias("above")), "chunk-heads")
    printed = d.withColumn("fp", fingerprint(F.col("t")))
    sent = attach_small(printed, heads.select("chunk", "id", "tie", "above"), ["chunk", "id", "tie"])
    place = lambda chunk, guest: F.struct(chunk.alias("chunk"), F.lit(guest).alias("guest"))
    own, guest = place(F.col("chunk"), False), place(F.col("above"), True)
    sent = (sent.withColumn("to", F.explode(F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, guest))))
            .select("to.chunk", "to.guest", "id", "tie", "t", "fp"))
    order = Window.partitionBy("chunk").orderBy("guest", F.col("id").desc_nulls_last(), F.col("tie").desc())
    paired = (sent.withColumn("next_t", F.lead("t").over(order)).withColumn("next_fp", F.lead("fp").over(order))
              .where(~F.col("guest")))
    n = F.char_length("t")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("t", F.lit(1), n - third), F.substr("next_t", F.lit(1), third))
    return (paired.withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
            .select(F.col("id").alias(key), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                    F.col("fp").alias("fingerprint"), "edited_fingerprint",
                    likeness(F.col("fp"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fp"), F.col("next_fp")).alias("near_next")))
