"""SimHash near-duplicate groups, compared through pivot distance tables.

1. Fingerprint: ASCII-lower-cased words, shingles of ``shingle`` words,
   XXH64 (seed 42) of each; a bit is set when more than half of the hashes
   have it.
2. One row per distinct fingerprint (exact copies never meet again).
3. Buckets: the 64 bits are cut into ``max_bits + 2`` blocks; two
   fingerprints within ``max_bits`` agree on two whole blocks at least, so
   each goes to one bucket per pair of blocks and no link is lost.
4. Within a bucket, the distances of each fingerprint to the reference
   fingerprints (``PIVOTS``) are computed once.  By the triangle
   inequality the largest difference of two such rows is a lower bound of
   the distance: pairs above ``max_bits`` are discarded, the others verified
   by the exact bit distance.
5. A bucket emits a spanning forest of its links, not all its pairs.
   Buckets above ``BUCKET_ROWS`` fingerprints are dealt out in chunks,
   one task for each two chunks, so nothing is dropped or gathered.
6. Components of the links; every document gets its group's smallest id.

Defined cases: null or wordless text has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; null ids do
not count for the smallest id (null if a group has no other); repeated
rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import saved
from ladle.llm.components import components

SEED = 42
BUCKET_ROWS = 16_384
PAIRWISE_ROWS = 8
BROADCAST_ROWS = 1_000_000  # of 16 to 24 bytes each
#: Reference fingerprints: the XXH64 of these numbers.
N_PIVOTS = 32


def pivots() -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(N_PIVOTS)], np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(data, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h = xxhash.xxh64_intdigest
        hashes = [h(data[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, text_hash) of every row; ``fp`` is the fingerprint as a signed long."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), b.column(1)], ["id", "fp", "text_hash"])

    d = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("t"))
    return d.mapInArrow(work, "id long, fp long, text_hash long")


def block_masks(max_bits: int) -> list[int]:
    """For every two of ``max_bits + 2`` blocks, the mask of their bits, as signed longs."""
    cuts = np.linspace(0, 64, max_bits + 3).round().astype(int)
    blocks = [sum(1 << i for i in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [int(np.uint64(a | b).view(np.int64)) for a, b in combinations(blocks, 2)]


class Links:
    """Links inside runs of fingerprints that share a bucket."""

    def __init__(self, max_bits: int):
        self.limit, self.pivots = max_bits, pivots()

    def table(self, fp: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fp[:, None] ^ self.pivots[None, :]).astype(np.int8)

    def near(self, fp: np.ndarray, t: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs (i, j) survive the pivot tables and the exact distance."""
        keep = np.flatnonzero(np.abs(t[i] - t[j]).max(axis=1) <= self.limit)
        return keep[np.bitwise_count(fp[i[keep]] ^ fp[j[keep]]) <= self.limit]

    def small(self, fp: np.ndarray, run: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """All links within runs of at most ``longest`` rows."""
        t, a, b = self.table(fp), [], []
        for d in range(1, longest):
            i = np.flatnonzero(run[:-d] == run[d:]) if len(run) > d else np.empty(0, np.int64)
            if not len(i):
                break
            ok = i[self.near(fp, t, i, i + d)]
            a.append(fp[ok])
            b.append(fp[ok + d])
        return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])

    def forest(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of the links within one large run, breadth first."""
        t = self.table(fp)
        order = np.argsort(t[:, 0], kind="stable")
        fp, t = fp[order], t[order]
        left, a, b = np.arange(len(fp)), [], []
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                x = queue.pop()
                lo, hi = np.searchsorted(t[left, 0], [t[x, 0] - self.limit, t[x, 0] + self.limit + 1])
                found = lo + self.near(fp, t, left[lo:hi], np.full(hi - lo, x))
                if len(found):
                    new = left[found]
                    a.append(np.full(len(new), fp[x]))
                    b.append(fp[new])
                    queue.extend(new.tolist())
                    left = np.delete(left, found)
        return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _link_runs(max_bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, held = Links(max_bits), None

        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        def runs(cols: list[np.ndarray], last: bool):
            nonlocal held
            new = np.ones(len(cols[0]), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:3]])
            starts = np.flatnonzero(new)
            end = len(new) if last else starts[-1]
            held = None if last else [c[end:] for c in cols]
            starts = starts[starts < end]
            sizes = np.diff(np.append(starts, end))
            fp, run = cols[3][:end].view(np.uint64), np.repeat(np.arange(len(starts)), sizes)
            size = np.repeat(sizes, sizes)
            some = (size > 1) & (size <= PAIRWISE_ROWS)
            if some.any():
                yield out(*links.small(fp[some], run[some], PAIRWISE_ROWS))
            for s, k in zip(starts[sizes > PAIRWISE_ROWS], sizes[sizes > PAIRWISE_ROWS]):
                yield out(*links.forest(fp[s:s + k]))

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if len(cols[0]):
                yield from runs(cols if held is None else [np.concatenate(x) for x in zip(held, cols)], False)
        if held is not None:
            yield from runs(held, True)

    return work


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: enough of them to connect all that are within ``max_bits``."""
    masks = block_masks(max_bits)
    buckets = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                              .alias("t", "key"))
    large = saved(buckets.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS),
                  "large-buckets")
    n_large = large.count()
    rows = buckets.withColumn("c", F.lit(0))
    if n_large:
        table = large.withColumn("g", F.ceil(F.col("n") / (BUCKET_ROWS // 2)).cast("int")).drop("n")
        table = F.broadcast(table) if n_large <= BROADCAST_ROWS else table
        g, own = F.col("g"), F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
        other = F.when(g.isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), g - 1))
        rows = (buckets.join(table, ["t", "key"], "left").withColumn("own", own).withColumn("o", F.explode(other))
                .where("o = -1 or o <> own")
                .withColumn("c", F.when(g.isNull(), 0).otherwise(F.least("own", "o") * g + F.greatest("own", "o"))))
    return (rows.select("t", "key", "c", "fp").repartition("t", "key", "c").sortWithinPartitions("t", "key", "c")
            .mapInArrow(_link_runs(max_bits), "a long, b long"))


def groups(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id): a name of the group and the smallest id of its rows, for each fingerprint."""
    distinct = saved(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    nodes = saved(distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "nodes")
    low = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    return nodes.join(low, "root").select("fp", "root", "component_id")


def fp_hex(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable) of every row."""
    prints = saved(fingerprints(docs, shingle, key, text).drop("text_hash"), "prints")
    return (prints.join(groups(prints, max_bits), "fp")
            .select(F.col("id").alias(key), fp_hex().alias("fingerprint"), "component_id"))


def simhash_dedup(docs: DataFrame, shingle: int = 4, max_bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, ties by text hash, then by all columns."""
    prints = saved(fingerprints(docs, shingle, key, text), "prints")
    member = saved(prints.join(groups(prints, max_bits), "fp"), "member")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    best = member.groupBy("root").agg(F.min(order).alias("b")).select("b.id", "b.text_hash")
    rows = member.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    same = [rows[c].eqNullSafe(best[c]) for c in ("id", "text_hash")]
    out = saved(rows.join(best, same, "left_anti").select("id", "text_hash"), "dropped")
    twice = saved(rows.join(best, same, "left_semi").where("n > 1").select("id", "text_hash"), "repeated")

    def match(side: DataFrame, how: str, d: DataFrame) -> DataFrame:
        n = side.count()
        if not n:
            return d if how == "left_anti" else d.limit(0)
        s = side.select(F.col("id").alias("__id"), F.col("text_hash").alias("__th"))
        return d.join(F.broadcast(s) if n <= BROADCAST_ROWS else s,
                      F.col(key).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__th")), how)

    kept = match(out, "left_anti", docs)
    if not twice.take(1):
        return kept
    again = match(twice, "left_semi", kept)
    one = (again.groupBy(F.col(key).alias("__k"), F.xxhash64(text).alias("__h"))
           .agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*"))
    return match(twice, "left_anti", kept).unionByName(one)
