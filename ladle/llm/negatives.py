"""Hard-negative mining with GNAT-style multiway hyperplane trees.

Vectors are integers; the score of two is their inner product.  An anchor's
positives are the best rows of its label, and for each positive the best rows
of other labels whose score lies within a window below the positive's.

The index is a table of trees, one row per at most ``TREE_ROWS`` vectors of a
task's share of the scan.  A node picks split points far from each other and
deals its vectors to the nearest one (multiway hyperplanes); for each split
point it stores the range of distances to the vectors under every sibling.
A window of scores and the range of norms under a sibling give an annulus of
distances around the anchor; by the triangle inequality each split point's
range says which distances the sibling can have, and a sibling is eliminated
when one of these does not meet the annulus.  As results come in, the lower
end of the window rises to the worst of the best so far.  Leaves are compared
exactly, so nothing is missed.

How it is spread: the index is built without a shuffle and written once.  The
anchors are taken in blocks of ``BLOCK_BYTES``; for each block a pass over the
index finds the positives (a few per anchor come back to the driver) and one
finds the negatives.  A task keeps its best few per anchor and window over all
its trees, and a top-k per anchor merges those of the tasks.  No step groups
by label, so a label that most rows share is no group anywhere.

Defined cases: rows without a label or vector, or with a null or non-finite
component, take no part; vectors are compared with those of their own length;
null ids come last among equal scores, and are no anchors; an anchor's own id
is not among its positives; rows that are repeated are candidates as often as
they stand, anchors that are repeated count once; an anchor without positives
or a window without rows gives no row; integers are held in 64 bits; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import saved
from ladle.session import scratch_dir

TREE_ROWS = 32_768
TREE_BYTES = 32 << 20
SPLITS = 16
LEAF_ROWS = 1024
BLOCK_BYTES = 16 << 20
QUERY_ROWS = 1024
NULL_ID = np.iinfo(np.int64).max
NO_SCORE = np.iinfo(np.int64).min

# ---- tree -----------------------------------------------------------------------


def _squares(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.float64)
    return np.einsum("ij,ij->i", y, y)


def _distances(x: np.ndarray, x2: np.ndarray, p: np.ndarray, p2: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(x2[:, None] + p2[None, :] - 2 * (x @ p.T), 0))


def _far_apart(x: np.ndarray, x2: np.ndarray, m: int) -> np.ndarray:
    """Places of up to ``m`` split points: each the farthest from those before, of an even sample."""
    some = np.unique(np.linspace(0, len(x) - 1, 3 * m).astype(np.int64))
    chosen = [0]
    gap = _distances(x[some], x2[some], x[some[:1]], x2[some[:1]])[:, 0]
    while len(chosen) < m:
        far = int(gap.argmax())
        if gap[far] <= 0:
            break
        chosen.append(far)
        gap = np.minimum(gap, _distances(x[some], x2[some], x[some[far:far + 1]], x2[some[far:far + 1]])[:, 0])
    return some[chosen]


class Typed:
    """Vectors, and copies of them in the number types that products are taken in."""

    vectors: np.ndarray

    def typed(self, kind: type) -> np.ndarray:
        made = self.__dict__.setdefault("_typed", {})
        if kind not in made:
            made[kind] = self.vectors.astype(kind)
        return made[kind]


class Tree(Typed):
    """Vectors in leaf order, and per node its split points, ranges and children.

    ``first[n]:first[n + 1]`` are the children of node ``n`` (rows of ``points``);
    ``node[c]`` is the child's own node or -1 for a leaf, ``begin[c]:end[c]`` its
    vectors, ``norms[c]`` the least and largest square of their norms.
    ``near[c, i]`` and ``wide[c, i]`` are the least and largest distance of the
    child's vectors to split point ``i`` of its node.
    """

    PARTS = ("ids", "labels", "vectors", "points", "first", "node", "begin", "end", "norms", "near", "wide")

    def __init__(self, **parts: np.ndarray):
        self.__dict__.update(parts)
        self.squares = _squares(self.vectors)
        self.floats = self.points.astype(np.float64)
        self.point_squares = _squares(self.points)
        self.largest = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))

    @staticmethod
    def build(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> "Tree":
        x, x2 = vectors.astype(np.float64), _squares(vectors)
        order: list[np.ndarray] = []
        points, node, begin, end, norms, near, wide = [], [], [], [], [], [], []
        first, done = [0], 0
        waiting = [(np.arange(len(ids)), -1)]  # rows of a node to come, and the child that it is
        while waiting:
            rows, child = waiting.pop(0)
            if child >= 0:
                node[child] = len(first) - 1
            at = _far_apart(x[rows], x2[rows], SPLITS)
            d = _distances(x[rows], x2[rows], x[rows[at]], x2[rows[at]])
            side = d.argmin(axis=1)
            for i in range(len(at)):
                own = side == i
                under = rows[own]
                ranges = np.full((2, SPLITS), np.inf)
                ranges[1] = -np.inf
                if len(under):
                    ranges[0, :len(at)], ranges[1, :len(at)] = d[own].min(axis=0), d[own].max(axis=0)
                points.append(rows[at[i]])
                norms.append((x2[under].min(initial=np.inf), x2[under].max(initial=-np.inf)))
                near.append(ranges[0])
                wide.append(ranges[1])
                node.append(-1)
                begin.append(-1)
                end.append(-1)
                if len(under) <= LEAF_ROWS or len(under) == len(rows):
                    begin[-1], end[-1] = done, done + len(under)
                    order.append(under)
                    done += len(under)
                else:
                    waiting.append((under, len(node) - 1))
            first.append(len(node))
        o = np.concatenate(order)
        return Tree(ids=ids[o], labels=labels[o], vectors=vectors[o], points=vectors[points], first=np.array(first),
                    node=np.array(node), begin=np.array(begin), end=np.array(end), norms=np.array(norms),
                    near=np.array(near), wide=np.array(wide))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in self.PARTS})
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> "Tree":
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            return Tree(**{k: z[k] for k in Tree.PARTS})


# ---- search ---------------------------------------------------------------------


class Best:
    """The best ``k`` (score, id) for each (anchor, window): higher scores first, then smaller ids."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, k: int):
        self.hi, self.k = hi, k  # (anchors, windows)
        self.floor = lo.copy()  # the least score that can still get in
        self.score = np.full((*lo.shape, k), NO_SCORE)
        self.id = np.full((*lo.shape, k), NULL_ID)
        self.count = np.zeros(lo.shape, np.int64)

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        for w in range(self.hi.shape[1]):
            ok = (score >= self.floor[anchor, w]) & (score <= self.hi[anchor, w])
            if ok.any():
                self._merge(w, anchor[ok], score[ok], ids[ok])

    def _merge(self, w: int, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(anchor)
        held = self.count[touched, w]
        old = np.arange(self.k)[None, :] < held[:, None]
        a = np.concatenate([np.repeat(touched, held), anchor])
        s = np.concatenate([self.score[touched, w][old], score])
        i = np.concatenate([self.id[touched, w][old], ids])
        o = np.lexsort((i, -s, a))
        a, s, i = a[o], s[o], i[o]
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        place = np.arange(len(a)) - np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
        top = place < self.k
        self.score[a[top], w, place[top]] = s[top]
        self.id[a[top], w, place[top]] = i[top]
        self.count[touched, w] = np.minimum(self.k, held + np.bincount(np.searchsorted(touched, anchor), minlength=len(touched)))
        full = touched[self.count[touched, w] == self.k]
        self.floor[full, w] = np.maximum(self.floor[full, w], self.score[full, w, -1])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, window, score, id) of all that is held."""
        a, w, j = np.nonzero(np.arange(self.k)[None, None, :] < self.count[:, :, None])
        return a, w, self.score[a, w, j], self.id[a, w, j]


class Anchors(Typed):
    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.squares = _squares(vectors)
        self.largest = float(np.abs(vectors.astype(np.float64)).max(initial=0))


def _open_children(tree: Tree, n: int, anchors: Anchors, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(anchor, child) pairs of node ``n`` that a window's annulus can reach."""
    c = slice(tree.first[n], tree.first[n + 1])
    m = c.stop - c.start
    least, most = tree.norms[c, 0], tree.norms[c, 1]
    q2 = anchors.squares[rows][:, None]
    slack = 1e-7 * (np.sqrt(q2) + np.sqrt(np.maximum(most, 0))[None, :]) + 1e-9
    outer = np.sqrt(np.maximum(q2 + most[None, :] - 2.0 * lo[:, None], 0)) + slack
    inner = np.sqrt(np.maximum(q2 + least[None, :] - 2.0 * hi[:, None], 0)) - slack
    keep = q2 + most[None, :] - 2.0 * lo[:, None] >= -slack * slack
    d = _distances(anchors.typed(np.float64)[rows], anchors.squares[rows], tree.floats[c], tree.point_squares[c])
    for i in range(m):
        dq, near, wide = d[:, i:i + 1], tree.near[c, i][None, :], tree.wide[c, i][None, :]
        keep &= (np.maximum(near - dq, dq - wide) <= outer) & (dq + wide >= inner)
    return keep


def search(tree: Tree, anchors: Anchors, best: Best, same_label: bool, seen: list[int] | None = None) -> None:
    """Adds the tree's rows to ``best``; ``seen`` gets the numbers of (anchor, row) pairs compared and of all."""
    top = tree.vectors.shape[1] * tree.largest * anchors.largest
    kind = np.float32 if top < 2 ** 24 else np.float64 if top < 2 ** 53 else np.int64  # sums stay exact
    for a in range(0, len(anchors.ids), QUERY_ROWS):
        stack = [(0, np.arange(a, min(a + QUERY_ROWS, len(anchors.ids))))]
        while stack:
            n, rows = stack.pop()
            wanted = best.floor[rows] <= best.hi[rows]
            lo = np.where(wanted, best.floor[rows], np.iinfo(np.int64).max).min(axis=1).astype(np.float64)
            hi = np.where(wanted, best.hi[rows], NO_SCORE).max(axis=1).astype(np.float64)
            live = wanted.any(axis=1)
            rows, lo, hi = rows[live], lo[live], hi[live]
            if not len(rows):
                continue
            keep = _open_children(tree, n, anchors, rows, lo, hi)
            for j in range(keep.shape[1]):
                c = tree.first[n] + j
                mine = rows[keep[:, j]]
                if not len(mine):
                    continue
                if tree.node[c] >= 0:
                    stack.append((tree.node[c], mine))
                    continue
                at = slice(tree.begin[c], tree.end[c])
                if seen is not None:
                    seen[0] += len(mine) * (at.stop - at.start)
                _leaf(tree, at, anchors, mine, best, same_label, kind)
        if seen is not None:
            seen[1] += len(tree.ids) * min(QUERY_ROWS, len(anchors.ids) - a)


def _leaf(tree: Tree, at: slice, anchors: Anchors, rows: np.ndarray, best: Best, same_label: bool, kind: type) -> None:
    score = anchors.typed(kind)[rows] @ tree.typed(kind)[at].T
    i, j = np.nonzero(score >= best.floor[rows].min(axis=1).astype(kind)[:, None])
    score, a, r = score[i, j].astype(np.int64), rows[i], j + at.start
    ok = (tree.labels[r] == anchors.labels[a]) == same_label
    if same_label:
        ok &= tree.ids[r] != anchors.ids[a]
    best.add(a[ok], score[ok], tree.ids[r[ok]])


# ---- in Spark -------------------------------------------------------------------


def usable(rows: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", grid: int = 256) -> DataFrame:
    """(id, label, v): rows that take part, each component floor(``grid`` * x)."""
    x = F.col("x")
    d = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                    F.transform(F.col(vector), lambda c: c.cast("double")).alias("x"))

    def odd(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))

    return d.where(F.col("label").isNotNull() & x.isNotNull() & ~F.exists(x, odd)).select(
        "id", "label", F.transform(x, lambda c: F.floor(c * grid)).alias("v"))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    ids = batch.column(0).fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(2)


def _narrow(v: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes."""
    top = max(int(v.max(initial=0)), -int(v.min(initial=0)) - 1)
    return v.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)


def _matrices(ids: np.ndarray, labels: np.ndarray, v: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, ids, labels, vectors) of the rows of each vector length."""
    size = np.diff(v.offsets.to_numpy())
    flat = v.values.slice(v.offsets[0].as_py(), int(size.sum())).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(size) - size
    for n in np.unique(size):
        own = np.flatnonzero(size == n)
        yield int(n), ids[own], labels[own], flat[starts[own][:, None] + np.arange(n)[None, :]]


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def tree(n: int) -> pa.RecordBatch:
        parts = held.pop(n)
        ids, labels, v = (np.concatenate([p[i] for p in parts]) for i in range(3))
        data = Tree.build(ids, labels, _narrow(v)).to_bytes()
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())],
                                          ["length", "n", "tree"])

    for b in batches:
        for n, ids, labels, v in _matrices(*_columns(b)):
            room = max(1, min(TREE_ROWS, TREE_BYTES // (8 * max(1, n))))
            for a in range(0, len(ids), room):
                own = held.setdefault(n, [])
                own.append((ids[a:a + room], labels[a:a + room], v[a:a + room]))
                if sum(len(p[0]) for p in own) >= room:
                    yield tree(n)
    for n in list(held):
        yield tree(n)


def build_index(rows: DataFrame) -> DataFrame:
    """Trees over all of ``usable`` rows, written once."""
    return saved(rows.mapInArrow(_build, "length int, n long, tree binary"), "vector-trees")


def _hunt(anchors, lo, hi, k: int, same_label: bool) -> Callable:
    """Per task: the best ``k`` per (anchor, window) over all its trees; the arguments are broadcasts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for b in batches:
            for data in b.column(0):
                best = best or Best(lo.value, hi.value, k)
                search(Tree.from_bytes(data.as_buffer().to_pybytes()), anchors.value, best, same_label)
        if best is not None:
            a, w, score, ids = best.found()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(w, pa.int32()), pa.array(score, pa.int64()),
                                              pa.array(ids, pa.int64(), mask=ids == NULL_ID)], ["a", "w", "score", "id"])

    return work


def _best_of_all(index: DataFrame, anchors, lo, hi, k: int, same_label: bool) -> DataFrame:
    """(a, w, rank, score, id): the first ``k`` of each (anchor, window) over the whole index."""
    got = index.select("tree").mapInArrow(_hunt(anchors, lo, hi, k, same_label), "a int, w int, score long, id long")
    order = Window.partitionBy("a", "w").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Negatives of each (anchor, positive) with ``low * p <= 100 * score <= high * p`` for the positive's score p.

    ``rows`` are ``usable`` ones; ``is_anchor`` is a condition on ``id`` and ``label``.
    """
    spark = rows.sparkSession
    index = build_index(rows)
    found = rows.where(is_anchor & F.col("id").isNotNull()).dropDuplicates(["id", "label", "v"])
    found = saved(found.withColumn("length", F.size("v")).withColumn("h", F.xxhash64("id", "label", "v")), "anchors")
    path = scratch_dir(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for size in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect():
        of_length = found.where(F.col("length") == size["length"])
        trees = index.where(F.col("length") == size["length"])
        blocks = max(1, -(-size["n"] * 8 * max(1, size["length"]) // BLOCK_BYTES))
        for b in range(blocks):
            block = of_length.where(F.pmod("h", F.lit(blocks)) == b).select("id", "label", "v").toArrow()
            if block.num_rows:
                _mine_block(trees, block, positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


def _mine_block(trees: DataFrame, block: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = trees.sparkSession
    share = spark.sparkContext.broadcast
    ((_, ids, labels, v),) = _matrices(*_columns(block.combine_chunks().to_batches()[0]))
    n = len(ids)
    anchors = share(Anchors(ids, labels, v))
    every = np.full((n, 1), NO_SCORE + 1)
    near = _best_of_all(trees, anchors, share(every), share(-every), positives, True).collect()
    score, pid = np.zeros((n, positives), np.int64), np.zeros((n, positives), np.int64)
    lo, hi = np.full((n, positives), np.iinfo(np.int64).max), np.full((n, positives), NO_SCORE)
    null = np.zeros((n, positives), bool)
    for r in near:
        a, w, p = r.a, r["rank"] - 1, r.score
        score[a, w], pid[a, w], null[a, w] = p, r.id or 0, r.id is None
        if -(-low * p // 100) <= high * p // 100:  # else no whole score lies in the window
            lo[a, w], hi[a, w] = -(-low * p // 100), high * p // 100
    told = share((ids, score, pid, null))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, score, pid, null = told.value
        for b in batches:
            a, w = b.column(0).to_numpy(), b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(pid[a, w], mask=null[a, w]), b.column(2), b.column(3),
                                              pa.array(score[a, w]), b.column(4)],
                                             ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    far = _best_of_all(trees, anchors, share(lo), share(hi), negatives, False)
    return far.select("a", "w", "rank", "id", "score").mapInArrow(named, RESULT)
