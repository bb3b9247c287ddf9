"""Benchmark decontamination with training suffix arrays.

The documents are the training side.  Each task cuts its documents into
shards of about ``SHARD_WORDS`` words (whole documents), sorts the shard's
suffixes into a suffix array and binary-searches every suffix of every
benchmark item in it.  Words are compared as numbers of the benchmark's
vocabulary; a word outside it can be part of no match, so it ends a
suffix, and suffixes that begin with one are left out of the array.

The search gives, for each benchmark suffix, the range of training
suffixes that begin with its first ``window`` words (an item with fewer
words is searched whole), so every place of every verbatim match, and
from places on one diagonal the longest match.

The benchmark is a stated query set.  It is dealt to blocks of at most
``BLOCK_BYTES`` of text; each block is one pass over the documents (no
shuffle).  Between two passes the documents with their marks are written, so
a stage, its tasks and its plan hold one block, however large the benchmark
is; a benchmark of several blocks costs as many writes less one.

Defined cases: null or wordless texts and items match nothing; repeated
items count once per id; a null item id is the empty name; documents keep
all their columns, whatever their names; empty tables work.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import saved, total_bytes

WINDOW = 10
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 8 << 20

#: Bytes to lower-cased word bytes; all else in ASCII is a gap.
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class TestSuffixes:
    """The benchmark's vocabulary and its suffixes, packed for comparison."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocab: dict[bytes, int] = {}
        names: dict[tuple[int, ...], list[str]] = {}
        for name, text in items:
            seq = tuple(self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text))
            if seq:
                names.setdefault(seq, []).append(name)
        self.names = [sorted(set(x)) for x in names.values()]
        self.bits = max(1, len(self.vocab).bit_length())
        self.per_key = 63 // self.bits
        seen: dict[tuple[int, ...], int] = {}
        of: list[tuple[int, int, int]] = []  # window, text, place in the text
        for t, seq in enumerate(names):
            for s in range(max(1, len(seq) - window + 1)):
                of.append((seen.setdefault(seq[s:s + window], len(seen)), t, s))
        self.length = np.array([len(x) for x in seen], np.int64)
        self.levels = -(-window // self.per_key)
        grid = np.zeros((len(seen), self.levels * self.per_key), np.int64)
        for i, x in enumerate(seen):
            grid[i, :len(x)] = x
        self.keys = [self._pack(grid[:, j * self.per_key:(j + 1) * self.per_key]) for j in range(self.levels)]
        # a window's last words may fill a key in part: the rest is shifted out before comparing
        filled = np.clip(self.length[:, None] - np.arange(self.levels) * self.per_key, 0, self.per_key)
        self.shift = ((self.per_key - filled) * self.bits).T
        of_arr = np.array(sorted(of), np.int64).reshape(-1, 3)
        self.text, self.place = of_arr[:, 1], of_arr[:, 2]
        self.first = np.searchsorted(of_arr[:, 0], np.arange(len(seen) + 1))

    def _pack(self, cols: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cols), np.int64)
        for j in range(cols.shape[1]):
            out = (out << self.bits) | cols[:, j]
        return out


class SuffixArray:
    """Sorted suffixes of a shard of word numbers; 0 is a word that ends a suffix."""

    def __init__(self, ids: np.ndarray, test: TestSuffixes):
        n, w = len(ids), test.per_key
        gaps = np.append(np.flatnonzero(ids == 0), n)
        self.run = gaps[np.searchsorted(gaps, np.arange(n))] - np.arange(n)  # words until the suffix ends
        padded = np.concatenate([ids, np.zeros(w, ids.dtype)])
        key = np.zeros(n, np.int64)
        for j in range(w):
            key <<= test.bits
            key |= np.where(self.run > j, padded[j:j + n], 0)
        self.key, self.test, self.width = key, test, w
        at = np.flatnonzero(ids)
        self.sa = at[np.argsort(key[at], kind="stable")]
        self._refine(n, w)

    def _refine(self, n: int, step: int) -> None:
        """Prefix doubling over the suffixes that are still tied."""
        sa = self.sa
        if not len(sa):
            return
        k = self.key[sa]
        head = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
        size = np.diff(np.append(head, len(sa)))
        rank = np.zeros(n, np.int64)
        rank[sa] = np.repeat(head, size) + 1
        tied = np.flatnonzero(np.repeat(size, size) > 1)
        while len(tied):
            p = sa[tied]
            group, nxt = rank[p], np.zeros(len(p), np.int64)
            on = self.run[p] > step
            if not on.any():
                break
            nxt[on] = rank[p[on] + step]
            order = np.lexsort((nxt, group))
            p, group, nxt = p[order], group[order], nxt[order]
            sa[tied] = p
            g_head = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1])
            g_size = np.diff(np.append(g_head, len(p)))
            head = np.concatenate([[0], np.flatnonzero((group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])) + 1])
            size = np.diff(np.append(head, len(p)))
            rank[p] = group + np.repeat(head, size) - np.repeat(g_head, g_size)
            tied = tied[(np.repeat(size, size) > 1) & (nxt > 0)]  # those that have ended are equal
            step *= 2

    def _before(self, at: np.ndarray, which: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether the suffixes at places ``at`` sort before the windows ``which`` (or have them as prefix)."""
        p = self.sa[at]
        less, equal = np.zeros(len(at), bool), np.ones(len(at), bool)
        for j in range(self.test.levels):
            s = self.test.shift[j][which]
            q = np.minimum(p + j * self.width, len(self.key) - 1)
            k = np.where(self.run[p] > j * self.width, self.key[q], 0) >> s
            want = self.test.keys[j][which] >> s
            less |= equal & (k < want)
            equal &= k == want
        return less | equal if or_equal else less

    def ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """For every window, the range of suffixes that begin with it, by binary search."""
        m = len(self.test.length)
        found = []
        for or_equal in (False, True):
            lo, hi = np.zeros(m, np.int64), np.full(m, len(self.sa), np.int64)
            while len(open_ := np.flatnonzero(lo < hi)):
                mid = (lo[open_] + hi[open_]) // 2
                up = self._before(mid, open_, or_equal)
                lo[open_[up]] = mid[up] + 1
                hi[open_[~up]] = mid[~up]
            found.append(lo)
        return found[0], found[1]


def _expand(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) with value running over start .. start + size - 1 of each row."""
    row = np.repeat(np.arange(len(start)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def search_shard(ids: np.ndarray, ends: np.ndarray, test: TestSuffixes) -> dict[str, np.ndarray]:
    """Matches in a shard of documents, each closed by a 0 at ``ends``.

    ``doc``/``at``/``len``: every occurrence of a window, by place in the
    document; ``doc_text``: (document, benchmark text) with a match;
    ``longest``: (document, words, place, text) of each document's longest.
    """
    sa = SuffixArray(ids, test)
    lo, hi = sa.ranges()
    window, place = _expand(lo, hi - lo)
    at = sa.sa[place]
    begin = np.concatenate([[0], ends[:-1] + 1])
    doc = np.searchsorted(ends, at)
    size = np.diff(test.first)[window]
    hit, k = _expand(test.first[window], size)
    text, diagonal, a, d = test.text[k], at[hit] - test.place[k], at[hit], doc[hit]
    order = np.lexsort((a, diagonal, text))
    text, diagonal, a, d, length = text[order], diagonal[order], a[order], d[order], test.length[window[hit]][order]
    new = np.ones(len(a), bool)
    new[1:] = (text[1:] != text[:-1]) | (diagonal[1:] != diagonal[:-1]) | (a[1:] != a[:-1] + 1)
    head = np.flatnonzero(new)
    run = np.diff(np.append(head, len(a))) - 1 + length[head] if len(head) else head
    best = np.lexsort((a[head], -run, d[head]))
    first = best[np.unique(d[head][best], return_index=True)[1]]
    return {"doc": doc, "at": at - begin[doc], "len": test.length[window],
            "doc_text": np.unique(np.stack([d, text], axis=1), axis=0) if len(d) else np.empty((0, 2), np.int64),
            "longest": np.stack([d[head][first], run[first], (a[head] - begin[d[head]])[first], text[head][first]], axis=1)
            if len(head) else np.empty((0, 4), np.int64)}


#: Columns that the search adds; the prefix keeps clear of the documents' own names.
MARKS = {"n_words": "long", "n_hit": "long", "items": "array<string>", "longest_words": "long", "longest_at": "long",
         "longest_item": "string", "spans": "binary"}


def _merge(spans: np.ndarray) -> np.ndarray:
    """Union of half-open spans (rows of start, end), in order."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    head = np.flatnonzero(new)
    return np.stack([spans[head, 0], np.append(reach[head[1:] - 1], reach[-1])], axis=1)


def _searcher(items: list[tuple[str, str]], window: int, text_at: int, names: list[str]):
    n_marks = len(MARKS)

    def shard(batch: pa.RecordBatch, numbers: list[np.ndarray], test: TestSuffixes) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in numbers], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        got = search_shard(np.concatenate([np.append(x, 0) for x in numbers]), ends, test)
        old = {k: batch.column(batch.num_columns - n_marks + i).to_pylist() for i, k in enumerate(MARKS)}
        spans = [np.frombuffer(x or b"", np.int64).reshape(-1, 2) for x in old["spans"]]
        order = np.argsort(got["doc"], kind="stable")
        doc, own = got["doc"][order], np.stack([got["at"], got["at"] + got["len"]], axis=1)[order]
        cut = np.flatnonzero(np.diff(doc)) + 1
        for i, x in zip(doc[np.concatenate([[0], cut])] if len(doc) else [], np.split(own, cut)):
            spans[i] = _merge(np.concatenate([spans[i], x]))
        found = [set(x or []) for x in old["items"]]
        for d, t in got["doc_text"].tolist():
            found[d].update(test.names[t])
        best = list(zip(old["longest_words"], old["longest_at"], old["longest_item"]))
        for d, words, at, t in got["longest"].tolist():
            if words > best[d][0]:
                best[d] = (words, at, test.names[t][0])
        marks = [pa.array(sizes), pa.array([int((x[:, 1] - x[:, 0]).sum()) for x in spans], pa.int64()),
                 pa.array([sorted(x) for x in found], pa.list_(pa.string())), *[
                     pa.array([b[i] for b in best], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))],
                 pa.array([x.tobytes() for x in spans], pa.binary())]
        return pa.RecordBatch.from_arrays([*batch.columns[:-n_marks], *marks], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = TestSuffixes(items, window)
        get = test.vocab.get
        for batch in batches:
            numbers: list[np.ndarray] = []
            held = start = 0
            for i, t in enumerate(batch.column(text_at)):
                ws = words_of(t.as_py())
                numbers.append(np.fromiter(map(get, ws, repeat(0)), np.int64, len(ws)))
                held += len(ws)
                if held >= SHARD_WORDS or i == batch.num_rows - 1:
                    yield shard(batch.slice(start, i + 1 - start), numbers, test)
                    numbers, held, start = [], 0, i + 1

    return work


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id",
         item_text: str = "text", block_bytes: int = BLOCK_BYTES, prefix: str = "bench_") -> DataFrame:
    """``docs`` plus what the search found, as ``<prefix><name>`` for the names of ``MARKS``.

    ``n_hit``: words inside any occurrence of a window; ``items``: ids of
    the items with occurring windows; ``longest_*``: words, first word and
    item of the longest verbatim match; ``spans``: the merged hit spans as
    pairs of 64-bit word numbers.
    """
    while any(c.lower().startswith(prefix.lower()) for c in docs.columns):
        prefix = "_" + prefix
    b = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t")
                         ).where("t is not null")
    blocks = max(1, -(-total_bytes(b, "t") // block_bytes))
    own = {k: F.lit(None).cast(kind) for k, kind in MARKS.items()}
    own |= {k: F.lit(0).cast("long") for k in ("n_words", "n_hit", "longest_words")} | {
        "items": F.array().cast("array<string>")}
    out = docs.select("*", *[c.alias(prefix + k) for k, c in own.items()])
    schema = out.schema
    for f in schema.fields:
        f.nullable = True
    for k in range(blocks):
        if k:
            out = saved(out, "marked")
        part = b.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        items = [(r.i, r.t) for r in part.toLocalIterator()]
        out = out.mapInArrow(_searcher(items, window, docs.columns.index(text), out.columns), schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that have a word inside an occurrence of a benchmark window."""
    marked = mark(docs, benchmark, **how)
    n_hit = marked.columns[len(docs.columns) + list(MARKS).index("n_hit")]
    return marked.where(F.col(n_hit) == 0).select(*docs.columns)
