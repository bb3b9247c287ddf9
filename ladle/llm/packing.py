"""Packing documents into training sequences by multiway differencing.

A document is its token ids and an end id.  Each task takes the documents
of its share of the scan in groups of ``GROUP_DOCS`` and needs no shuffle:

* a document of a sequence's length or more gives whole sequences; what is
  left of it is one piece;
* Karmarkar-Karp multiway differencing puts the group's pieces into as few
  windows as their sum needs: every piece begins as a partial partition, the
  two partial partitions with the largest spread of loads are merged, the
  large windows of one with the small windows of the other, until one is
  left.  When a window exceeds the capacity, the number of windows rises and
  the differencing is done again;
* the windows are near-equal; the gaps they leave are closed by cutting up
  the emptiest windows.  The window that stays open goes on to the task's
  next group.

What a task has at the end is cut into sequences whose lengths are powers
of two, which need no padding.  So only those, ten at most, are shorter than
the rest, and no sequence is padded.

A task holds one group.  Sequence numbers carry the task's number in their
upper bits; they are unique, with gaps.  A repeated task reads the same rows
in the same order and gives the same pieces; which documents share a
sequence depends on how the scan is split.

Defined cases: null text is empty (only the end id); null ids stay null;
repeated rows are documents of their own; a very long text is held once as
text and once as ids, and its sequences leave at once with its group; a
document without any id (no end id) has no piece; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import text_or_empty
from ladle.llm.token_files import Memo, _byte_letters

CAPACITY = 1024
GROUP_DOCS = 256
GROUP_IDS = 4 << 20
#: Pieces of plain text remembered, and chunks of other texts, in each of the memo's two generations.
CACHE_CHUNKS = 400_000
CACHE_MIXED = 100_000
TASK_SHIFT = 36

# ---- text -> ids ------------------------------------------------------------

#: Texts of these characters are cut here as the tokenizer would cut them.
_PLAIN = re.compile(r"[\t\r\n\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PIECE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")
#: A blank before a character that is none begins a piece in every text.
_BLANK = re.compile(r" (?=\S)")
_UNEVEN = re.compile(r" (?:\s|$)")


class ByteEncoder:
    """Encodes texts with a tokenizers file; equal to ``Tokenizer.encode`` on the whole text.

    A byte-level BPE tokenizer cuts a text into pieces.  Texts of plain
    characters are cut here, and each distinct piece is encoded and kept in a
    bounded memo.  A blank before another character always begins a piece:
    other texts are split there, and their chunks are remembered.  A text
    that holds a special token's string, and any text under another kind of
    tokenizer, is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        cfg = json.loads(self.tok.to_str())
        pre, model = cfg.get("pre_tokenizer") or {}, cfg["model"]
        self.by_chunk = (cfg["normalizer"] is None and cfg["truncation"] is None and cfg["padding"] is None
                         and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
                         and model["type"] == "BPE" and not model.get("dropout"))
        self.special = [t["content"] for t in cfg["added_tokens"]]
        self.dtype = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.letters = _byte_letters()  # by byte, which is the code of its Latin-1 character
        self.model, self.blank = self.tok.model, self.letters[32]
        self.pieces, self.chunks = Memo(self._piece, CACHE_CHUNKS), Memo(self._after_blank, CACHE_MIXED)

    def _pack(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # of these bytes only the blank has another letter
            letters = piece.replace(" ", self.blank)
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return self._pack([t.id for t in self.model.tokenize(letters)])

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> bytes:
        if not _PLAIN.fullmatch(chunk):
            return self._whole(chunk)
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(chunk)))

    def _after_blank(self, chunk: str) -> bytes:
        return self._chunk(" " + chunk)

    def __call__(self, text: str) -> bytes:
        if not self.by_chunk or any(s in text for s in self.special):
            return self._whole(text)
        if _PLAIN.fullmatch(text):
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text)))
        first, *rest = _BLANK.split(text) if _UNEVEN.search(text) else text.split(" ")
        if not first and rest:  # the text begins with a blank
            return b"".join(map(self.chunks.__getitem__, rest))
        return self._chunk(first) + b"".join(map(self.chunks.__getitem__, rest))


_ENCODERS: dict[str, ByteEncoder] = {}


def byte_encoder(path: str) -> ByteEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


# ---- multiway differencing ----------------------------------------------------


class Partial(NamedTuple):
    """A partition of some items: loads of its non-empty windows, ascending, and each window's node."""

    loads: list[int]
    nodes: list

    def spread(self, k: int) -> int:
        return self.loads[-1] - (self.loads[0] if len(self.loads) == k else 0)


def _merge(a: Partial, b: Partial, k: int) -> Partial:
    """Both partitions as one of ``k`` windows: what must share a window is large on one side and small on the other."""
    if len(b.loads) == 1 and len(a.loads) == k:
        a, b = b, a
    if len(a.loads) == 1 and len(b.loads) >= 1:
        loads, nodes = b.loads, b.nodes
        load, node = a.loads[0], a.nodes[0]
        if len(loads) == k:  # the one window of ``a`` joins the smallest of ``b``
            load, node = load + loads.pop(0), (node, nodes.pop(0))
        at = bisect_left(loads, load)
        loads.insert(at, load)
        nodes.insert(at, node)
        return Partial(loads, nodes)
    shared = max(0, len(a.loads) + len(b.loads) - k)
    both = [(x + y, (m, n)) for x, y, m, n in
            zip(reversed(a.loads[:shared]), b.loads[:shared], reversed(a.nodes[:shared]), b.nodes[:shared])]
    both += zip(a.loads[shared:], a.nodes[shared:])
    both += zip(b.loads[shared:], b.nodes[shared:])
    both.sort(key=lambda x: x[0])
    return Partial([x[0] for x in both], [x[1] for x in both])


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Places of ``sizes`` dealt into at most ``k`` windows of near-equal sums (Karmarkar-Karp)."""
    heap = [(-s if k > 1 else 0, i, Partial([s], [i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        c = _merge(a, b, k)
        heapq.heapreplace(heap, (-c.spread(k), serial, c))
        serial += 1
    out = []
    for node in heap[0][2].nodes if heap else []:
        found, stack = [], [node]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                found.append(x)
        out.append(found)
    return out


def windows_within(sizes: list[int], capacity: int) -> list[list[int]]:
    """``sizes`` (each at most ``capacity``) in near-equal windows, as many as it takes for none to exceed ``capacity``."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, k)
        over = sum(max(0, sum(sizes[i] for i in w) - capacity) for w in windows)
        if not over:
            return windows
        k += max(1, over // capacity)


# ---- pieces and sequences -----------------------------------------------------


class Piece(NamedTuple):
    key: int | None
    start: int
    ids: np.ndarray
    total: int  # ids of its document

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        return self._replace(ids=self.ids[:n]), self._replace(start=self.start + n, ids=self.ids[n:])


def _length(window: list[Piece]) -> int:
    return sum(len(p.ids) for p in window)


def close_gaps(windows: list[list[Piece]], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the pieces of the one that stays open: the emptiest are cut up for the gaps of the fullest."""
    windows = sorted(windows, key=_length, reverse=True)
    i, j = 0, len(windows) - 1
    while i < j:
        need = capacity - _length(windows[i])
        while need and j > i:
            if not windows[j]:
                j -= 1
                continue
            last = windows[j].pop()
            if len(last.ids) > need:
                left, last = last.cut(len(last.ids) - need)
                windows[j].append(left)
            windows[i].append(last)
            need -= len(last.ids)
        i += not need
    full = windows[:i]
    rest = windows[i] if i < len(windows) else []
    if rest and _length(rest) == capacity:
        full, rest = [*full, rest], []
    return full, rest


def powers_of_two(rest: list[Piece]) -> list[list[Piece]]:
    """The pieces in order, cut into windows whose lengths are distinct powers of two."""
    out, left, n = [], rest[::-1], _length(rest)
    while n:
        size = 1 << (n.bit_length() - 1)
        n -= size
        window = []
        while size:
            p = left.pop()
            if len(p.ids) > size:
                p, more = p.cut(size)
                left.append(more)
            window.append(p)
            size -= len(p.ids)
        out.append(window)
    return out


def pack(docs: Iterable[tuple[int | None, np.ndarray]], capacity: int = CAPACITY) -> Iterator[list[list[Piece]]]:
    """Sequences (lists of pieces) of (key, ids) documents, group by group; the last lot has the short ones."""
    whole: list[list[Piece]] = []
    pieces: list[Piece] = []
    count = held = 0

    def group() -> tuple[list[list[Piece]], list[Piece]]:
        windows = [[pieces[i] for i in w] for w in windows_within([len(p.ids) for p in pieces], capacity)]
        return close_gaps(windows, capacity)

    for key, ids in docs:
        n = len(ids)
        last = n - n % capacity
        whole += [[Piece(key, a, ids[a:a + capacity], n)] for a in range(0, last, capacity)]
        if n > last:
            pieces.append(Piece(key, last, ids[last:], n))
        count, held = count + 1, held + n
        if count >= GROUP_DOCS or held >= GROUP_IDS:
            full, rest = group()
            yield whole + full
            whole, pieces = [], [p._replace(ids=p.ids.copy()) for p in rest]  # lets go of the documents
            count = held = 0
    full, rest = group()
    yield whole + full + powers_of_two(rest)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")
SEQUENCES = ("sequence_id long, length long, ids binary, "
             "pieces array<struct<doc_id: long, start: long, length: long, offset: long>>")


def _numbered(tokenizer_path: str, end_id: int | None, capacity: int, batches: Iterator[pa.RecordBatch]
              ) -> Iterator[list[tuple[int, list[Piece]]]]:
    enc = byte_encoder(tokenizer_path)
    end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()

    def docs():
        for b in batches:
            for key, text in zip(b.column(0), b.column(1)):
                yield key.as_py(), np.frombuffer(enc(text.as_py()) + end, enc.dtype)

    number = TaskContext.get().partitionId() << TASK_SHIFT
    for lot in pack(docs(), capacity):
        yield list(enumerate(lot, number))
        number += len(lot)


def _pieces(tokenizer_path: str, end_id: int | None, capacity: int, with_ids: bool) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PIECES.split(", ")]
        for lot in _numbered(tokenizer_path, end_id, capacity, batches):
            rows = []
            for number, window in lot:
                at = 0
                for p in window:
                    rows.append((p.key, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, number, at,
                                 p.ids.tobytes() if with_ids else None))
                    at += len(p.ids)
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.binary() if n == "ids" else pa.int64()) for c, n in zip(cols, names)], names)

    return work


def _sequences(tokenizer_path: str, end_id: int | None, capacity: int, pad_id: int) -> Callable:
    place = pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "offset")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _numbered(tokenizer_path, end_id, capacity, batches):
            numbers, lengths, data, places = [], [], [], []
            for number, window in lot:
                ids = np.concatenate([p.ids for p in window])
                at = np.cumsum([0] + [len(p.ids) for p in window]).tolist()
                pad = 0 if len(ids) & (len(ids) - 1) == 0 else capacity - len(ids)
                numbers.append(number)
                lengths.append(len(ids))
                data.append(np.pad(ids, (0, pad), constant_values=pad_id).astype(ids.dtype).tobytes())
                places.append([{"doc_id": p.key, "start": p.start, "length": len(p.ids), "offset": a}
                               for p, a in zip(window, at)])
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(lengths, pa.int64()),
                                              pa.array(data, pa.binary()), pa.array(places, pa.list_(place))],
                                             ["sequence_id", "length", "ids", "pieces"])

    return work


def _input(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("k"), text_or_empty(text).alias("t"))


def pack_pieces(docs: DataFrame, tokenizer_path: str, end_id: int | None = 0, capacity: int = CAPACITY, with_ids: bool = True,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence (``PIECES``; ``ids`` little-endian)."""
    got = _input(docs, key, text).mapInArrow(_pieces(tokenizer_path, end_id, capacity, with_ids), PIECES)
    return got if with_ids else got.drop("ids")


def pack_sequences(docs: DataFrame, tokenizer_path: str, end_id: int | None = 0, capacity: int = CAPACITY, pad_id: int = 0,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per sequence: its ids, padded to ``capacity`` unless their number is a power of two, and its pieces."""
    return _input(docs, key, text).mapInArrow(_sequences(tokenizer_path, end_id, capacity, pad_id), SEQUENCES)
