"""Token-id files with a minimal perfect hash index.

One shard file holds, in ascending key order,

* the raw payload: every document's token ids, little-endian, two bytes
  each when the vocabulary has at most 65,536 entries and four otherwise,
  each document closed by ``end_id``;
* the index: a minimal perfect hash over the shard's keys (bucket
  displacements), and for every slot a 32-bit fingerprint of the key, the
  first token and the number of tokens; then the keys in payload order;
* a trailer of fixed length that says where the index lies.

A key is looked up in constant time: hash to a bucket, add the bucket's
displacement, hash to a slot, compare the fingerprint, slice the payload.

Writing is one pass: range partitions by key, sorted, encoded in Arrow
batches and written by Spark's text sink, whose commit protocol discards
the files of lost or repeated tasks and which reaches any store Spark can
write to.  The sink ends each row with a separator; the separator is the
zero byte, and each row is a piece of the file without its last byte,
which is always zero (the high byte of ``end_id``, and the last byte of
the trailer).  So the files hold exactly the format above.

Defined cases: null text is empty (only ``end_id``); null keys come first
(Spark's ascending order); repeated keys are told apart by their
occurrence number, ties ordered by text; an empty table gives no files,
and reading gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.llm.common import saved, text_or_empty, total_bytes

MAGIC = b"LADLTOK1"
TRAILER = "<8sQQQBB"  # magic, docs, tokens, index bytes, id bytes, zero
SHARD_BYTES = 16 << 20
FLUSH_BYTES = 4 << 20
#: Words remembered, in each of the memo's two generations.
CACHE_WORDS = 240_000

# ---- text -> ids ------------------------------------------------------------

#: The tokenizer settings for which words are encoded one by one.
_WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: A text of these characters is its own normal form after lower-casing.
_PLAIN = re.compile(r"[\t\r\n\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_BLANK = re.compile(r"[ \t\r\n]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE uses for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memo(dict):
    """Remembers what ``make`` gives for each key, and forgets keys that were not asked for lately.

    When ``limit`` keys are held, they become the old generation, in place of the one before; an old key that is
    asked for comes back.  So common keys stay, and never more than ``2 * limit`` are held.
    """

    def __init__(self, make: Callable, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.limit:
            self.old = {}  # goes before the copy is made
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


class Encoder:
    """Encodes texts with a tokenizers file; equal to ``Tokenizer.encode`` on the whole text.

    For a lower-casing word tokenizer (white space dropped) the words of a
    text are independent.  Texts of plain characters are lower-cased and
    split here into runs of letters, digits and marks; each distinct one goes
    to the library's BPE model and is kept in a bounded memo, so that a word
    is the same with and without punctuation.  Words of all other texts go
    through the whole tokenizer.  Any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        cfg = json.loads(self.tok.to_str())
        self.dtype = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        pre = cfg.get("pre_tokenizer") or {}
        split = (pre.get("pretokenizers") or [{}])[0]
        self.by_word = (cfg["normalizer"] == _WORD_NORMALIZER and cfg["model"]["type"] == "BPE"
                        and cfg["truncation"] is None and split.get("pattern") == {"Regex": _WORD_PATTERN}
                        and split.get("behavior") == "Removed" and split.get("invert") is True
                        and len(pre["pretokenizers"]) == 2 and pre["pretokenizers"][1]["type"] == "ByteLevel"
                        and not pre["pretokenizers"][1]["add_prefix_space"])
        self.special = [t["content"] for t in cfg["added_tokens"]]
        self.model = self.tok.model
        self.letters = _byte_letters()
        self.code = "H" if self.dtype == "<u2" else "I"
        self.words = Memo(self._piece, CACHE_WORDS)

    def _pack(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _piece(self, p: str) -> bytes:
        q = p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
        return self._pack([t.id for t in self.model.tokenize(q)])

    def _encode(self, text: str) -> bytes:
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        if not self.by_word:
            return self._encode(text)
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.words.__getitem__, _PIECE.findall(text.lower())))
        return b"".join(map(self._encode, _BLANK.split(text)))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- minimal perfect hash ---------------------------------------------------

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + _GOLD * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_codes(keys: np.ndarray, null: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """64-bit code of (key, null flag, occurrence)."""
    return _mix(_mix(keys.astype(np.int64).view(np.uint64), 101) ^ occurrence.astype(np.uint64), 102) ^ _mix(
        null.astype(np.uint64), 103)


KEYS_PER_BUCKET = 4


class Mph:
    """Hash-and-displace minimal perfect hash of ``n`` distinct codes onto 0..n-1.

    A bucket with several keys stores the first displacement that sends
    all of them to free slots; a bucket with one key stores the free slot
    itself (as ``-1 - slot``).
    """

    def __init__(self, n: int, seed: int, shift: np.ndarray):
        self.n, self.seed, self.shift = n, seed, shift

    @staticmethod
    def build(codes: np.ndarray) -> "Mph":
        n = len(codes)
        if len(np.unique(codes)) != n:
            raise ValueError("keys must be distinct")
        seed = 0
        while True:
            got = Mph._try(codes, seed)
            if got is not None:
                return got
            seed += 1

    @staticmethod
    def _try(codes: np.ndarray, seed: int) -> "Mph | None":
        n = len(codes)
        r = max(1, -(-n // KEYS_PER_BUCKET))
        bucket = (_mix(codes, 3 * seed) % np.uint64(r)).astype(np.int64)
        base = _mix(codes, 3 * seed + 1)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=r)
        ends = np.cumsum(sizes)
        shift, taken = np.zeros(r, "<i4"), np.zeros(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            k = sizes[b]
            if k <= 1:
                break
            own = base[order[ends[b] - k:ends[b]]]
            for start in range(0, 1 << 20, 256):
                d = np.arange(start, start + 256, dtype=np.uint64)
                slots = (_mix(own[None, :] ^ _mix(d, 7)[:, None], 11) % np.uint64(n)).astype(np.int64)
                ok = ~taken[slots].any(axis=1)
                for row in np.flatnonzero(ok):
                    if len(set(slots[row].tolist())) == k:
                        shift[b] = start + row
                        taken[slots[row]] = True
                        break
                else:
                    continue
                break
            else:
                return None
        free = np.flatnonzero(~taken)
        shift[sizes == 1] = -1 - free[:int((sizes == 1).sum())]
        return Mph(n, seed, shift)

    def slots(self, codes: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(len(codes), np.int64)
        d = self.shift[(_mix(codes, 3 * self.seed) % np.uint64(len(self.shift))).astype(np.int64)].astype(np.int64)
        moved = _mix(_mix(codes, 3 * self.seed + 1) ^ _mix(np.maximum(d, 0).astype(np.uint64), 7), 11) % np.uint64(self.n)
        return np.where(d < 0, -1 - d, moved.astype(np.int64))


def fingerprints(codes: np.ndarray) -> np.ndarray:
    return (_mix(codes, 999) >> np.uint64(32)).astype("<u4")


# ---- shard files ------------------------------------------------------------

_HEAD = "<QQQ"  # keys, buckets, seed


def index_block(codes: np.ndarray, first: np.ndarray, count: np.ndarray, keys: np.ndarray, null: np.ndarray) -> bytes:
    mph = Mph.build(codes)
    slot = mph.slots(codes)
    fp, off, cnt = np.empty(mph.n, "<u4"), np.empty(mph.n, "<u8"), np.empty(mph.n, "<u8")
    fp[slot], off[slot], cnt[slot] = fingerprints(codes), first, count
    return b"".join([struct.pack(_HEAD, mph.n, len(mph.shift), mph.seed), mph.shift.tobytes(), fp.tobytes(), off.tobytes(),
                     cnt.tobytes(), keys.astype("<i8").tobytes(), null.astype("u1").tobytes()])


def _occurrences(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    """How often each key came before, in sorted order."""
    n = len(keys)
    new = np.ones(n, bool)
    new[1:] = (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])
    at = np.arange(n)
    return at - np.maximum.accumulate(np.where(new, at, 0))


class TokenShard:
    """A shard file's bytes with keyed access."""

    def __init__(self, data: bytes):
        magic, self.docs, self.tokens, size, width, _ = struct.unpack_from(TRAILER, data, len(data) - struct.calcsize(TRAILER))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.payload = np.frombuffer(data, f"<u{width}", self.tokens)
        at = len(data) - struct.calcsize(TRAILER) - size
        n, buckets, seed = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        parts = []
        for kind, k in (("<i4", buckets), ("<u4", n), ("<u8", n), ("<u8", n), ("<i8", n), ("u1", n)):
            parts.append(np.frombuffer(data, kind, k, at))
            at += parts[-1].nbytes
        shift, self.fp, self.first, self.count, self.keys, self.null = parts
        self.mph = Mph(n, seed, shift)

    def find(self, keys: np.ndarray, null: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where the stored fingerprint says it is not here."""
        if not self.mph.n:
            return np.full(len(keys), -1)
        codes = key_codes(keys, null, occurrence)
        slot = self.mph.slots(codes)
        return np.where(self.fp[slot] == fingerprints(codes), slot, -1)

    def own_slots(self) -> np.ndarray:
        """Slot of every stored key, in payload order."""
        null = self.null.astype(bool)
        return self.find(self.keys, null, _occurrences(self.keys, null))

    def key_at(self) -> np.ndarray:
        """The key in each slot."""
        out = np.empty(len(self.keys) + 1, np.int64)
        out[self.own_slots()] = self.keys
        return out

    def ids(self, slot: int) -> np.ndarray:
        a = int(self.first[slot])
        return self.payload[a:a + int(self.count[slot])]


def _shard_writer(tokenizer_path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        width = int(enc.dtype[-1])
        end = np.array([end_id], enc.dtype).tobytes()
        keys: list[np.ndarray] = []
        nulls: list[np.ndarray] = []
        counts: list[int] = []
        held: list[bytes] = []
        size = 0

        def row(data: bytes) -> pa.RecordBatch:
            assert data[-1] == 0
            return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], ["value"])

        for batch in batches:
            k = batch.column(0)
            nulls.append(np.asarray(k.is_null().to_numpy(zero_copy_only=False), bool))
            keys.append(k.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            for t in batch.column(1):
                data = enc(t.as_py()) + end
                counts.append(len(data) // width)
                held.append(data)
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield row(b"".join(held))
                    held, size = [], 0
        if not counts:
            return
        if held:
            yield row(b"".join(held))
        key, null, cnt = np.concatenate(keys), np.concatenate(nulls), np.array(counts, np.int64)
        block = index_block(key_codes(key, null, _occurrences(key, null)), np.cumsum(cnt) - cnt, cnt, key, null)
        yield row(block + struct.pack(TRAILER, MAGIC, len(cnt), int(cnt.sum()), len(block), width, 0))

    return write


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, key: str = "doc_id",
                      text: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``docs`` and write its shard files below ``path``; ``end_id`` must be below 2**8 of its high byte."""
    d = docs.select(F.col(key).cast("long").alias("k"), text_or_empty(text).alias("t"))
    shards = max(1, -(-total_bytes(d, "t") // shard_bytes))
    tie = F.xxhash64("t")
    (d.repartitionByRange(shards, F.col("k").asc(), tie.asc()).sortWithinPartitions(F.col("k").asc(), tie.asc(), "t")
     .mapInArrow(_shard_writer(tokenizer_path, end_id), "value binary")
     .select(F.col("value").cast("string").alias("value"))
     .write.text(path, lineSep="\0"))


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """``shard`` (its place in key order) and ``content`` of every non-empty file."""
    return (spark.read.format("binaryFile").load(path).where("length > 0")
            .select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("shard"), "content"))


def _read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _ENCODERS.clear()  # the files are written: this worker lets go of the words it remembers
    for batch in batches:
        for no, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            s = TokenShard(memoryview(content.as_buffer()))
            null, slots = s.null.astype(bool), s.own_slots()
            if (slots < 0).any() or len(np.unique(slots)) != len(slots):
                raise ValueError(f"shard {no}: index and keys disagree")
            crc = [zlib.crc32(s.ids(i).astype("<u4").tobytes()) for i in slots]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.keys, mask=null), pa.array(np.full(len(slots), no, np.int64)),
                 pa.array(s.first[slots].astype(np.int64)), pa.array(s.count[slots].astype(np.int64)),
                 pa.array(crc, pa.int64())], ["doc_id", "shard", "at", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, every document fetched through the shard's hash index.

    ``start`` counts the ids of all documents before it: the sum over
    earlier shards (one row per shard) plus the place in its own shard.
    """
    rows = saved(shard_files(spark, path).mapInArrow(
        _read_docs, "doc_id long, shard long, at long, n_tokens long, ids_crc32 long"), "token-rows")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(totals, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens",
                                             "ids_crc32")


def fetch(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Token ids of a stated list of keys (doc_id, ids), found through the hash index of each shard."""
    wanted = np.array(sorted(set(keys)), np.int64)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                s = TokenShard(memoryview(content.as_buffer()))
                left, occurrence = wanted, 0
                while len(left):
                    slot = s.find(left, np.zeros(len(left), bool), np.full(len(left), occurrence))
                    # a fingerprint can agree by chance: the stored key decides
                    here = (slot >= 0) & (s.key_at()[slot] == left)
                    left, slot, occurrence = left[here], slot[here], occurrence + 1
                    if len(left):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(left), pa.array([s.ids(i).astype(np.int64) for i in slot], pa.list_(pa.int64()))],
                            ["doc_id", "ids"])

    return shard_files(spark, path).mapInArrow(look, "doc_id long, ids array<long>")
