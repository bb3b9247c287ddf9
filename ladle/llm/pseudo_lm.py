"""Language-model scoring by masked pseudo-likelihood.

A small bidirectional network in numpy predicts every token from the
``SIDE`` tokens to its left and to its right, itself masked.  A document's
score is the sum of the conditional log-probabilities of all its tokens.

Tokens are lower-cased words: the most frequent ones by counts over the whole
corpus, and hash buckets for all others.  The output is a softmax in two
steps, first the token's class (of neighbouring frequency ranks), then the
token in its class; its biases start at the corpus frequencies.  A word in a
bucket has besides its own probability within the bucket, ``n / (N + 1)`` for
``n`` of the bucket's ``N`` tokens; words that the corpus lacks share the one
part left over by their spelling (``257 ** -(bytes + 1)`` each).  So every word has its own
probability, and those of all words sum to at most one.

Texts are written once as token numbers.  Words in buckets are numbered within
chunks of rows; one equi-join of the chunks' distinct words with the word
counts gives their probabilities, which go back to the chunk's rows.

Training covers every token of all documents once: in every round each
partition trains on its own documents, starting from the common weights, with
every ``MASK_EVERY``-th token masked at a time.  The rounds share the
``MASK_EVERY`` offsets among them, so over all rounds each token is masked in
exactly one step.  The weights are averaged by the number of tokens.  The partitions' weights are summed
in Spark in two steps by block of weights, so neither a task nor the driver
receives more than a few models; the driver holds one.

Defined cases: null or wordless text has no token and score 0; a text of one
word is predicted from boundary marks alone; an empty corpus gives no rows;
repeated rows each get a row and count each; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import saved

CLASSES = 32
MEMBERS = 32
TOKENS = CLASSES * MEMBERS
HASHED = 64
KNOWN = TOKENS - HASHED
HIDDEN = 16
SIDE = 2
MASK_EVERY = 8
ROUNDS = 2
STEP_TOKENS = 4096
SCORE_TOKENS = 32_768
RATE = 0.1
BATCH_TOKENS = 1 << 16
COUNTER_WORDS = 300_000
CHUNK_WORDS = 300_000
PACKED_ROWS = 1 << 19
BLOCK = 4096
SPREAD = 16
SEED = 42


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def numbers(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    crc = zlib.crc32
    return np.array([known[w] if w in known else KNOWN + crc(w) % HASHED for w in words], np.int64)


# ---- corpus counts ----------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                          ["word", "n"])
        counts.clear()
        return rows

    for b in batches:
        for t in b.column(0):
            counts.update(split(t.as_py()))
            if len(counts) > COUNTER_WORDS:
                yield out()
    yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of every word of the corpus, written once."""
    return saved(texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def vocabulary(texts: DataFrame, words: DataFrame | None = None) -> tuple[dict[bytes, int], np.ndarray]:
    """Known words by number, and the corpus count of every token number."""
    words = word_counts(texts) if words is None else words
    top = words.orderBy(F.col("n").desc(), "word").limit(KNOWN).collect()
    known = {bytes(r.word): i for i, r in enumerate(top)}
    counts = np.zeros(TOKENS)
    counts[:len(top)] = [r.n for r in top]
    for r in words.groupBy((F.crc32("word") % HASHED).alias("k")).agg(F.sum("n").alias("n")).collect():
        counts[KNOWN + r.k] = r.n
    for w, i in known.items():
        counts[KNOWN + zlib.crc32(w) % HASHED] -= counts[i]
    return known, counts


# ---- texts as numbers -------------------------------------------------------

_CODED = "chunk long, id long, tokens binary, odd binary, at long, word binary"


class Codes(dict):
    """Known words by number; other words, as they come, by ``KNOWN`` and their place in ``own``."""

    def __init__(self, known: dict[bytes, int]):
        super().__init__(known)
        self.own: list[bytes] = []
        self.buckets = array("H")

    def __missing__(self, word: bytes) -> int:
        code = self[word] = KNOWN + len(self.own)
        self.own.append(word)
        self.buckets.append(KNOWN + zlib.crc32(word) % HASHED)
        return code

    def split(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of all words, and the places of those that are not known."""
        x = np.array(list(map(self.__getitem__, words)), np.int64)
        odd = x >= KNOWN
        own = x[odd] - KNOWN
        x[odd] = np.array(self.buckets, np.int64)[own] if len(own) > len(self.own) else [self.buckets[i] for i in own]
        return x, own


def _coder(known: dict[bytes, int]):
    """Rows of texts (token numbers, and the places of their bucket words in the chunk's list), and the lists' words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        codes = Codes(known)

        def out(chunks, ids, tokens, odd, at, words) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(chunks, pa.int64()), ids, pa.array(tokens, pa.binary()), pa.array(odd, pa.binary()),
                 pa.array(at, pa.int64()), pa.array(words, pa.binary())], ["chunk", "id", "tokens", "odd", "at", "word"])

        def listed() -> pa.RecordBatch:
            nonlocal codes
            n = len(codes.own)
            rows = out(np.full(n, chunk), pa.nulls(n, pa.int64()), [None] * n, [None] * n, np.arange(n), codes.own)
            codes = Codes(known)
            return rows

        for b in batches:
            chunks, tokens, odd = [], [], []
            for t in b.column(1):
                x, own = codes.split(split(t.as_py()))
                chunks.append(chunk)
                tokens.append(x.astype(np.uint16).tobytes())
                odd.append(own.astype(np.uint32).tobytes())
                if len(codes.own) > CHUNK_WORDS:
                    yield listed()
                    chunk += 1
            n = len(chunks)
            yield out(chunks, b.column(0), tokens, odd, pa.nulls(n, pa.int64()), [None] * n)
        if codes.own:
            yield listed()

    return work


def coded(docs: DataFrame, known: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text as token numbers and the chunks' words (rows with a word), written once."""
    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    return saved(d.mapInArrow(_coder(known), _CODED), "token-numbers")


def word_log_probs(words: DataFrame, counts: DataFrame, sizes: np.ndarray) -> DataFrame:
    """``words`` with ``lp``, the log-probability of the word in its bucket; ``sizes`` has the corpus count of every token number."""
    left = F.element_at(F.array(*[F.lit(float(np.log(max(n, 0) + 1))) for n in sizes[KNOWN:]]),
                        (F.crc32("word") % HASHED + 1).cast("int"))
    spelled = -(F.octet_length("word") + 1) * F.lit(float(np.log(257)))
    return words.join(counts, "word", "left").withColumn("lp", F.coalesce(F.ln("n"), spelled) - left).drop("n")


# ---- network ----------------------------------------------------------------

SHAPES = {"embed": (2 * SIDE, TOKENS + 1, HIDDEN), "bias": (HIDDEN,), "class_w": (HIDDEN, CLASSES), "class_b": (CLASSES,),
          "member_w": (CLASSES, HIDDEN, MEMBERS), "member_b": (CLASSES, MEMBERS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = flat[at:at + n].reshape(s)
        at += n
    return out


def initial(counts: np.ndarray) -> np.ndarray:
    flat = np.random.default_rng(SEED).normal(0, 0.1, SIZE).astype(np.float32)
    m = unpack(flat)
    grid = (np.maximum(counts, 0) + 1.0).reshape(CLASSES, MEMBERS)
    m["bias"][:] = 0
    m["class_b"][:] = np.log(grid.sum(axis=1) / grid.sum())
    m["member_b"][:] = np.log(grid / grid.sum(axis=1, keepdims=True))
    return flat


OFFSETS = (*range(-SIDE, 0), *range(1, SIDE + 1))


def joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents in one array with boundary marks between, and the places of their tokens."""
    mark = np.full(SIDE, TOKENS, np.int64)
    ids = np.concatenate([mark, *[x for d in docs for x in (d, mark)]])
    return ids, np.flatnonzero(ids != TOKENS)


def hidden(m: dict[str, np.ndarray], ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = m["bias"] + m["embed"][0][ids[at + OFFSETS[0]]]
    for k, o in enumerate(OFFSETS[1:], 1):
        h += m["embed"][k][ids[at + o]]
    return np.tanh(h, out=h)


def _exp(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(z - max) in place, its sum, and the log of the normalizer, by column (long rows: the quick direction)."""
    top = z.max(axis=0)
    z -= top
    np.exp(z, out=z)
    s = z.sum(axis=0)
    return s, np.log(s) + top


def _softmax(z: np.ndarray) -> np.ndarray:
    """Probabilities by column, in place."""
    z /= _exp(z)[0]
    return z


def _by_class(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """The places in order of their tokens' classes: (order, class, member, the slice of each class that occurs)."""
    cls, member = np.divmod(ids[at], MEMBERS)
    order = np.argsort(cls.astype(np.uint8), kind="stable")  # few bits: sorted by counting
    cls, member = cls[order], member[order]
    cuts = np.searchsorted(cls, np.arange(CLASSES + 1))
    return order, cls, member, [(c, slice(cuts[c], cuts[c + 1])) for c in np.flatnonzero(np.diff(cuts))]


def log_probs(m: dict[str, np.ndarray], ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of the token at each place, given its neighbours."""
    order, cls, member, slices = _by_class(ids, at)
    h = np.ascontiguousarray(hidden(m, ids, at[order]).T)
    z = m["class_w"].T @ h + m["class_b"][:, None]
    own = z[cls, np.arange(len(at))]
    lp = own - _exp(z)[1]
    for c, rows in slices:
        z = m["member_w"][c].T @ h[:, rows] + m["member_b"][c][:, None]
        own = z[member[rows], np.arange(z.shape[1])]
        lp[rows] += own - _exp(z)[1]
    out = np.empty_like(lp)
    out[order] = lp
    return out


def train_step(flat: np.ndarray, seen: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
    """One Adagrad step on the masked places; changes ``flat`` and the summed squares ``seen``."""
    m, grad = unpack(flat), np.zeros_like(flat)
    g, n = unpack(grad), len(at)
    order, cls, member, slices = _by_class(ids, at)
    at = at[order]
    h = np.ascontiguousarray(hidden(m, ids, at).T)
    p = _softmax(m["class_w"].T @ h + m["class_b"][:, None])
    p[cls, np.arange(n)] -= 1
    g["class_w"][:], g["class_b"][:] = h @ p.T, p.sum(axis=1)
    dh = m["class_w"] @ p
    for c, rows in slices:
        x = h[:, rows]
        p = _softmax(m["member_w"][c].T @ x + m["member_b"][c][:, None])
        p[member[rows], np.arange(x.shape[1])] -= 1
        g["member_w"][c], g["member_b"][c] = x @ p.T, p.sum(axis=1)
        dh[:, rows] += m["member_w"][c] @ p
    dz = np.ascontiguousarray((dh * (1 - h * h)).T)
    g["bias"][:] = dz.sum(axis=0)
    columns = np.arange(HIDDEN)
    for k, o in enumerate(OFFSETS):
        cells = (ids[at + o] * HIDDEN)[:, None] + columns
        g["embed"][k] = np.bincount(cells.ravel(), dz.ravel(), (TOKENS + 1) * HIDDEN).reshape(TOKENS + 1, HIDDEN)
    grad /= n
    seen += grad * grad
    flat -= RATE * grad / (np.sqrt(seen) + 1e-6)


# ---- training over the corpus -----------------------------------------------

def _tokens(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.uint16).astype(np.int64)


def masked(n: int, turn: int, rounds: int) -> Iterator[np.ndarray]:
    """The masked ones of ``n`` tokens, one offset after the other, in round ``turn``; all rounds together mask each once."""
    for offset in range(turn, MASK_EVERY, rounds):
        yield np.arange(offset, n, MASK_EVERY)


def _trainer(read: Callable[[pa.Scalar], np.ndarray], start: np.ndarray, turn: int, rounds: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, seen, done, salt = start.copy(), np.full(SIZE, 1e-4, np.float32), 0, 0
        held: list[np.ndarray] = []
        size = 0

        def learn() -> None:
            nonlocal done, held, size
            ids, at = joined(held)
            for places in masked(len(at), turn, rounds):
                for s in range(0, len(places), STEP_TOKENS):
                    train_step(flat, seen, ids, at[places[s:s + STEP_TOKENS]])
                done += len(places)
            held, size = [], 0

        for b in batches:
            for t in b.column(0):
                x = read(t)
                held.append(x)
                size += len(x)
                salt = zlib.crc32(x[:64].tobytes(), salt)
                if size >= STEP_TOKENS * MASK_EVERY:
                    learn()
        if size:
            learn()
        if done:
            total = flat.astype(np.float64) * done
            cuts = range(0, SIZE, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cuts)), pa.int64()), pa.array([salt % SPREAD] * len(cuts), pa.int64()),
                 pa.array([done] * len(cuts), pa.int64()), pa.array([total[c:c + BLOCK].tobytes() for c in cuts], pa.binary())],
                ["block", "salt", "n", "weights"])

    return work


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], list] = {}
    for b in batches:
        for block, salt, n, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
            x = np.frombuffer(w.as_buffer(), np.float64)
            own = sums.setdefault((block, salt), [0, np.zeros(len(x))])
            own[0] += n
            own[1] += x
    keys = list(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
         pa.array([sums[k][0] for k in keys], pa.int64()), pa.array([sums[k][1].tobytes() for k in keys], pa.binary())],
        ["block", "salt", "n", "weights"])


_WEIGHTS = "block long, salt long, n long, weights binary"


def train(texts: DataFrame, known: dict[bytes, int], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    return _rounds(texts, lambda t: numbers(split(t.as_py()), known), counts, rounds)


def train_coded(rows: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    return _rounds(rows.where("word is null").select("tokens"), _tokens, counts, rounds)


def _rounds(rows: DataFrame, read: Callable[[pa.Scalar], np.ndarray], counts: np.ndarray, rounds: int) -> np.ndarray:
    flat = initial(counts)
    for turn in range(rounds):
        parts = rows.mapInArrow(_trainer(read, flat, turn % MASK_EVERY, min(rounds, MASK_EVERY)), _WEIGHTS)
        some = parts.repartition("block", "salt").mapInArrow(_sum_blocks, _WEIGHTS).withColumn("salt", F.lit(0).cast("long"))
        got = some.repartition("block").mapInArrow(_sum_blocks, _WEIGHTS).orderBy("block").collect()
        if got:
            flat = np.concatenate([np.frombuffer(r.weights, np.float64) / r.n for r in got]).astype(np.float32)
    return flat


def _sums(m: dict[str, np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens and summed log-probability of every document."""
    sizes = np.array([len(x) for x in docs], np.int64)
    sums = np.zeros(len(docs))
    start = 0
    while start < len(docs):
        end, held = start, 0
        while end < len(docs) and (held == 0 or held + sizes[end] <= BATCH_TOKENS):
            held += sizes[end]
            end += 1
        if held:
            ids, at = joined(docs[start:end])
            lp = np.concatenate([log_probs(m, ids, at[s:s + SCORE_TOKENS]) for s in range(0, len(at), SCORE_TOKENS)])
            whose = np.repeat(np.arange(start, end), sizes[start:end])
            sums += np.bincount(whose, weights=lp, minlength=len(docs))
        start = end
    return sizes, sums


def score(docs: DataFrame, known: dict[bytes, int], flat: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, log_likelihood and its mean per token, of every row, from the network alone (buckets as tokens)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = unpack(flat)
        for b in batches:
            sizes, sums = _sums(m, [numbers(split(t.as_py()), known) for t in b.column(1)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(sums),
                                              pa.array(sums / np.maximum(sizes, 1))],
                                             ["id", "n_tokens", "log_likelihood", "mean_log_prob"])

    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    return d.mapInArrow(work, "id long, n_tokens long, log_likelihood double, mean_log_prob double").withColumnRenamed("id", key)


_PARTS = "chunk long, kind int, id long, n_tokens long, log_likelihood double, odd binary, lp binary"


def _parts(chunk, kind: int, n: int, **own) -> pa.RecordBatch:
    """Rows of ``_PARTS``; columns not given are null."""
    kinds = {"id": pa.int64(), "n_tokens": pa.int64(), "log_likelihood": pa.float64(), "odd": pa.binary(), "lp": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array([kind] * n, pa.int32()),
         *[own[k] if k in own else pa.nulls(n, t) for k, t in kinds.items()]], ["chunk", "kind", *kinds])


def _networked(flat: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = unpack(flat)
        for b in batches:
            sizes, sums = _sums(m, [_tokens(t) for t in b.column(2)])
            yield _parts(b.column(0), 1, len(sizes), id=b.column(1), n_tokens=pa.array(sizes), log_likelihood=pa.array(sums),
                         odd=b.column(3))

    return work


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, at, lp) rows as one row per chunk and some hundred thousand rows: places, then log-probabilities."""
    held: list[list[np.ndarray]] = []
    size = 0

    def out() -> pa.RecordBatch:
        chunk, at, lp = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(chunk, kind="stable")
        chunk, at, lp = chunk[order], at[order], lp[order]
        names, starts = np.unique(chunk, return_index=True)
        ends = [*starts[1:], len(chunk)]
        held.clear()
        return _parts(names, 0, len(names),
                      odd=pa.array([at[a:b].astype(np.uint32).tobytes() for a, b in zip(starts, ends)], pa.binary()),
                      lp=pa.array([lp[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()))

    for b in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
        size += b.num_rows
        if size >= PACKED_ROWS:
            yield out()
            size = 0
    if size:
        yield out()


def _with_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of the rows; a chunk's words come before its rows."""
    now, table = None, np.zeros(0)
    for b in batches:
        ids, sizes, sums = [], [], []
        for chunk, kind, id_, n, total, odd, lp in zip(*[c.to_pylist() for c in b.columns]):
            if chunk != now:
                now, table = chunk, np.zeros(0)
            at = np.frombuffer(odd, np.uint32)
            if kind == 0:
                if at.max() >= len(table):
                    table = np.concatenate([table, np.zeros(int(at.max()) + 1 + len(table))])
                table[at] = np.frombuffer(lp, np.float64)
            else:
                ids.append(id_)
                sizes.append(n)
                sums.append(total + float(table[at].sum()))
        n = np.array(sizes, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n), pa.array(sums, pa.float64()),
             pa.array(np.array(sums, np.float64) / np.maximum(n, 1))], ["id", "n_tokens", "log_likelihood", "mean_log_prob"])


def score_words(rows: DataFrame, words: DataFrame, counts: np.ndarray, flat: np.ndarray, key: str = "doc_id") -> DataFrame:
    """As ``score``, over ``coded`` rows, with every word's probability in its bucket."""
    nets = rows.where("word is null").select("chunk", "id", "tokens", "odd").mapInArrow(_networked(flat), _PARTS)
    lps = word_log_probs(rows.where("word is not null").select("chunk", "at", "word"), words, counts).select("chunk", "at", "lp")
    both = nets.union(lps.mapInArrow(_packed, _PARTS)).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return both.mapInArrow(_with_words, "id long, n_tokens long, log_likelihood double, mean_log_prob double"
                           ).withColumnRenamed("id", key)


def train_and_score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    texts = docs.select(F.col(text).alias("t"))
    words = word_counts(texts)
    known, counts = vocabulary(texts, words)
    rows = coded(docs, known, key, text)
    return score_words(rows, words, counts, train_coded(rows, counts), key)
