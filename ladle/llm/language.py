"""Language identification by compression.

Each language has a zstandard raw-content dictionary: texts of that
language.  A text is compressed once with each dictionary, in pieces of
``PIECE_BYTES`` that each start from the fresh dictionary, and the language
whose dictionary gives the fewest bytes over all pieces is chosen.  So every
part of a long text counts alike.  Where the runner-up is within
``MIN_MARGIN`` of it the choice is marked ``rejected``.

Texts are lower-cased and all else than letters becomes single spaces, so
punctuation, digits and case say nothing.

Learning: dictionaries are fitted on a bounded sample of labelled rows, at
most ``DICT_BYTES`` of text per language from at most ``SAMPLE_ROWS`` rows of
at most ``SAMPLE_TEXT_BYTES`` each, chosen by a hash of the text.
Prediction reads every whole text and never its label, source or id.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
null labels and null ids are not learned from; ties go to the language first
in order; with no language learned all is ``und``; repeated rows each get a
row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DICT_BYTES = 64 << 10
SAMPLE_ROWS = 400
SAMPLE_TEXT_BYTES = 16 << 10
PIECE_BYTES = 16 << 10
LEVEL = 9
MIN_MARGIN = 0.02
UND = "und"

#: ASCII letters lower-cased, other ASCII to a space, all else kept.
LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(LETTERS).split())


def dictionaries(labelled: DataFrame, text: str, lang: str, seed: int = 42) -> dict[str, bytes]:
    """Dictionary content per language from the ``labelled`` rows.

    A hash threshold per language first thins the rows to a few times the
    sample, so no task ranks a whole language.
    """
    x = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("t")).where(
        F.col("lang").isNotNull() & F.col("t").isNotNull() & (F.octet_length("t") <= SAMPLE_TEXT_BYTES))
    u = F.shiftrightunsigned(F.xxhash64("t", F.lit(seed)), 11).cast("double") / F.lit(float(1 << 53))
    counts = {r.lang: r.n for r in x.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    if not counts:
        return {}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, 4.0 * SAMPLE_ROWS / n))).otherwise(share)
    thin = x.withColumn("u", u).where(F.col("u") <= share).dropDuplicates(["lang", "t"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("u", "t"))
    sample = thin.withColumn("r", rank).where(F.col("r") <= SAMPLE_ROWS).orderBy("lang", "r")
    out: dict[str, bytes] = {}
    for r in sample.select("lang", "t").toLocalIterator():
        have = out.setdefault(r.lang, b"")
        if len(have) < DICT_BYTES:
            out[r.lang] = (have + b" " + normal(r.t))[:DICT_BYTES]
    return dict(sorted(out.items()))


def pieces(data: bytes) -> list[bytes]:
    """Consecutive parts of ``data`` of about equal length, at most ``PIECE_BYTES``."""
    n = -(-len(data) // PIECE_BYTES)
    cuts = [len(data) * i // n for i in range(n + 1)]
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


class Classifier:
    def __init__(self, contents: dict[str, bytes], level: int = LEVEL):
        import zstandard as z

        self.langs, self.coders = list(contents), []
        for content in contents.values():
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(z.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False,
                                                write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): score is 1 - 2 ** -(bytes saved over the runner-up)."""
        if not text or not self.langs or not has_letter(text):
            return UND, 0.0, 0.0
        parts = pieces(normal(text))
        sizes = np.array([sum(len(c.compress(p)) for p in parts) for c in self.coders])
        best = int(sizes.argmin())
        if len(sizes) == 1:
            return self.langs[0], 1.0, 1.0
        second = int(np.partition(sizes, 1)[1])
        gain = second - int(sizes[best])
        return self.langs[best], 1.0 - 2.0 ** -min(gain, 60), gain / second


def held_out(key: str) -> Column:
    """Rows kept out of learning: crc32 of the id as text is 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, contents: dict[str, bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score, margin and rejected (a narrow margin) of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(contents)
        for b in batches:
            got = [classify(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64()),
                 pa.array([g[2] < MIN_MARGIN for g in got], pa.bool_())],
                ["id", "held_out", "lang_pred", "score", "margin", "rejected"])

    d = docs.select(F.col(key).cast("long").alias("id"), held_out(key).alias("held_out"), F.col(text).alias("t"))
    return d.mapInArrow(work, "id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean"
                        ).withColumnRenamed("id", key)


def learn_and_identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Dictionaries from the rows that are not held out, then a prediction for every row."""
    return identify(docs, dictionaries(docs.where(F.col(key).isNotNull() & ~held_out(key)), text, lang), key, text)
