"""Fixtures and rows shared by the tests of this folder."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"

#: Rows that every operator must take: nulls, empty and long texts, repeats.
ODD = [(1, None), (2, ""), (3, "   \t\n"), (None, "no id here at all"), (5, "same text twice over"), (5, "same text twice over"),
       (5, "same id, other text"), (8, "ß İ Σ \x1c   é日本"), (9, "word " * 6000), (10, "x" * 20000), (-4, "one")]

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples, over several partitions."""
    def build(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(parts)
    return build

