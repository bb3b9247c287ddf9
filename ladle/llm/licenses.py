"""Fuzzy search for short licence notices.

Texts and notices are compared as their lower-cased words joined by single
spaces.  In a notice, the words in brackets tell it from others; they must
stand unchanged, as whole words.  Errors (letters changed, put in or left
out) are allowed in the rest only, one for ``LETTERS_PER_ERROR`` letters of it.

Where a notice has such words, they are its exact seed.  Another notice with
at most ``k`` errors is cut into ``k + 1`` pieces; by the pigeonhole principle
one of them stands in the text unchanged.  An Aho-Corasick automaton over all
seeds finds them in one pass over the whole text.  A seed says where its
notice would begin, give or take ``k`` letters; in this window the regex
library's bounded-error matching verifies the notice and reports its span and
errors.  So work and memory are in proportion to the text and its seeds.

Of overlapping spans the one with the fewest errors stays, of those with
equally many the longest: a span goes to one notice.

Besides, the base phrases are counted wherever their words stand
consecutively.

Defined cases: null text is empty; empty texts have no notice; very long texts
are scanned whole; overlapping places of a phrase all count; of overlapping
spans that tie in errors and length the first counts; repeated rows each get a
row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.decontaminate import words_of

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

NOTICES = {
    "licensed under the [apache] license version 2 0": "apache-2.0",
    "released under the [mit] license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under the [gnu general] public license": "gpl",
    "licensed under the [gnu lesser] general public license": "lgpl",
    "licensed under the [gnu affero] general public license": "agpl",
    "subject to the terms of the [mozilla] public license": "mpl",
    "licensed under [cc by nc]": "cc-by-nc",
    "licensed under [cc by nc nd]": "cc-by-nc-nd",
    "licensed under [cc by nc sa]": "cc-by-nc-sa",
    "licensed under [cc by nd]": "cc-by-nd",
    "licensed under [cc by sa]": "cc-by-sa",
    "creative commons [attribution license]": "cc-by",
    "creative commons [attribution sharealike]": "cc-by-sa",
    "released into the [public domain]": "public-domain",
    "all rights reserved": "reserved",
}
#: One error is allowed for so many letters that may change.
LETTERS_PER_ERROR = 9


def parts(notice: str) -> tuple[str, str, str]:
    """(what stands before, the words that must not change, what stands after)."""
    before, _, rest = notice.partition("[")
    exact, _, after = rest.partition("]")
    return before, exact, after


def errors_of(notice: str) -> int:
    before, _, after = parts(notice)
    return max(1, len(before + after) // LETTERS_PER_ERROR)


def seeds(notice: str) -> list[tuple[int, str]]:
    """Pieces, each with its place, of which one stands unchanged wherever the notice does."""
    before, exact, _ = parts(notice)
    if exact:
        return [(len(before), exact)]
    errors = errors_of(notice)
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


def _pattern(notice: str) -> regex.Pattern:
    """BESTMATCH over the notice; the errors of both changeable parts together are checked by the caller."""
    k = errors_of(notice)
    before, exact, after = parts(notice)
    loose = lambda t: f"(?:{regex.escape(t)}){{e<={k}}}" if t else ""
    fixed = f"(?<![^ ]){regex.escape(exact)}(?![^ ])" if exact else ""
    return regex.compile(f"(?b)(?:{loose(before)}{fixed}{loose(after)})")


class Kept:
    """Spans without overlap; those of one number of errors are tried in order of their places."""

    def __init__(self):
        self.starts: list[int] = []
        self.spans: list[tuple] = []

    def add(self, span: tuple) -> None:
        at = bisect_left(self.starts, span[0])
        if (at and self.spans[at - 1][1] > span[0]) or (at < len(self.starts) and self.starts[at] < span[1]):
            return
        self.starts.insert(at, span[0])
        self.spans.insert(at, span)


class Notices:
    def __init__(self, notices: dict[str, str], base: dict[str, str]):
        import ahocorasick

        self.base = [(f" {p} ".encode(), label) for p, label in base.items()]
        self.auto = ahocorasick.Automaton()
        self.rules, found = [], {}
        for notice, label in notices.items():
            for at, piece in seeds(notice):
                found.setdefault(piece, []).append((len(self.rules), at))
            self.rules.append(("".join(parts(notice)), label, errors_of(notice), _pattern(notice)))
        for piece, where in found.items():
            self.auto.add_word(piece, (len(piece), where))
        self.auto.make_automaton()

    def base_places(self, data: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every place of a base phrase; ``data`` is words with a space at each end."""
        out = []
        for phrase, label in self.base:
            at, counted, words = data.find(phrase), 0, -1
            while at >= 0:
                words += data.count(b" ", counted, at + 1)
                counted = at + 1
                out.append((words, label))
                at = data.find(phrase, at + 1)
        return out

    def fuzzy(self, text: str) -> list[tuple[int, int, int, str, int]]:
        """(start, end, errors, label, letters) of verified notices without overlap, in order."""
        windows = {(rule, end + 1 - size - at) for end, (size, where) in self.auto.iter(text) for rule, at in where}
        found = set()
        for rule, start in windows:
            notice, label, k, pattern = self.rules[rule]
            n = len(notice)
            if start >= 0 and text.startswith(notice, start):
                whole = (not start or text[start - 1] == " ") and text[start + n:start + n + 1] in ("", " ")
                if whole:  # unchanged, the commonest case
                    found.add((start, start + n, 0, label, n))
                    continue
            # the windows' texts are cut with a letter to spare, so that words at their ends are seen whole
            lo, hi = max(0, start - k), min(len(text), start + n + k)
            m = pattern.search(text, lo, hi)
            if m and sum(m.fuzzy_counts) <= k:
                found.add((m.start(), m.end(), sum(m.fuzzy_counts), label, n))
        kept = Kept()
        for span in sorted(found, key=lambda x: (x[2], -x[4], x[0], x[3])):
            kept.add(span)
        return kept.spans


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int64()),
                   ("found", pa.string())])
SCHEMA = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, score double, "
          "spans array<struct<label: string, start: long, end: long, errors: long, found: string>>")


def _scan(notices: dict[str, str], base: dict[str, str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Notices(notices, base)
        for b in batches:
            rows = []
            for t in b.column(1):
                words = words_of(t.as_py())
                data = b" " + b" ".join(words) + b" "
                places = rules.base_places(data)
                text = data[1:-1].decode("utf-8", "surrogatepass")
                spans = rules.fuzzy(text)
                first = [p for p, _ in places]
                own = {label for _, label in places}
                score = 1.0 if places else max([1 - e / n for _, _, e, _, n in spans], default=0.0)
                rows.append((len(words), len(places), min(first, default=None), max(first, default=None), sorted(own),
                             sorted(own | {x[3] for x in spans}), score,
                             [{"label": x[3], "start": x[0], "end": x[1], "errors": x[2], "found": text[x[0]:x[1]]}
                              for x in spans]))
            strings = pa.list_(pa.string())
            kinds = [pa.int64()] * 4 + [strings, strings, pa.float64(), pa.list_(_SPAN)]
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(list(c), k) for c, k in zip(cols, kinds)]],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return work


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", notices: dict[str, str] | None = None,
         base: dict[str, str] | None = None) -> DataFrame:
    """Base places, labels and verified fuzzy spans (places in the joined words) of every row."""
    d = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    return d.mapInArrow(_scan(notices or NOTICES, base or BASE), SCHEMA).withColumnRenamed("id", key)
