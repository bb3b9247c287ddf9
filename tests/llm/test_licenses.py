import random
import re
import time

import pyarrow.parquet as pq
import pytest

from ladle.llm import licenses as lc
from ladle.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, make  # noqa: F401


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def least_errors(notice, text):
    """Fewest errors of the notice at any place of the text (bit-parallel edit distance)."""
    m = len(notice)
    full, top = (1 << m) - 1, 1 << (m - 1)
    eq = {}
    for i, c in enumerate(notice):
        eq[c] = eq.get(c, 0) | 1 << i
    up, down, score, best = full, 0, m, m
    for c in text:
        e = eq.get(c, 0)
        xv = e | down
        xh = (((e & up) + up) ^ up) | e
        ph, mh = down | ~(xh | up) & full, up & xh
        score += bool(ph & top) - bool(mh & top)
        best = min(best, score)
        ph, mh = ph << 1 & full, mh << 1 & full
        up, down = mh | ~(xv | ph) & full, ph & xv
    return best


def distances(pattern, text):
    """Edit distance of ``pattern`` to the best text that ends at each place, whole DP table by rows."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[j - 1] + 1))
        row = new
    return row


def bounded(notice):
    """Errors a notice may have: one for nine letters outside its brackets, at least one."""
    return max(1, len(re.sub(r"\[.*\]", "", notice)) // 9)


def labelled(text):
    """Labels by plain comparison: a notice's bracketed words stand as they are, what is before and after them is
    compared by edit distance; of notices around one place the one with the fewest errors, then the longest, holds."""
    out, claims = set(), {}
    for notice, label in lc.NOTICES.items():
        before, exact, after = re.fullmatch(r"([^\[]*)\[?([^\]]*)\]?(.*)", notice).groups() if "[" in notice else (notice, "", "")
        k = bounded(notice)
        if not exact:
            if least_errors(notice, text) <= k:
                out.add(label)
            continue
        for m in re.finditer(rf"(?<![^ ]){exact}(?![^ ])", text):
            near = text[max(0, m.start() - len(before) - k):m.start()]
            far = text[m.end():m.end() + len(after) + k]
            errors = distances(before, near)[-1] + min(distances(after[::-1], far[::-1][i:])[-1] for i in range(len(far) + 1))
            if errors <= k:
                claims.setdefault(m.start(), []).append((errors, -len(before + exact + after), label))
    return out | {min(c)[2] for c in claims.values()}


def slow(t):
    """Base phrases word by word; notices by ``labelled``."""
    w = words(t)
    places = [(i, label) for p, label in lc.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    text, own = " ".join(w), {x[1] for x in places}
    first = [p for p, _ in places]
    return (len(w), len(places), min(first, default=None), max(first, default=None), sorted(own), sorted(own | labelled(text)))


def test_whole_table_matches_search_without_seeds(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    got = {r.doc_id: r for r in QUERIES["op10_licenses"](spark, SF_SMALL).collect()}
    for r in t:
        g = got[r["doc_id"]]
        want = slow(r["text"])
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels, g.labels) == (
            *want[:4], ",".join(want[4]), ",".join(want[5]))
        assert 0 <= g.score <= 1


def test_altered_notices_are_found(spark, make):
    """Errors in the changeable part of a notice, up to its bound, at places that cost no space."""
    r = random.Random(5)
    rows, labels = [], []
    for i, (notice, label) in enumerate(list(lc.NOTICES.items()) * 3):
        t, loose = list(notice), "[" not in notice
        ends = [j for j, c in enumerate(notice) if (loose or not notice.index("[") <= j <= notice.index("]")) and c.isalpha()]
        for at in sorted(r.sample(ends, min(bounded(notice), len(ends))), reverse=True):
            t[at:at + 1] = r.choice([["q"], [], [t[at], "z"]])
        rows.append((i, "xx yy " + "".join(t).replace("[", "").replace("]", "") + " zz"))
        labels.append(label)
    got = {x.doc_id: x for x in lc.scan(make(rows)).collect()}
    for i, label in enumerate(labels):
        text = " ".join(words(rows[i][1]))
        assert label in got[i].labels, text
        assert slow(rows[i][1])[5] == got[i].labels
        assert all(text[s.start:s.end] == s.found for s in got[i].spans)


@pytest.mark.parametrize("text,labels", [
    ("licensed under cc by 4 0 international", ["cc-by"]), ("licensed under cc by nc nd", ["cc-by", "cc-by-nc-nd"]),
    ("licensed under the gnu lesser general public license", ["gpl", "lgpl"]),
    ("licensed under the gnu affero general public license", ["agpl", "gpl"]),
    ("licensed under the gnu general public license", ["gpl"]), ("licensd under cc by sa", ["cc-by", "cc-by-sa"]),
    ("licensed under cc by sax", ["cc-by"]), ("licensed under cc by", ["cc-by"]), ("released under the nit license", []),
    ("relesed under the mit license", ["mit"]), ("creative commons attribution", [])])
def test_words_that_tell_notices_apart_stand_unchanged(text, labels):
    n = lc.Notices(lc.NOTICES, lc.BASE)
    got = {x[3] for x in n.fuzzy(text)} | {x[1] for x in n.base_places(f" {text} ".encode())}
    assert sorted(got) == labels == slow(text)[5]


def test_every_span_is_reported():
    n = lc.Notices(lc.NOTICES, lc.BASE)
    assert [x[:4] for x in n.fuzzy("all rights reservd all rights reserved")] == [(0, 18, 1, "reserved"), (19, 38, 0, "reserved")]
    text = " ".join(["all rights reserved", "al rights reserved", "all rights rezerved"] * 50)
    spans = n.fuzzy(text)
    assert len(spans) == 150 and [x[2] for x in spans] == [0, 1, 1] * 50
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_time_grows_with_the_text():
    n = lc.Notices(lc.NOTICES, lc.BASE)
    text = "all rights reserved " * 100_000
    begin = time.process_time()
    assert len(n.fuzzy(text)) == 100_000 and len(n.base_places(f" {text}".encode())) == 100_000
    for part in ("cc by nc ", "all right ", "licensed under cc ", "public license "):
        n.fuzzy(part * 20_000)
    assert time.process_time() - begin < 20  # about 3 s; a quadratic step would take minutes


def test_overlapping_places(spark, make):
    (r,) = lc.scan(make([(1, "CC-BY cc by, by cc by")])).collect()
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.score) == (3, 0, 5, ["cc-by"], 1.0)


def test_odd_rows(spark, make):
    got = lc.scan(make(ODD)).collect()
    assert len(got) == len(ODD) and sum(r.n_base for r in got) == 0
    assert lc.scan(make(ODD).limit(0)).count() == 0
