import random
import re

import numpy as np
import pyarrow.parquet as pq
import xxhash

from ladle.llm import simhash as sh
from ladle.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, make  # noqa: F401


def slow_print(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, bits, roots=False):
    """All pairs, union-find: smallest id reachable per row (or the number of groups)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= bits:
                parent[find(i)] = find(j)
    if roots:
        return len({find(i) for i in range(len(prints))})
    groups = {}
    for i, (key, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(key)
    return [(k, f"{fp:016x}", min((x for x in groups[find(i)] if x is not None), default=None)) for i, (k, fp) in enumerate(prints)]


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_whole_table_matches_all_pairs(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    want = slow_groups([(r["doc_id"], slow_print(r["text"])) for r in t], 4)
    assert result(QUERIES["op2_simhash_pivots"](spark, SF_SMALL)) == sorted(want, key=repr)


def test_odd_rows(spark, make):
    want = slow_groups([(k, slow_print(t)) for k, t in ODD], 4)
    assert result(sh.simhash_groups(make(ODD))) == sorted(want, key=repr)
    assert sh.simhash_groups(make(ODD).limit(0)).count() == 0


def ball(n, flips, seed):
    """Fingerprints around one centre, and some far from it."""
    r = random.Random(seed)
    centre, out = r.getrandbits(64), []
    for _ in range(n):
        x = centre if r.random() < 0.8 else r.getrandbits(64)
        for b in r.sample(range(64), r.randrange(flips)):
            x ^= 1 << b
        out.append(x)
    return sorted(set(out))


def test_hot_buckets_lose_no_link(spark, monkeypatch):
    fps = ball(400, 9, 1)
    want = slow_groups(list(enumerate(fps)), 4)
    prints = spark.createDataFrame([(i, int(np.uint64(x).view(np.int64))) for i, x in enumerate(fps)], "id long, fp long")
    for rows in (sh.BUCKET_ROWS, 64):  # as one run, and dealt out in chunks
        monkeypatch.setattr(sh, "BUCKET_ROWS", rows)
        got = {r.fp: r.component_id for r in sh.groups(prints, 4).collect()}
        assert [got[int(np.uint64(x).view(np.int64))] for x in fps] == [w[2] for w in want]


def test_links_stay_few_in_a_dense_group(spark):
    fps = np.array(ball(2000, 3, 2), np.uint64)
    a, _ = sh.Links(4).forest(fps)
    assert len(a) < len(fps)


def test_dedup_keeps_one_of_each_group(spark, make):
    docs = make(ODD)
    kept = sh.simhash_dedup(docs)
    assert kept.columns == docs.columns
    prints = [(k, slow_print(t)) for k, t in ODD]
    assert kept.count() == slow_groups(prints, 4, roots=True)
    assert {r.doc_id for r in kept.collect()} <= {g[2] for g in slow_groups(prints, 4)}
    assert sh.simhash_dedup(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    from ladle.llm.components import components

    edges = [(i, i + 1) for i in range(200)] + [(500, 300), (300, 500), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 500: 300}
