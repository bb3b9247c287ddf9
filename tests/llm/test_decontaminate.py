import random
import re

import numpy as np
import pytest

from ladle.llm import decontaminate as dc
from llm_rows import ODD, make  # noqa: F401

ITEM_SCHEMA = "item_id long, text string"


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(docs, items, window):
    """Every window of every item at every place; longest match by extension."""
    out = []
    for key, t in docs:
        w, hit, names, longest = words(t), set(), set(), 0
        for name, it in items:
            v = words(it)
            if not v:
                continue
            n = min(window, len(v))
            for i in range(len(w)):
                for j in range(len(v) - n + 1):
                    if w[i:i + n] == v[j:j + n]:
                        hit.update(range(i, i + n))
                        names.add("" if name is None else str(name))
                        k = n
                        while i + k < len(w) and j + k < len(v) and w[i + k] == v[j + k]:
                            k += 1
                        longest = max(longest, k)
        out.append((key, len(w), len(hit), sorted(names), longest))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r[0], r.bench_n_words, r.bench_n_hit, r.bench_items, r.bench_longest_words) for r in df.collect()), key=repr)


def corpus(seed, n_words, vocab):
    r = random.Random(seed)
    word = [f"w{i}" for i in range(vocab)] + ["É", "X1"]
    text = lambda n: " ".join(r.choice(word) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 4, 7, 12, 30]))) for i in range(25)] + [(90, None), (91, " .,"), (None, "w1 w2 w3"), (3, "w0 W1")]
    docs = [(i, text(r.randrange(n_words))) for i in range(30)]
    for i in range(10):  # whole items and parts of them inside documents
        v = words(items[r.randrange(25)][1])
        a = r.randrange(len(v))
        docs.append((100 + i, f"{text(5)}, {' '.join(v[a:])}! {text(5)} {' '.join(v)}"))
    return docs + ODD[:8], items


@pytest.mark.parametrize("seed,window,vocab", [(1, 4, 6), (2, 3, 40), (3, 10, 3)])
def test_matches_brute_force(spark, make, monkeypatch, seed, window, vocab):
    docs, items = corpus(seed, 60, vocab)
    bench = spark.createDataFrame(items, ITEM_SCHEMA)
    want = slow(docs, items, window)
    assert got(dc.mark(make(docs), bench, window=window)) == want
    # the benchmark in many blocks gives the same hits and items; the longest match is within a block's items anyway
    assert got(dc.mark(make(docs), bench, window=window, block_bytes=200)) == want


def test_small_shards(monkeypatch):
    docs, items = corpus(4, 60, 8)
    test = dc.TestSuffixes([(str(i), t) for i, t in items if t], 4)
    numbers = [np.array([test.vocab.get(w.encode(), 0) for w in words(t)], np.int64) for _, t in docs]
    whole = dc.search_shard(np.concatenate([np.append(x, 0) for x in numbers]), np.cumsum([len(x) + 1 for x in numbers]) - 1, test)
    for d, x in enumerate(numbers):
        one = dc.search_shard(np.append(x, 0), np.array([len(x)]), test)
        mine = whole["doc"] == d
        assert sorted(zip(one["at"], one["len"])) == sorted(zip(whole["at"][mine], whole["len"][mine]))


def test_suffixes_are_sorted():
    r = np.random.default_rng(0)
    ids = r.integers(0, 4, 3000)
    test = dc.TestSuffixes([("a", " ".join(f"w{i}" for i in range(300)))], 5)
    sa = dc.SuffixArray(ids, test)
    cut = lambda p: tuple(ids[p:p + sa.run[p]])
    keys = [cut(p) for p in sa.sa]
    assert keys == sorted(keys) and sorted(sa.sa) == np.flatnonzero(ids).tolist()


def test_decontaminate_keeps_columns_and_clean_rows(spark, make):
    docs = make([(1, "a b c d"), (2, "x a b c"), (3, None), (4, "q")]).withColumnRenamed("lang", "bench_n_hit")
    bench = spark.createDataFrame([(1, "a b c")], ITEM_SCHEMA)
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4]
    assert dc.decontaminate(docs, bench.limit(0)).count() == 4
    assert dc.decontaminate(docs.limit(0), bench).count() == 0


def test_many_blocks_are_one_pass_a_stage(spark, make):
    """Each block of a large benchmark has a stage of its own, and the marks are those of one block."""
    docs = make([(i, f"a{i} b{i} c{i} d{i} shared words of all items e{i}") for i in range(30)])
    items = spark.createDataFrame([(f"i{i}", f"a{i} b{i} c{i} d{i}" if i % 2 else "shared words of all items") for i in range(40)],
                                  "item_id string, text string")
    one = dc.mark(docs, items, window=4)
    many = dc.mark(docs, items, window=4, block_bytes=60)
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    plain = [c for c in one.columns if c != "bench_longest_item"]  # several items have the longest match
    key = lambda df: sorted(map(str, df.select(*plain).collect()))
    assert key(many) == key(one)
