import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ladle.llm import pseudo_lm as lm
from ladle.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, make  # noqa: F401


def slow_log_prob(m, ids, i):
    """One token, in plain Python numbers."""
    pad = [lm.TOKENS] * lm.SIDE + list(ids) + [lm.TOKENS] * lm.SIDE
    i += lm.SIDE
    h = [math.tanh(float(m["bias"][k]) + sum(float(m["embed"][s][pad[i + o]][k]) for s, o in enumerate(lm.OFFSETS)))
         for k in range(lm.HIDDEN)]

    def log_softmax(w, b, at):
        z = [float(b[j]) + sum(h[k] * float(w[k][j]) for k in range(lm.HIDDEN)) for j in range(len(b))]
        return z[at] - math.log(sum(map(math.exp, z)))

    c, j = divmod(pad[i], lm.MEMBERS)
    return log_softmax(m["class_w"], m["class_b"], c) + log_softmax(m["member_w"][c], m["member_b"][c], j)


def test_log_probs_match_plain_python():
    flat = np.random.default_rng(1).normal(0, 0.5, lm.SIZE).astype(np.float32)
    docs = [np.array(random.Random(s).choices(range(lm.TOKENS), k=n), np.int64) for s, n in enumerate([5, 0, 1, 9])]
    ids, at = lm.joined(docs)
    want = [slow_log_prob(lm.unpack(flat), d, i) for d in docs for i in range(len(d))]
    assert lm.log_probs(lm.unpack(flat), ids, at) == pytest.approx(want, abs=1e-4)


def test_probabilities_sum_to_one():
    m = lm.unpack(np.random.default_rng(2).normal(0, 0.5, lm.SIZE).astype(np.float32))
    ids = np.array([lm.TOKENS] * 2 + [3, 0, 8] + [lm.TOKENS] * 2)
    total = 0.0
    for t in range(lm.TOKENS):
        ids[3] = t
        total += math.exp(lm.log_probs(m, ids, np.array([3]))[0])
    assert total == pytest.approx(1, abs=1e-4)


def test_step_follows_the_gradient():
    flat = np.random.default_rng(3).normal(0, 0.3, lm.SIZE).astype(np.float32)
    ids, at = lm.joined([np.array(random.Random(9).choices(range(lm.TOKENS), k=40), np.int64)])
    before = lm.log_probs(lm.unpack(flat), ids, at).sum()
    seen, moved = np.full(lm.SIZE, 1.0, np.float32), flat.copy()
    lm.train_step(moved, seen, ids, at)
    grad = (flat - moved) / lm.RATE * np.sqrt(seen)
    for k in np.argsort(-np.abs(grad))[:5]:
        up = flat.astype(np.float64).copy()
        up[k] += 1e-3
        slope = -(lm.log_probs(lm.unpack(up), ids, at).sum() - lm.log_probs(lm.unpack(flat.astype(np.float64)), ids, at).sum()) / 1e-3
        assert grad[k] == pytest.approx(slope / len(at), rel=0.05)
    assert lm.log_probs(lm.unpack(moved), ids, at).sum() > before


def test_whole_table_matches_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = docs.select(docs.text.alias("t"))
    known, counts = lm.vocabulary(texts)
    from collections import Counter

    c = Counter(w for r in docs.collect() for w in lm.split(r.text))
    assert [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:lm.KNOWN]] == sorted(known, key=known.get)
    assert counts.sum() == sum(c.values())
    flat = lm.train(texts, known, counts, rounds=1)
    got = {r.doc_id: r for r in lm.score(docs, known, flat).collect()}
    m = lm.unpack(flat)
    for r in docs.limit(3).collect():
        x = lm.numbers(lm.split(r.text), known)
        assert got[r.doc_id].n_tokens == len(x)
        assert got[r.doc_id].log_likelihood == pytest.approx(sum(slow_log_prob(m, x, i) for i in range(min(len(x), 10**6))), rel=1e-3)


def test_order_of_words_matters(spark, make):
    r = random.Random(4)
    line = "the cat sat on the mat and the dog ran to the park with a ball".split()
    rows = [(i, " ".join(line[(i + k) % len(line)] for k in range(120))) for i in range(80)]
    known, counts = lm.vocabulary(make(rows, 1).selectExpr("text as t"))
    flat = lm.train(make(rows * 20, 1).selectExpr("text as t"), known, counts, rounds=2)
    shuffled = line * 8
    r.shuffle(shuffled)
    got = {x.doc_id: x.mean_log_prob for x in lm.score(make([(1, " ".join(line * 8)), (2, " ".join(shuffled))]), known, flat).collect()}
    assert got[1] > got[2] + 0.2


def test_odd_rows(spark, make):
    got = lm.train_and_score(make(ODD)).collect()
    assert len(got) == len(ODD)
    assert all(r.log_likelihood == 0 and r.n_tokens == 0 for r in got if r.doc_id in (1, 2, 3))
    assert all(r.log_likelihood < 0 for r in got if r.n_tokens)
    assert lm.train_and_score(make(ODD).limit(0)).count() == 0
    assert QUERIES["op5_pseudo_likelihood"](spark, SF_SMALL).count() == 200


def test_words_in_one_bucket_have_their_own_probability(spark, make, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_WORDS", 50)
    common = [f"w{i:04}" for i in range(lm.KNOWN)]
    often = next(w for w in (f"often{i}" for i in range(9999)) if zlib.crc32(w.encode()) % lm.HASHED == 7)
    rare = next(w for w in (f"rare{i}" for i in range(9999)) if zlib.crc32(w.encode()) % lm.HASHED == 7)
    rows = [(i, " ".join(common)) for i in range(6)] + [(10 + i, f"w0001 {often} w0002") for i in range(5)] + [(20, f"w0001 {rare} w0002")]
    rows += [(30 + i, " ".join(f"x{i}y{j}" for j in range(40))) for i in range(4)]
    got = {r.doc_id: r for r in lm.train_and_score(make(rows)).collect()}
    assert len(got) == len(rows)
    assert got[10].log_likelihood - got[20].log_likelihood == pytest.approx(math.log(5), abs=1e-3)

    texts = make(rows).selectExpr("text as t")
    words = lm.word_counts(texts)
    known, counts = lm.vocabulary(texts, words)
    flat = lm.initial(counts)
    docs = make(rows + [(99, f"w0001 unseen-{rare}")])
    net = {r.doc_id: r for r in lm.score(docs, known, flat).collect()}
    full = {r.doc_id: r for r in lm.score_words(lm.coded(docs, known), words, counts, flat).collect()}
    n = Counter(w for _, t in rows for w in lm.split(t))
    for k, t in rows + [(99, f"w0001 unseen-{rare}")]:
        odd = [w for w in lm.split(t) if w not in known]
        want = sum((math.log(n[w]) if w in n else -(len(w) + 1) * math.log(257)) - math.log(counts[lm.KNOWN + zlib.crc32(w) % lm.HASHED] + 1)
                   for w in odd)
        assert full[k].n_tokens == net[k].n_tokens
        assert full[k].log_likelihood == pytest.approx(net[k].log_likelihood + want, rel=1e-4)


def test_every_token_is_masked_once(spark, make, monkeypatch):
    for n, rounds in ((1, 2), (7, 2), (100, 2), (100, 1), (33, 8), (5, 3)):
        places = np.concatenate([p for turn in range(rounds) for p in lm.masked(n, turn, rounds)])
        assert sorted(places) == list(range(n))
    seen = []
    monkeypatch.setattr(lm, "train_step", lambda flat, squares, ids, at: seen.extend(ids[at]))
    known = {b"w%d" % i: i for i in range(50)}
    text = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{i}" for i in range(50)), "w1 w2", None])], ["t"])
    for turn in range(lm.ROUNDS):
        for _ in lm._trainer(lambda t: lm.numbers(lm.split(t.as_py()), known), lm.initial(np.ones(lm.TOKENS)), turn, lm.ROUNDS)(iter([text])):
            pass
    assert sorted(seen) == sorted([*range(50), 1, 2])
