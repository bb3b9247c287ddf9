import hashlib
import re
import struct

import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

from ladle.llm import minhash as mh
from ladle.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, make  # noqa: F401


def chain(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<Q", v), h)
    return h


def slow_print(text):
    """Bins filled one by one, probes tried one by one."""
    words = re.split(r"[\x20\x09-\x0D]+", text.lstrip(" "))
    if len(words) < 5:
        h = 42
        hw = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        hashes = [chain(hw)]
    else:
        hw = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        hashes = [chain(hw[i:i + 5]) for i in range(len(hw) - 4)]
    bins = {}
    for h in hashes:
        b = h >> 57
        bins[b] = min(bins.get(b, h), h)
    first, inverse = mh._probes()
    out = []
    for b in range(128):
        j, step = b, pow(inverse[b], -1, 128)
        if b not in bins:
            j = first[b]
            while j not in bins:
                j = (j + step) % 128
        out.append(f"{bins[j] & 255:02x}")
    return "".join(out)


def slow_like(a, b):
    m = sum(a[i:i + 2] == b[i:i + 2] for i in range(0, 256, 2)) / 128
    return max((m - 1 / 256) / (1 - 1 / 256), 0.0)


def slow_rows(rows):
    out = []
    for i, (key, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        m = len(t) // 3
        e = t[:len(t) - m] + n[:m]
        fp, fe, fn = slow_print(t), slow_print(e), slow_print(n)
        out.append((key, len(t), hashlib.sha256(e.encode()).hexdigest(), fp, fe, round(slow_like(fp, fe), 9), round(slow_like(fp, fn), 9)))
    return out


def result(df):
    return sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
                   round(r.near_next, 9)) for r in df.collect())


def test_whole_table_matches_brute_force(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in t), reverse=True)
    assert result(QUERIES["op3_minhash"](spark, SF_SMALL)) == sorted(slow_rows(rows))


def test_odd_rows(spark, make):
    got = mh.next_fingerprints(make(ODD)).collect()
    assert len(got) == len(ODD)
    by_text = {}
    for r in got:
        by_text.setdefault(r.doc_id, []).append(r.fingerprint)
    assert {f for f in by_text[1]} == {f for f in by_text[2]}  # null and empty texts are alike
    assert len(set(by_text[5])) == 2
    assert mh.next_fingerprints(make(ODD).limit(0)).count() == 0


def test_one_document_is_its_own_next(spark, make):
    (r,) = mh.next_fingerprints(make([(7, "a b c d e f g h i")])).collect()
    assert r.near_next == 1.0


def test_next_over_many_chunks_and_a_hot_id(spark, make):
    rows = [(i * i, f"text number {i} of them all") for i in range(300)] + [(12, f"row {j} of the hot id") for j in range(300)]
    got = mh.next_fingerprints(make(rows, 5).where("doc_id >= 0"), chunk_bytes=100).collect()
    assert len(got) == len(rows)
    prints = {slow_print(t): (k, t) for k, t in rows}
    edited = {r.edited_sha256 for r in got if r.doc_id > 12}
    big = sorted((r for r in rows if r[0] > 12), reverse=True)
    want = set()
    for (k, t), (_, n) in zip(big, big[1:]):
        m = len(t) // 3
        want.add(hashlib.sha256((t[:len(t) - m] + n[:m]).encode()).hexdigest())
    assert want <= edited and {prints[r.fingerprint][0] for r in got} == {k for k, _ in rows}


def test_estimate_is_unbiased(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for s in range(60):
        base = words[s * 60:s * 60 + 400]
        rows.append((" ".join(base[:300]), " ".join(base[100:])))  # resemblance of the shingles about 0.5
    df = spark.createDataFrame(rows, "a string, b string").select(
        mh.likeness(mh.fingerprint(F.col("a")), mh.fingerprint(F.col("b"))).alias("x"))
    got = [r.x for r in df.collect()]
    assert abs(sum(got) / len(got) - 196 / 396) < 0.03


def test_plan_has_no_python(spark):
    plan = QUERIES["op3_minhash"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
