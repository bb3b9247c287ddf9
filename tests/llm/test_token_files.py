import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from llm_rows import ODD, SF_SMALL, make  # noqa: F401
from ladle.llm import token_files as tf
from ladle.llm.queries import QUERIES, tokenizer_path


def expected(rows):
    """Brute force: the library on each whole text, in key order."""
    tok = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for key, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def rows(df):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.orderBy("start").collect()]


def test_whole_table_matches_library(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    want = expected(sorted((r["doc_id"], r["text"]) for r in t))
    assert rows(QUERIES["op1_token_files"](spark, SF_SMALL)) == want


def test_odd_rows_and_small_shards(spark, make, tmp_path):
    tf.write_token_files(make(ODD), str(tmp_path / "a"), tokenizer_path(), shard_bytes=3000)
    got = rows(tf.read_token_files(spark, str(tmp_path / "a")))
    keys = sorted(((k is not None, k or 0, t or "") for k, t in ODD), key=lambda x: (x[0], x[1]))
    want = expected([(k if has else None, t) for has, k, t in keys])
    assert sorted(got, key=lambda r: r[3]) == sorted(got, key=lambda r: r[3])
    # rows of one id may come in either order: compare all but the start, and the starts as a chain
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted(
        (r[0] is not None, r[0] or 0, r[2], r[3]) for r in want)
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert [r[0] for r in got][1:] == sorted(k for k, _ in ODD if k is not None)


def test_fetch_by_key(spark, make, tmp_path):
    tf.write_token_files(make(ODD), str(tmp_path / "a"), tokenizer_path(), shard_bytes=3000)
    got = tf.fetch(spark, str(tmp_path / "a"), [5, 8, 77, -4]).collect()
    assert sorted(r.doc_id for r in got) == [-4, 5, 5, 5, 8]
    tok = Tokenizer.from_file(tokenizer_path())
    assert [r.ids for r in got if r.doc_id == -4] == [tok.encode("one", add_special_tokens=False).ids + [2]]


def test_payload_is_raw_ids(spark, make, tmp_path):
    tf.write_token_files(make([(1, "the cat"), (2, "dog")], 1), str(tmp_path / "a"), tokenizer_path())
    (f,) = [p for p in (tmp_path / "a").iterdir() if p.name.startswith("part-") and p.stat().st_size]
    tok = Tokenizer.from_file(tokenizer_path())
    want = [*tok.encode("the cat").ids, 2, *tok.encode("dog").ids, 2]
    assert np.frombuffer(f.read_bytes(), "<u2", len(want)).tolist() == want
    assert tf.TokenShard(f.read_bytes()).docs == 2


def test_empty_table(spark, make, tmp_path):
    tf.write_token_files(make(ODD).limit(0), str(tmp_path / "a"), tokenizer_path())
    assert tf.read_token_files(spark, str(tmp_path / "a")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 100, 5000])
def test_minimal_perfect_hash(n):
    codes = np.array(random.Random(n).sample(range(1 << 60), n), np.uint64)
    mph = tf.Mph.build(codes)
    assert sorted(mph.slots(codes).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        tf.Mph.build(np.append(codes, codes[:1]))


@pytest.mark.parametrize("text", ["İstanbul ΣΑΣ naïvé", "a\x1cb\x85c d", "<|endoftext|> hi <|x|>", "it's DON'T 'll",
                                  "日本語 テキスト ½ ﬁ Ǆ", "a\x0bb\x0cc\x00d", "é ́x ß###,", "ÀÉ×÷ªº µ"])
def test_encoder_equals_library(text):
    want = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tf.encoder(tokenizer_path())(text), "<u2").tolist() == want


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers as P

    path = P.path("byte_bpe_50k.json")
    want = Tokenizer.from_file(path).encode("Some text, more\n\n text", add_special_tokens=False).ids
    assert np.frombuffer(tf.Encoder(path)("Some text, more\n\n text"), "<u2").tolist() == want


def test_memo_keeps_what_is_asked_for_and_is_bounded():
    from ladle.llm.token_files import Memo

    made = []
    memo = Memo(lambda k: made.append(k) or k * 2, 4)
    for i in range(100):
        assert memo[i] == 2 * i and memo[-1] == -2 and len(memo) + len(memo.old) <= 8
    assert made.count(-1) == 1 and len(made) == 101


def test_words_with_punctuation_share_the_word():
    from tokenizers import Tokenizer

    from ladle.llm.queries import tokenizer_path
    from ladle.llm.token_files import Encoder

    enc, tok = Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    for text in ("Straße, straße. (straße) STRASSE!", "it's 'tis\tdon't 12ab3 é,è", " \n a\r\n", ""):
        assert np.frombuffer(enc(text), enc.dtype).tolist() == tok.encode(text, add_special_tokens=False).ids
    assert "straße" in enc.words and not any(any(map(str.isalpha, w)) and not w.isalpha() and w[0] != "'" for w in enc.words)
