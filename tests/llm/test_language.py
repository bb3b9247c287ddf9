import zlib

from ladle.llm import language as lg
from ladle.llm.queries import QUERIES
from llm_rows import ODD, make  # noqa: F401


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op7_language"](spark, sf_dir).join(docs, "doc_id").collect()
    assert len(rows) == 10000
    out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98
    sure = [r for r in out if not r.rejected]
    assert len(sure) > 0.95 * len(out) and sum(r.lang_pred == r.lang for r in sure) / len(sure) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_never_used(spark, make):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "der hund ist im haus und ") * 5 + str(i), "en" if i % 2 else "de")
            for i in range(60)]
    wrong = [(k, t, "xx" if zlib.crc32(str(k).encode()) % 3 == 1 else lang) for k, t, lang in rows]
    a, b = ({(r.doc_id, r.lang_pred, r.score) for r in lg.learn_and_identify(make(x)).collect()} for x in (rows, wrong))
    assert a == b and {x[1] for x in a} == {"en", "de"}


def test_odd_rows(spark, make):
    learn = [(100 + i, f"plain english words number {i}", "en") for i in range(9)] + [(200 + i, f"noch ein satz {i}", None) for i in range(9)]
    got = {(r.doc_id, r.lang_pred) for r in lg.learn_and_identify(make(learn + [(*r, None) for r in ODD])).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (8, "en"), (9, "en")} <= got
    assert lg.learn_and_identify(make(ODD).limit(0)).count() == 0
    assert {r.lang_pred for r in lg.learn_and_identify(make([(1, "abc", None)])).collect()} == {"und"}


def test_every_part_of_a_long_text_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    contents = lg.dictionaries(docs.where(~lg.held_out("doc_id")), "text", "lang")
    by_lang = {}
    for r in docs.where(lg.held_out("doc_id")).select("lang", "text").collect():
        by_lang.setdefault(r.lang, []).append(r.text or "")
    texts = {k: " ".join(v) for k, v in by_lang.items()}
    long = {k: (t * (1 + 1_000_000 // len(t)))[:1_000_000] for k, t in texts.items()}
    classify = lg.Classifier(contents)
    for lang in contents:
        if lang != "en":
            for parts in ((long[lang][:100_000], long["en"]), (long["en"], long[lang][:100_000])):
                assert classify(" ".join(parts))[0] == "en"
        got = classify(long[lang])
        assert got[0] == lang and got[2] >= lg.MIN_MARGIN
    assert b"".join(lg.pieces(b"ab " * 9999)) == b"ab " * 9999 and max(map(len, lg.pieces(b"ab " * 9999))) <= lg.PIECE_BYTES
