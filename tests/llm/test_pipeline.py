import zlib

import duckdb
import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline as cp
from ladle.llm import quality as ql
from ladle.llm.oracles import OP4, OP6
from ladle.llm.queries import tokenizer_path
from llm_rows import ODD, SF_SMALL, make  # noqa: F401
from test_simhash import slow_groups, slow_print


def test_stages_over_the_whole_table(spark, tmp_path):
    """Each stage against a slow version of itself on the rows its predecessor kept."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_SMALL}/benchmark.parquet'")
    docs, kept = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for i, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / f"{i}"))
        before, docs = docs, spark.read.parquet(str(tmp_path / f"{i}"))
        a, b = before.toPandas(), docs.toPandas()
        ids, left = a.doc_id.tolist(), sorted(b.doc_id.tolist())
        if name != "token_files":
            assert docs.columns == before.columns
        con.register("documents", pa.Table.from_pandas(a))
        if name == "quality":
            s = ql.scores(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).toPandas()
            some = s[s.n_grams > 0].sort_values("sample_key", ascending=False)
            assert left == sorted(some.doc_id[:int((some.weight >= 0).sum())])
        elif name == "near_duplicates":
            groups = slow_groups([(k, slow_print(t)) for k, t in zip(ids, a.text)], 4)
            assert left == sorted({g[2] for g in groups})
        elif name == "decontaminate":
            assert left == sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({OP4}) WHERE NOT contaminated").fetchall())
        elif name == "mix":
            want = con.execute(f"SELECT doc_id, taken // greatest(size, 1) FROM ({OP6})").fetchall()
            assert left == sorted(k for k, n in want for _ in range(int(n)))
        else:
            tok, start = Tokenizer.from_file(tokenizer_path()), 0
            for r, (k, t) in zip(docs.orderBy("start").collect(), sorted(zip(ids, a.text))):
                x = tok.encode(t, add_special_tokens=False).ids + [2]
                assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                start += len(x)
        kept.append(len(left))
    assert 0 < kept[2] < kept[1] < kept[0] < 200


def test_run_takes_odd_rows(spark, make, tmp_path):
    d = tmp_path / "sf"
    make([*ODD, *((100 + i, f"clean words of document {i} and nothing else " * 3) for i in range(20))]).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(5, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert cp.run(spark, str(d)).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_run_takes_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_stage_list():
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "token_files"]
    assert cp.ORACLE_SQL is None
