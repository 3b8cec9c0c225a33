"""The registered queries with SQL against DuckDB, and the pipeline's stages on the smallest tables."""

import duckdb
import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from foliograph.llm import bpe, decontam, queries, substring, toxicity  # noqa: E402
from foliograph.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[key](spark, SF)
    names = sorted(df.columns)
    cur = con.execute(queries.oracle_sql()[key])
    have = [c[0] for c in cur.description]
    assert sorted(have) == names
    want = sorted(tuple(str(r[have.index(n)]) for n in names) for r in cur.fetchall())
    assert sorted(tuple(str(v) for v in r) for r in df.select(*names).collect()) == want


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    before, clean = docs, None
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        if name != "bpe":
            assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), after.schema)
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.digest(docs, table(spark, SF, "labels")).where("predicted = 1").collect()}
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()} - bad
        if name == "substring_dedup":
            assert substring.digest(after).where("n_removed > 0").count() == 0
        if name == "decontamination":
            clean = after
            assert decontam.contamination(after, table(spark, SF, "benchmark")).where("contaminated").count() == 0
        before = after
    want = bpe.encode(clean, queries.tokenizer_file("word_bpe_49k.json"))
    assert sorted(r.ids_sha256 for r in before.collect()) == sorted(r.ids_sha256 for r in want.collect())
    assert corpus_pipeline.run(spark, SF).count() == before.count()
