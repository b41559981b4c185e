"""Queries of the optional part against their SQL, and the pipeline stage by
stage: on the given table and on rows with nulls, copies and clashing names."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tramline.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, ([r[c] for c in columns] for r in got.collect()))) == sorted(map(str, map(list, cur.fetchall())))


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns[:len(columns)] == columns and (docs.columns == columns or name == "mixing")
        assert 0 < docs.count() <= left
        left = docs.count()


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows and extra
    columns that are named like working columns go through the whole chain."""
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10 ** 7, "", "en", None, 0), (10 ** 7 + 1, " \n ", None, "s", 3),
                                 (10 ** 7 + 2, "word " * 30_000, "xx", "s", None), (10 ** 7 + 3, "one two", "en", "s", 7)] * 2, docs.schema)
    odd = docs.unionByName(odd).unionByName(docs.limit(3))
    odd = odd.select("*", F.lit("r").alias("row"), F.lit(1).alias("id"), F.lit("h").alias("h"), F.lit(2.0).alias("score"), F.lit("t").alias("topic"))
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert docs.columns == odd.columns and docs.count() > 100
        if name in ("toxicity", "line_dedup"):
            assert docs.where("doc_id IS NULL").count() == 2
        else:
            # equal rows with words are one document from here on
            assert docs.where("trim(text) rlike '[a-z]'").groupBy("doc_id", "text").count().where("count > 1").count() == 0
    drawn = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert 0 < drawn.count() <= docs.count() and drawn.columns == [*odd.columns, "mix_topic", "weight", "probability"]


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        assert out.count() == 0 and out.columns[:len(docs.columns)] == docs.columns
