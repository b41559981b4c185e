"""A corpus pipeline over the ``documents`` table: toxic documents go, repeated
lines go, one document of each near-duplicate class stays, documents that hold
benchmark passages go, and the rest is drawn to the target mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's docs. All stages but the
last return the columns of ``documents``; the last adds topic, weight and
probability (named ``mix_...`` where documents has a column of that name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tramline.llm.common import materialize, table
from tramline.llm.dart_minhash import drop_near_duplicates
from tramline.llm.decontam import drop_leaks
from tramline.llm.line_dedup import dedup_lines
from tramline.llm.mixing import mix
from tramline.llm.toxicity import drop_toxic

#: The trees, the dart classes and the raking cannot be put as SQL.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drawn = mix(docs)
    free = lambda c: c if c not in docs.columns else free(f"mix_{c}")
    return drawn.select(*[F.col("row").getField(c).alias(c) for c in docs.columns],
                        *[F.col(c).alias(free(c)) for c in ("topic", "weight", "probability")])


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
