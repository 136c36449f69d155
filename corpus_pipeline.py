"""A corpus made ready for training: good, distinct, clean of test items and secrets, and mixed by source.

Each stage takes all rows its predecessor kept and returns the columns of ``documents``; the last returns the
mix. Every stage's result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontaminate, jaccard_join, mixing, quality, secrets
from tripmart.llm.staging import Stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id. Rows without words all stay.

    Rows are told apart by a key of their own, so of equal rows under one id one stays, and a text stays that
    shares its id with another document's copy. Rows without an id come last in their group.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    keyed = Stage(spark).table(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    groups = jaccard_join.join(keyed.select(F.col(key).alias("doc_id"), "text")).where("doc_id <> component_id")
    members = groups.select(F.explode(F.array("doc_id", "component_id")).alias(key), "component_id").distinct()
    members = members.join(keyed.select(key, "doc_id"), key)
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key))[key].alias(key))
    copies = members.join(first, key, "left_anti").select(key)
    return keyed.join(copies, key, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which an item of the benchmark is found."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text replaced by a mark; all documents stay."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: The classifier and the schedule can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, apply) in enumerate(STAGES):
        docs = stage.table(apply(spark, docs, sf_dir), f"stage-{number}")
    return docs
