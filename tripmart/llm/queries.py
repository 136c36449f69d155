"""One query for each operator, over its whole table with production parameters, and its SQL if there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    byte_bpe,
    chat,
    decontaminate,
    fim,
    jaccard_join,
    licenses,
    mixing,
    quality,
    secrets,
    spelling,
    vectors,
    warc,
    wordpiece,
)
from tripmart.llm.staging import Stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: A conversation made of control strings, which must come back as it was.
CONTROLS = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(decontaminate.SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(chat.SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = [(F.lit(-1), F.lit(turn), F.lit(role), F.lit(CONTROLS)) for turn, role in enumerate(("user", "assistant"))]
    more = spark.range(1).select(F.inline(F.array(*[F.struct(*[c.alias(n) for c, n in zip(row, turns.columns)]) for row in own])))
    return chat.digests(chat.format_chats(turns.union(more)))


@query(jaccard_join.SQL)
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query()
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.count_tokens(table(spark, sf_dir, "documents"))


@query(warc.SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    warc.write(table(spark, sf_dir, "pages"), stage.path("archives"))
    return warc.payloads(spark, stage.path("archives"), stage)


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op8_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vectors.search(rows, rows.where("vec_id % 20 = 0"))


@query(licenses.SQL)
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query()
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = byte_bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return tokenizer.digests(tokenizer.encode(table(spark, sf_dir, "documents")))


@query(fim.SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


@query()
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.observed(table(spark, sf_dir, "documents")))
