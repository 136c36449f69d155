"""Intermediate tables and connected components, for the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import Stage

__all__ = ["Stage", "components", "partitions"]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """The smallest node reachable from each node that has a link: ``node``, ``component``.

    ``links`` holds pairs ``u``, ``v``. Rounds of large-star and small-star steps turn every
    component into a star around its smallest node; each round's pairs are written and read again, and
    their number never grows. A node with very many links is summed before it is shuffled.
    """
    edges = stage.table(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        f"{name}-0",
    )
    before, turn = None, 0
    while True:
        state = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20)))
        ).first()
        if state == before or not state[0]:
            break
        before, turn = state, turn + 1
        both = _both(edges)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        small = small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        edges = stage.table(small, f"{name}-{turn}")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
