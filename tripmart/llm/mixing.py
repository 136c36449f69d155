"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources, sorted by code point with NULL last, weigh 1, 2, 3, 1, 2, 3, ... and share the size of the
whole corpus by weight. A target stops at ``REPEATS`` times its source's size; what is left over is shared by
the others again, until no target is above.

Schedule: the mix is a sequence of at most ``SLOTS`` slots of equally many words. Slot ``k`` takes the source in
whose interval of cumulative target shares the point ``frac(k * golden ratio)`` falls, so every stretch of the
sequence holds each source close to its share. The slots of a source are ranked; its documents are put in a
fixed random order (MD5 of the id) and cut into blocks of a slot's size; rank ``r`` takes block ``r`` modulo
the number of blocks, so the source is gone through again from its start, at most ``REPEATS`` times.
The rank of a last, cut slot makes up what rounding leaves of the target.

The number of slots doesn't depend on the input (only their size does), and no source is ever in one task: the
order of a source's documents is worked out in ``BUCKETS`` ranges of its hashes.

A document's size is its number of runs of characters other than space and tab to carriage return; NULL is 0.
Documents without words are never taken. NULL ids, equal ids and equal rows are separate documents. An empty
table gives no rows. Reruns give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.staging import Stage

WEIGHTS = (1, 2, 3)
REPEATS = 3
SLOTS = 1_000_000
BUCKETS = 1024
CELLS = 4096
GOLDEN = (5**0.5 - 1) / 2

_NAMES = ("doc_id", "size", "source_size", "target", "taken")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, stage: Stage, total: int) -> DataFrame:
    """``source, source_size, weight, target`` for each source of ``sizes`` (``source, source_size``)."""
    spark = sizes.sparkSession
    ranked = sizes.orderBy(F.asc_nulls_last("source")).rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    rows = spark.createDataFrame(ranked, "source string, source_size long, rank long")
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.pmod("rank", F.lit(len(WEIGHTS))).cast("int"))
    rows = stage.table(rows.withColumn("weight", weight), "sources")
    # Each round fixes the sources that are above their limit; the rest share what these leave.
    level, fixed = 0.0, -1
    limit = REPEATS * F.col("source_size")
    while True:
        above = limit < level * F.col("weight") if level else F.lit(False)
        kept, free, count = rows.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)), F.count_if(above)
        ).first()
        if count == fixed or not free:
            break
        fixed, level = count, (total - kept) / free
    return rows.select("source", "source_size", "rank", F.least(limit.cast("double"), level * F.col("weight")).alias("target"))


def schedule(sources: DataFrame, slots: int, total: float) -> DataFrame:
    """``rank`` (of the source) and ``turn`` (0, 1, ... within the source) of every slot.

    Sources come as ``rank, low, high`` with cumulative targets. Points and intervals meet in ``CELLS`` cells, so
    that no slot is compared to all sources.
    """
    spark = sources.sparkSession
    cell = lambda x: F.least(F.floor(x * CELLS), F.lit(CELLS - 1)).cast("int")
    points = spark.range(slots).select("id", (F.col("id") * GOLDEN - F.floor(F.col("id") * GOLDEN)).alias("point"))
    points = points.withColumn("cell", cell(F.col("point")))
    spread = sources.select("rank", (F.col("low") / total).alias("low"), (F.col("high") / total).alias("high")).where("high > low")
    spread = spread.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    hit = points.join(spread, "cell").where("low <= point and point < high")
    # At most SLOTS rows in all.
    return hit.select("rank", "id", (F.row_number().over(Window.partitionBy("rank").orderBy("id")) - 1).alias("turn"))


def _offsets(rows: DataFrame, key: str, value: str, order: list[Column], bucket: Column) -> DataFrame:
    """``before``: the total of ``value`` in earlier rows of the same ``key``, by buckets and then by ``order``."""
    rows = rows.withColumn("bucket", bucket)
    sums = rows.groupBy(key, "bucket").agg(F.sum(value).alias("sum"))
    earlier = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, "bucket", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy(key, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(sums, [key, "bucket"])
    return rows.withColumn("before", F.col("base") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("base", "bucket")


def mix(docs: DataFrame, stage: Stage | None = None, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs`` (``doc_id, text, source``)."""
    spark = docs.sparkSession
    stage = stage or Stage(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text").cast("string")).alias("size")
    )
    rows = stage.table(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    aim = stage.table(targets(sizes, stage, total), "targets")
    step = max(1, -(-total // slots))

    whole = F.ceil(F.col("target") / step).cast("long")
    aimed = _offsets(aim.withColumn("one", F.lit(1)), "one", "target", [F.col("rank")], F.floor(F.col("rank") / BUCKETS))
    aimed = aimed.withColumn("low", F.col("before")).withColumn("high", F.col("before") + F.col("target"))
    # A few more slots than the targets fill, as a source's share of the points is a few off; they end empty.
    count = aim.agg(F.sum(whole)).first()[0] or 0
    count += count // 64 + 16
    planned = schedule(aimed.select("rank", "low", "high"), count, float(total or 1))
    turns = planned.groupBy("rank").agg(F.count("*").alias("planned"))
    goal = F.round("target").cast("long")
    sources = stage.table(
        aim.join(turns, "rank", "left").select("source", "source_size", "rank", "target", goal.alias("goal"), F.coalesce("planned", F.lit(0)).alias("planned")),
        "goals",
    )
    # Block r of a source is taken once for each turn that comes round to it, up to the words the source still lacks.
    blocks = F.greatest(F.ceil(F.col("source_size") / step), F.lit(1)).cast("long")
    last = F.col("source_size") - (blocks - 1) * step
    turn = planned.join(sources.where("source_size > 0"), "rank").withColumn("blocks", blocks).withColumn("last", last)
    begin = F.floor(F.col("turn") / F.col("blocks")) * F.col("source_size") + F.pmod("turn", "blocks") * step
    width = F.when(F.pmod("turn", "blocks") == F.col("blocks") - 1, F.col("last")).otherwise(step)
    used = F.least(width, F.greatest(F.col("goal") - begin, F.lit(0)))
    used = turn.select("rank", F.pmod("turn", "blocks").alias("block"), used.cast("long").alias("used")).where("used > 0")
    used = used.groupBy("rank", "block").agg(F.collect_list("used").alias("uses"))  # at most REPEATS and one

    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    bucket = F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / (2**32 // BUCKETS))
    named = rows.withColumn("digest", digest).join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    placed = _offsets(named.where("size > 0"), "rank", "size", [F.col(c) for c in ("digest", "doc_id", "size")], bucket)
    placed = stage.table(placed.select("rank", "doc_id", "size", "source_size", "target", "before").withColumn("row", F.monotonically_increasing_id()), "placed")
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("before") / step), F.floor((F.col("before") + F.col("size") - 1) / step))))
    start = F.greatest(F.col("before") - F.col("block") * step, F.lit(0))
    end = F.least(F.col("before") + F.col("size") - F.col("block") * step, F.lit(step))
    share = lambda u: F.greatest(F.least(end, u) - start, F.lit(0))
    taken = F.aggregate("uses", F.lit(0).cast("long"), lambda total, u: total + share(u))
    taken = pieces.join(used, ["rank", "block"]).groupBy("row").agg(F.sum(taken).alias("taken"))
    result = placed.join(taken, "row", "left").select(*_NAMES[:-1], F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    empty = named.where("size = 0").select(*_NAMES[:-1], F.lit(0).cast("long").alias("taken"))
    return result.union(empty)
