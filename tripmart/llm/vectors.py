"""Approximate nearest neighbours by inner product: a forest of hash-prefix trees.

Each of ``TREES`` trees gives every vector a string of ``BITS`` random bits, each the side of a random hyperplane.
A tree is the sorted array of its strings; a node is a prefix, its descendants a contiguous range. A query descends
every tree to its longest match and then ascends all trees together, one bit at a time: at depth ``d`` its
candidates are all vectors that share ``d`` bits with it in some tree. It stops at the greatest depth where
the trees together hold enough. All candidates there are scored in double precision.

How many are enough is measured on each table: up to ``SAMPLE`` of the queries are compared with every point, and the
total is the smallest at which the trees hold ``TARGET`` of their true neighbours, and so many at least that they hold
more distinct points than are asked for, whatever trees share. This rule is the same at every size of the table. A query
whose total reaches the number of points is compared with every point once, which is exact and less work: so it is for
vectors without clusters, whose neighbours are hardly nearer than others, and for queries whose prefixes are empty.

Inner products follow angles only on a sphere, so vectors get one more component that makes all norms equal
(zero for queries); that keeps the order of inner products.

- Equal vectors are one point with its members; as ties go to the smaller id, a point keeps the ``NEAREST + 1``
  smallest, which is exact, so very frequent vectors neither fill a tree nor a result.
- Sorted arrays are split: a shard is a tree's strings with one common prefix of ``shard_bits``, chosen by the number
  of points so that a shard holds about ``SHARD`` of them. One that holds more (points of similar direction, or of
  norms much below the longest) is dealt out to blocks by id, so that no task gets more than about ``SHARD`` points.
- A query goes to all blocks of its own shard, and where it ascends above ``shard_bits`` to those of all shards with
  its shorter prefix. At the root every tree holds the same, so there one tree is searched.
- Queries meet a block in a cogroup: per task one block and the queries sent to it.

Rows without an id, and vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part; nor
do those whose length differs from the most frequent one. Equal rows count once, and a query never gets its own id.
Results: ``query_id, rank, vec_id, score``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.staging import Stage

TREES = 24
BITS = 62
NEAREST = 20
SHARD = 100_000
#: Candidates of all trees together that are taken at least.
LEAST = TREES * (NEAREST + 1)
#: Queries that the stop is fitted on, and the share of their neighbours that it is to reach: 0.9 and a margin for chance.
SAMPLE = 200
TARGET = 0.93
#: Inner products that a task holds at a time.
SCORES = 1 << 21
SEED = 20


def _planes(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, TREES * BITS)).astype(np.float32)


def _hashes(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """A row of ``TREES`` strings of ``BITS`` bits, as numbers whose order is that of the strings."""
    bits = (vectors.astype(np.float32) @ planes > 0).reshape(len(vectors), TREES, BITS)
    weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
    return np.stack([bits[:, t].astype(np.int64) @ weights for t in range(TREES)], axis=1)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def _hasher(size: int, longest: float, query: bool):
    def hash_rows(batches):
        planes = _planes(size + 1)
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                part = batch.slice(begin, 2048)
                x = _matrix(part.column("v"), size)
                rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
                hashes = _hashes(np.column_stack([x, rest]), planes)
                flat = pa.array(hashes.ravel())
                offsets = pa.array(np.arange(len(x) + 1) * TREES, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.ListArray.from_arrays(offsets, flat)], ["id", "v", "hashes"])

    return hash_rows


def _ranges(strings: np.ndarray, queries: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings lie that share ``depths`` bits with the queries."""
    low = queries >> (BITS - depths) << (BITS - depths)
    return np.searchsorted(strings, low, "left"), np.searchsorted(strings, low + (1 << (BITS - depths)), "left")


def _nearest(size: int, asked: np.ndarray):
    """The points of each task nearest to each vector of ``asked``, without points equal to it."""

    def best(batches):
        keep = [(np.zeros(0), np.zeros(0, np.int64), np.zeros((0, size))) for _ in asked]
        for batch in batches:
            for begin in range(0, batch.num_rows, 8192):
                part = batch.slice(begin, 8192)
                x, ids = _matrix(part.column("v"), size), np.asarray(part.column("id"))
                every = asked @ x.T
                for i, scores in enumerate(every):
                    # One more, as the vector itself may be among them.
                    near = np.argpartition(scores, -NEAREST - 1)[-NEAREST - 1 :] if len(scores) > NEAREST + 1 else np.arange(len(scores))
                    near = near[(x[near] != asked[i]).any(axis=1)]
                    score, own, v = (np.concatenate([a, b]) for a, b in zip(keep[i], (scores[near], ids[near], x[near])))
                    first = np.argsort(-score, kind="stable")[:NEAREST]
                    keep[i] = score[first], own[first], v[first]
        for i, (score, own, v) in enumerate(keep):
            offsets = pa.array(np.arange(len(own) + 1) * size, pa.int32())
            columns = [pa.array(np.full(len(own), i)), pa.array(own), pa.array(score), pa.ListArray.from_arrays(offsets, pa.array(v.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, ["asked", "id", "score", "v"])

    return best


def _fitted(held: np.ndarray, reached: list[np.ndarray], count: int) -> int:
    """The smallest total at which ``TARGET`` of the neighbours are candidates. ``held``: totals by depth for each query."""
    total = lambda stop, row: max(np.flatnonzero(row >= stop), default=0)

    def recall(stop: int) -> float:
        found = []
        for row, depths in zip(held, reached):
            depth = total(stop, row)
            found.append(1.0 if row[depth] >= count else float(np.mean(depths >= depth)))
        return float(np.mean(found))

    stops = np.unique(held)
    low, high = 0, len(stops) - 1  # the last is that of the root, where everything is found
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if recall(int(stops[middle])) >= TARGET else (middle + 1, high)
    return int(stops[low])


def _held(shard_bits: int):
    def count(points: pa.Table, queries: pa.Table) -> pa.Table:
        """For each query the number of candidates in this tree at depths from ``shard_bits`` to ``BITS``."""
        strings = np.sort(np.asarray(points.column("hash"))) if points.num_rows else np.zeros(0, np.int64)
        own = np.asarray(queries.column("hash")) if queries.num_rows else np.zeros(0, np.int64)
        counts = np.zeros((len(own), BITS - shard_bits + 1), np.int64)
        for at, depth in enumerate(range(shard_bits, BITS + 1)):
            left, right = _ranges(strings, own, np.full(len(own), depth))
            counts[:, at] = right - left
        flat = pa.array(counts.ravel())
        offsets = pa.array(np.arange(len(own) + 1) * counts.shape[1], pa.int32())
        return pa.table({"id": queries.column("id"), "held": pa.ListArray.from_arrays(offsets, flat)})

    return count


def _scored(size: int):
    def score(points: pa.Table, queries: pa.Table) -> pa.Table:
        """The best candidates of each query in this tree, at the depth the whole forest stops at."""
        out: list[list[np.ndarray]] = [[], [], []]
        if points.num_rows and queries.num_rows:
            points = points.sort_by("hash").combine_chunks()
            queries = queries.combine_chunks()
            strings, ids = np.asarray(points.column("hash")), np.asarray(points.column("id"))
            x = _matrix(points.column("v").combine_chunks(), size)
            q = _matrix(queries.column("v").combine_chunks(), size)
            query_ids = np.asarray(queries.column("id"))
            left, right = _ranges(strings, np.asarray(queries.column("hash")), np.asarray(queries.column("depth")))
            keep = NEAREST + 1
            for i in range(len(q)):
                best_score, best_id = np.zeros(0), np.zeros(0, np.int64)
                for begin in range(left[i], right[i], SCORES // size):
                    end = min(right[i], begin + SCORES // size)
                    scores = (x[begin:end] * q[i]).sum(axis=1)
                    own = ids[begin:end]
                    if len(scores) > keep:
                        # All that tie with the last one kept stay.
                        enough = scores >= np.partition(scores, -keep)[-keep]
                        scores, own = scores[enough], own[enough]
                    best_score, best_id = np.append(best_score, scores), np.append(best_id, own)
                out[0].append(np.full(len(best_id), query_ids[i]))
                out[1].append(best_id)
                out[2].append(best_score)
        kinds = (np.int64, np.int64, np.float64)
        columns = [pa.array(np.concatenate(c) if c else np.zeros(0, k)) for c, k in zip(out, kinds)]
        return pa.table(dict(zip(("query", "id", "score"), columns)))

    return score


def _stop(points: DataFrame, asked: DataFrame, held: DataFrame, size: int, longest: float, count: int) -> int:
    """How many candidates are enough, by comparing a bounded sample of queries with all points."""
    sample = asked.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return LEAST
    x = np.array([r.v for r in sample], np.float64)
    near = points.mapInArrow(_nearest(size, x), "asked long, id long, score double, v array<double>")
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "id")))
    near = near.where(F.col("place") <= NEAREST).select(F.col("asked").alias("id"), "v")
    own = _hashes(np.column_stack([x, np.zeros(len(x))]), _planes(size + 1))
    reached: list[list[int]] = [[] for _ in sample]
    for row in near.mapInArrow(_hasher(size, longest, False), "id long, v array<double>, hashes array<long>").select("id", "hashes").collect():
        apart = min(int(bits).bit_length() for bits in np.array(row.hashes, np.int64) ^ own[row.id])
        reached[row.id].append(BITS - apart)
    rows = {r.id: i for i, r in enumerate(sample)}
    totals = np.zeros((len(sample), BITS + 1), np.int64)
    for row in held.where(F.col("id").isin(list(rows))).collect():
        totals[rows[row.id], row["at"]] = row.n
    some = [i for i, depths in enumerate(reached) if depths]
    return max(LEAST, _fitted(totals[some], [np.array(reached[i]) for i in some], count)) if some else LEAST


def search(vectors: DataFrame, queries: DataFrame, stage: Stage | None = None, nearest: int = NEAREST) -> DataFrame:
    """The ``nearest`` candidates (at most ``NEAREST``) found among ``vectors`` for each of ``queries`` (``vec_id, embedding``)."""
    spark = vectors.sparkSession
    stage = stage or Stage(spark)

    def usable(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        df = df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
        return df.where(F.coalesce(finite, F.lit(False))).where(F.exists("v", lambda c: c != 0))

    # The smallest ids of each point. Each task keeps only these of its own rows, so that a very frequent vector is
    # small before it is gathered.
    first = Window.partitionBy("v").orderBy("vec_id")
    ids = usable(vectors).distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= NEAREST + 1)
    points = ids.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    points = stage.table(points.withColumn("id", F.xxhash64("v")), "points")
    sizes = points.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    result = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], result)
    size, count = sizes
    points = points.where(F.size("v") == size)
    longest = math.sqrt(points.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0])
    shard_bits = max(0, math.ceil(math.log2(max(count, 1) / SHARD)))
    asked = usable(queries).where(F.size("v") == size).distinct().withColumn("id", F.xxhash64("vec_id", "v"))
    asked = stage.table(asked, "asked")

    def forest(df: DataFrame, query: bool) -> DataFrame:
        hashed = df.select("id", "v").mapInArrow(_hasher(size, longest, query), "id long, v array<double>, hashes array<long>")
        rows = hashed.select("id", "v", F.posexplode("hashes").alias("tree", "hash"))
        return rows.withColumn("shard", F.shiftright("hash", BITS - shard_bits) if shard_bits else F.lit(0).cast("long"))

    trees, probes = stage.table(forest(points, False), "trees"), stage.table(forest(asked, True), "probes")
    # A row for each shard; crowded ones have several blocks.
    shards = trees.groupBy("tree", "shard").agg(F.count("*").alias("n"))
    shards = stage.table(shards.withColumn("blocks", F.ceil(F.col("n") / SHARD).cast("int")), "shards")
    trees = trees.join(F.broadcast(shards.select("tree", "shard", "blocks")), ["tree", "shard"])
    trees = trees.withColumn("block", F.expr("cast(pmod(id, blocks) as int)")).drop("blocks")
    place = ["tree", "shard", "block"]

    def sent(df: DataFrame) -> DataFrame:
        """A row of ``df`` for each block of its shard."""
        df = df.join(F.broadcast(shards.select("tree", "shard", "blocks")), ["tree", "shard"])
        return df.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    slim = [F.col(c) for c in ("id", "hash", *place)]
    held = trees.select(slim).groupBy(place).cogroup(sent(probes.drop("v")).select(slim).groupBy(place))
    held = held.applyInArrow(_held(shard_bits), "id long, held array<long>")
    held = held.select("id", F.posexplode("held").alias("at", "n")).select("id", (F.col("at") + shard_bits).alias("at"), "n")
    if shard_bits:
        # Above the shards counts are sums over shards.
        above = lambda value: (
            value.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(shard_bits - 1))))
            .withColumn("node", F.expr(f"shiftright(shard, {shard_bits} - at)"))
        )
        nodes = above(shards).groupBy("tree", "at", "node").agg(F.sum("n").alias("n"))
        held = held.unionByName(above(probes.drop("v")).join(F.broadcast(nodes), ["tree", "at", "node"]).select("id", "at", "n"))
    # Candidates of all trees together by depth.
    held = stage.table(held.groupBy("id", "at").agg(F.sum("n").alias("n")), "held")
    stop = _stop(points.select("id", "v"), asked.select("id", "v"), held, size, longest, count)
    depth = held.groupBy("id").agg(F.max(F.when(F.col("n") >= stop, F.struct("at", "n"))).alias("last"))
    # Where as many are to be looked at as there are points, each is looked at once.
    depth = depth.select("id", F.when(F.col("last.n") < count, F.col("last.at")).otherwise(0).cast("long").alias("depth"))
    probes = probes.join(depth, "id").where((F.col("depth") > 0) | (F.col("tree") == 0))
    if shard_bits:
        wide = f"greatest({shard_bits} - depth, 0)"
        probes = probes.withColumn("first", F.expr(f"shiftleft(shiftright(shard, cast({wide} as int)), cast({wide} as int))"))
        probes = probes.withColumn("shard", F.explode(F.expr(f"sequence(first, first + shiftleft(1L, cast({wide} as int)) - 1)"))).drop("first")
    probes = stage.table(sent(probes), "sent")
    searched = [r.tree for r in probes.select("tree").distinct().collect()]  # numbers of trees
    found = trees.where(F.col("tree").isin(searched)).groupBy(place).cogroup(probes.groupBy(place))
    found = found.applyInArrow(_scored(size), "query long, id long, score double")
    found = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    named = found.join(points.select("id", "ids"), "id").join(asked.select(F.col("id").alias("query"), F.col("vec_id").alias("query_id")), "query")
    named = named.select("query_id", "query", "score", F.explode("ids").alias("vec_id")).where("query_id <> vec_id")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return named.select("query_id", "rank", "vec_id", "score")

