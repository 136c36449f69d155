"""Jaccard join of documents on word shingles: exact links and their connected components.

Distance is 1 - intersection / union, a metric; two documents link at ``LIMIT`` (0.25) or less.

1. Exact copies are one point of the space: the class of all documents with the same set.
2. Pivots. Every shingle in the *head* of a set (its smallest 3/8 in a random order) draws the sets that
   hold it together. The most central of them, whose head the others share most, is their pivot. A set's
   distance to each pivot that shares much of its head is worked out in full; the nearest is its home, and the
   sets of one home are a Voronoi region.
3. Inside a large region sets are known by their differences from a centre: the pivot's set, changed in all that
   more than half of the region differ in. Sets close enough to it are linked to the closest of them. By the
   triangle inequality all others can only link if they share some of their differences; these are joined in turn,
   after all sets are left out whose differences nobody shares enough of. The size of two differences and of
   what they share gives the exact distance. Small regions are compared pair by pair.
4. Windows. Two sets of different regions with distance at most LIMIT differ in at most a quarter of the larger
   one, so each shares an eighth of its head with the other (the triangle inequality of the symmetric
   difference). A set is replicated to all shingles inside that window; pairs of different regions that
   meet, and pass the bounds on size, on the shared part of the head and on their distances to a common
   pivot, are compared in full.
5. Recursion. Shingles where more than ``CROWD`` regions meet (a passage that many documents share) are left out
   of 4. A set that shares enough of its head at such shingles alone is *heavy*: heavy sets are joined
   again among themselves on whole sets, rarest shingles first, where nothing is left out.

Pivots alone can't separate this space: nearly all pairs of texts are at distance 1, where no window
excludes anything. That is why sets are drawn together by shingles first and by distance inside these.

Results: one row per row of the input with ``doc_id``, ``n_shingles``, ``component_id``: the smallest
``doc_id`` that links lead to, its own included. Rows with a NULL id take part and count as no id; a text
without words has no shingle and is alone. Rows with equal id are separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.staging import Stage, components, partitions
from tripmart.llm.words import chunks, mixed, shingles

#: At most this many components meet in a region that is compared pair by pair.
CROWD = 16
#: Members of a pivot's region whose distance to it is worked out by one task.
SHARE = 4096
#: Pairs that a task holds at a time.
PAIRS = 1 << 19

_PROFILE = "doc_id long, n long, key long, head array<long>"
_RUN = "shingle long, key long, n long, pivot long, pivot_n long"


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    values, bounds = shingles(texts)
    for begin, end in zip(bounds[:-1], bounds[1:]):
        yield np.unique(values[begin:end])


def _key(members: np.ndarray) -> int:
    """The same number for equal sets, and in practice only for these (always used with the size)."""
    return int((mixed(members ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)).view(np.int64))


def head_size(n):
    return n * 3 // 8 + 1


def fewest_shared(n):
    """How many shingles of its head a set of ``n`` shares with any set at distance 0.25 or less."""
    return n // 8 + 1


def _array(parts: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if p is None else len(p) for p in parts]
    flat = np.concatenate([p for p in parts if p is not None] or [np.zeros(0, np.uint64)]).view(np.int64)
    mask = np.array([p is None for p in parts], bool)
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32(), mask=np.append(mask, False))
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes, keys and heads; a set that this task has met before gets no head."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for part in chunks(batch, "text"):
            size, keys, heads = [], [], []
            for members in _sets(part.column("text")):
                n, key = len(members), _key(members)
                new = n > 0 and (key, n) not in seen
                seen.add((key, n))
                size.append(n)
                keys.append(key)
                heads.append(members[: head_size(n)] if new else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(keys, pa.int64()), _array(heads)],
                ["doc_id", "n", "key", "head"],
            )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shingle and set, those whose shingle has two sets or more, with the first as pivot.

    Only the last row and the pivot are kept from batch to batch, so a shingle may have any number of rows.
    """
    last = pivot = None
    place = 0
    for batch in batches:
        rows = np.stack([np.asarray(batch.column(c)) for c in range(3)])
        if last is not None:
            rows = np.concatenate([last, rows], axis=1)
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        if last is not None:
            new[0] = True
        rows = rows[:, new]
        first = np.ones(rows.shape[1], bool)
        first[1:] = rows[0, 1:] != rows[0, :-1]
        at = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        order = np.arange(len(first)) - at
        pivots = rows[1:, at].copy()
        if last is not None:
            mine = at == 0
            order[mine] += place
            pivots[:, mine] = pivot
        fresh = np.arange(len(first)) > 0 if last is not None else np.ones(len(first), bool)
        member, second = fresh & (order > 0), fresh & (order == 1)
        out = [np.concatenate([rows[0, member], rows[0, second]])]
        for c in (0, 1):
            out.append(np.concatenate([rows[1 + c, member], pivots[c, second]]))
        for c in (0, 1):
            out.append(np.concatenate([pivots[c, member], pivots[c, second]]))
        last, pivot, place = rows[:, -1:], pivots[:, -1:], int(order[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["shingle", "key", "n", "pivot", "pivot_n"])


def runs(rows: DataFrame, *order: Column) -> DataFrame:
    """``shingle, key, n`` brought together by shingle, and sorted by ``order`` first; see ``_runs``."""
    spread = rows.repartition(partitions(rows.sparkSession), "shingle").sortWithinPartitions("shingle", *order, "key", "n")
    return spread.select("shingle", "key", "n").mapInArrow(_runs, _RUN)


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            found = list(_sets(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()), _array(found)],
                ["key", "n", "members"],
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pivot, each pivot's own set before those compared to it: ``key, n, pivot, pivot_n, shared``."""
    current, own = None, np.zeros(0, np.int64)
    for batch in batches:
        key, n, pivot, pivot_n = (np.asarray(batch.column(c)) for c in ("key", "n", "pivot", "pivot_n"))
        column = batch.column("members")
        offsets, values = np.asarray(column.offsets), np.asarray(column.values)
        is_own = np.asarray(batch.column("is_own").cast(pa.int8()))
        rows, shared = [], []
        for i in range(batch.num_rows):
            members = values[offsets[i] : offsets[i + 1]]
            if is_own[i]:
                current, own = (pivot[i], pivot_n[i]), members.copy()
            elif current == (pivot[i], pivot_n[i]):
                place = np.searchsorted(own.view(np.uint64), members.view(np.uint64))
                place[place == len(own)] = 0
                rows.append(i)
                shared.append(int((own[place] == members).sum()))
        out = [pa.array(x[rows]) for x in (key, n, pivot, pivot_n)] + [pa.array(shared, pa.int64())]
        yield pa.RecordBatch.from_arrays(out, ["key", "n", "pivot", "pivot_n", "shared"])


def _beside(pairs: DataFrame, sets: DataFrame, centres: DataFrame | None = None) -> DataFrame:
    """The sets of pairs ``key, n, pivot, pivot_n``, sorted by pivot, each after its pivot's own set.

    ``centres`` (``key, n, members``) are sets to take in place of the pivots' own. A pivot with very many pairs
    is spread over several tasks.
    """
    spread = partitions(pairs.sparkSession)
    many = pairs.groupBy("pivot", "pivot_n").agg((F.count("*") / SHARE).cast("int").alias("salts"))
    salt = F.when(F.col("salts") > 0, F.pmod(F.xxhash64("key"), F.col("salts") + 1)).otherwise(0)
    members = (
        pairs.join(many, ["pivot", "pivot_n"])
        .join(sets, ["key", "n"])
        .select("pivot", "pivot_n", salt.cast("int").alias("salt"), F.lit(False).alias("is_own"), "key", "n", "members")
    )
    # The same columns as above, so that the sets are dealt out once for both.
    own = many.select(F.col("pivot").alias("key"), F.col("pivot_n").alias("n"), "salts").join(sets if centres is None else centres, ["key", "n"])
    own = own.select(
        F.col("key").alias("pivot"), F.col("n").alias("pivot_n"), F.explode(F.sequence(F.lit(0), "salts")).alias("salt"),
        F.lit(True).alias("is_own"), "key", "n", "members",
    )
    return (
        own.union(members)
        .repartition(spread, "pivot", "pivot_n", "salt")
        .sortWithinPartitions("pivot", "pivot_n", "salt", F.desc("is_own"))
    )


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``shared`` for pairs ``key, n, pivot, pivot_n``."""
    return _beside(pairs, sets).mapInArrow(_compare, "key long, n long, pivot long, pivot_n long, shared long")


def _linked(rows: DataFrame) -> DataFrame:
    """100 * intersection >= 75 * union, in whole numbers."""
    return rows.where("100 * shared >= 75 * (n + pivot_n - shared)")


_FITS = "4 * least(n, pivot_n) >= 3 * greatest(n, pivot_n)"


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each set has and its pivot lacks, and the other way round; rows as for ``_compare``."""
    current, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        key, n, pivot, pivot_n = (np.asarray(batch.column(c)) for c in ("key", "n", "pivot", "pivot_n"))
        column = batch.column("members")
        offsets, values = np.asarray(column.offsets), np.asarray(column.values).view(np.uint64)
        is_own = np.asarray(batch.column("is_own").cast(pa.int8()))
        rows, found = [], []
        for i in range(batch.num_rows):
            members = values[offsets[i] : offsets[i + 1]]
            if is_own[i]:
                current, own = (pivot[i], pivot_n[i]), members.copy()
            elif current == (pivot[i], pivot_n[i]):
                found.append(np.setxor1d(own, members, assume_unique=True).view(np.int64))
                rows.append(np.full(len(found[-1]), i))
        at = np.concatenate(rows) if rows else np.zeros(0, int)
        shingle = np.concatenate(found) if found else np.zeros(0, np.int64)
        out = [pa.array(x[at]) for x in (key, n, pivot, pivot_n)] + [pa.array(shingle)]
        yield pa.RecordBatch.from_arrays(out, ["key", "n", "pivot", "pivot_n", "shingle"])


def _majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Differences held by more than half of a pivot's sets in a batch, and by how many; rows as for ``_compare``."""
    current, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        pivot, pivot_n = (np.asarray(batch.column(c)) for c in ("pivot", "pivot_n"))
        column = batch.column("members")
        offsets, values = np.asarray(column.offsets), np.asarray(column.values).view(np.uint64)
        is_own = np.asarray(batch.column("is_own").cast(pa.int8()))
        starts = np.flatnonzero(_starts(pivot, pivot_n) == np.arange(batch.num_rows))
        out = []
        for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
            found = []
            for i in range(begin, end):
                members = values[offsets[i] : offsets[i + 1]]
                if is_own[i]:
                    current, own = (pivot[i], pivot_n[i]), members.copy()
                elif current == (pivot[i], pivot_n[i]):
                    found.append(np.setxor1d(own, members, assume_unique=True))
            if found:
                shingle, held = np.unique(np.concatenate(found), return_counts=True)
                shingle, held = shingle[2 * held > len(found)], held[2 * held > len(found)]
                cell = [np.full(len(shingle), x[begin]) for x in (pivot, pivot_n)]
                out.append([*cell, shingle.view(np.int64), held])
        if out:
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, ["pivot", "pivot_n", "shingle", "held"])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """For each row the first row with equal columns."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _cross(crowd: int | None):
    """Pairs that meet at a shingle, from rows sorted by shingle and region: of different regions and components.

    For a shingle where more than ``crowd`` regions meet there is a row for each set instead, paired with itself.
    """
    names = ["key", "n", "pivot", "pivot_n"]

    def batch_of(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    def of(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.shape[1]:
            return
        run, own = _starts(rows[0]), _starts(rows[0], rows[1])
        if crowd:
            regions = np.bincount(run, own == np.arange(len(own)), len(run))
            full = regions[run] > crowd
            if full.any():
                yield batch_of(rows[3, full], rows[4, full], rows[3, full], rows[4, full])
                rows = rows[:, ~full]
                if not rows.shape[1]:
                    return
                run, own = _starts(rows[0]), _starts(rows[0], rows[1])
        _, _, component, key, n = rows
        total = np.cumsum(own - run)
        begin = 0
        while begin < len(run) and total[-1]:
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIRS, "right")))
            count = (own - run)[begin:end]
            left = np.repeat(np.arange(begin, end), count)
            right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + run[left]
            fits = (4 * np.minimum(n[left], n[right]) >= 3 * np.maximum(n[left], n[right])) & (component[left] != component[right])
            left, right = left[fits], right[fits]
            if len(left):
                yield batch_of(key[left], n[left], key[right], n[right])
            begin = end

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, crowded = None, None
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(c)) for c in ("shingle", "region", "component", "key", "n")])
            if crowded is not None:
                same = rows[0] == crowded
                if same.any():
                    yield batch_of(rows[3, same], rows[4, same], rows[3, same], rows[4, same])
                    rows = rows[:, ~same]
                if rows.shape[1]:
                    crowded = None
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            last = int(_starts(rows[0])[-1])
            yield from of(rows[:, :last])
            held = rows[:, last:]
            if crowd and len(np.unique(held[1])) > crowd:
                # No need to wait for the rest: a shingle of any number of sets is never held whole.
                crowded = held[0, 0]
                yield from of(held)
                held = None
        if held is not None:
            yield from of(held)

    return pairs


def _cross_pairs(rows: DataFrame, crowd: int | None) -> DataFrame:
    """Pairs that meet at some shingle, and at how many: ``met``; see ``_cross``."""
    spread = rows.repartition(partitions(rows.sparkSession), "shingle").sortWithinPartitions("shingle", "region", "key")
    found = spread.mapInArrow(_cross(crowd), "key long, n long, pivot long, pivot_n long")
    # Always the larger key first, so that a pair found at several shingles is one row.
    first = "(key, n) > (pivot, pivot_n)"
    sides = [F.when(F.expr(first), F.col(a)).otherwise(F.col(b)).alias(a) for a, b in (("key", "pivot"), ("n", "pivot_n"), ("pivot", "key"), ("pivot_n", "n"))]
    return found.select(sides).groupBy("key", "n", "pivot", "pivot_n").agg(F.count("*").alias("met"))


def join(docs: DataFrame, stage: Stage | None = None) -> DataFrame:
    """See the module. ``docs`` needs ``doc_id`` and ``text``; other columns are ignored."""
    spark = docs.sparkSession
    stage = stage or Stage(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profiles = stage.table(docs.mapInArrow(_profiles, _PROFILE), "profiles")

    heads = profiles.where("head is not null").select(F.explode("head").alias("shingle"), "key", "n")
    regions = stage.table(runs(heads).select("shingle", "key", "n"), "shared")

    # Sets that share enough of their head to have a link at all, and these sets in full.
    window = F.floor(F.col("n") / 8) + 1
    met = regions.groupBy("key", "n").agg(F.count("*").alias("met")).where(F.col("met") >= window)
    near = stage.table(met.select("key", "n", F.floor(1000 * F.col("met") / (F.floor(F.col("n") * 3 / 8) + 1)).alias("central")), "near")
    ids = profiles.groupBy("key", "n").agg(F.min("doc_id").alias("doc_id"))
    near_ids = ids.join(near, ["key", "n"], "left_semi").select(F.col("doc_id").alias("near_id"))
    texts = docs.join(near_ids.distinct(), F.col("doc_id").eqNullSafe(F.col("near_id")), "left_semi").select("text")
    sets = stage.table(texts.mapInArrow(_full, "key long, n long, members array<long>"), "sets")

    # Distances to pivots.
    size = F.least(F.floor(F.col("n") * 3 / 8) + 1, F.floor(F.col("pivot_n") * 3 / 8) + 1)
    regions = stage.table(regions.join(near, ["key", "n"]), "regions")
    to_pivots = (
        runs(regions, F.desc("central")).where("(key, n) != (pivot, pivot_n)").groupBy("key", "n", "pivot", "pivot_n").agg(F.count("*").alias("met"))
        .where(F.col("met") >= 0.4 * size).where(_FITS)
    )
    to_pivots = stage.table(to_pivots.select("key", "n", "pivot", "pivot_n"), "to-pivots")
    measured = stage.table(distances(to_pivots, sets), "measured")
    links = _linked(measured).select(_node("key", "n").alias("u"), _node("pivot", "pivot_n").alias("v"))
    first = components(links, stage, "first")

    # Each set's region (its nearest pivot, a pivot's own) and component so far.
    near_by = F.col("shared") / (F.col("n") + F.col("pivot_n") - F.col("shared"))
    homes = measured.groupBy("key", "n").agg(F.max_by(F.struct("pivot", "pivot_n", "shared"), F.struct(near_by, "pivot", "pivot_n")).alias("home"))
    pivots = measured.select(F.col("pivot").alias("key"), F.col("pivot_n").alias("n")).distinct()
    homes = stage.table(homes.join(pivots, ["key", "n"], "left_anti").select("key", "n", "home.*").withColumn("node", _node("key", "n")), "homes")
    marks = near.withColumn("node", _node("key", "n")).join(first, "node", "left").join(homes.drop("node"), ["key", "n"], "left")
    marks = marks.select(
        "key", "n", F.xxhash64(F.coalesce("component", "node")).alias("component"),
        F.xxhash64(F.coalesce("pivot", "key"), F.coalesce("pivot_n", "n")).alias("region"),
    )
    marks = stage.table(marks, "marks")

    # Pairs of different regions that meet, and the number of crowded shingles of each set.
    met = stage.table(_cross_pairs(regions.select("shingle", "key", "n").join(marks, ["key", "n"]), CROWD), "met")
    crowds = met.where("(key, n) = (pivot, pivot_n)").select("key", "n", F.col("met").alias("crowded"))
    # Linked sets share at least ``least`` of their heads; of these, some may have met at crowded shingles.
    both = F.ceil(3 * (F.col("n") + F.col("pivot_n")) / 7)
    least = F.least(*[F.floor(F.col(n) * 3 / 8) + 1 - F.col(n) + both for n in ("n", "pivot_n")])
    pairs = met.where("(key, n) != (pivot, pivot_n)").join(crowds, ["key", "n"], "left")
    pairs = pairs.where(F.col("met") + F.coalesce("crowded", F.lit(0)) >= least).drop("met", "crowded")
    heavy = stage.table(crowds.where(F.col("crowded") >= window).select("key", "n"), "heavy")
    if not heavy.isEmpty():
        pairs = pairs.union(_heavy_pairs(heavy, sets, marks, stage))

    # Pairs inside regions.
    within, inside = _within(homes, first, sets, stage)
    pairs = stage.table(pairs.union(within).distinct(), "met-pairs")
    pairs = stage.table(_windowed(pairs, measured), "pairs")
    more = _linked(distances(pairs, sets)).select(_node("key", "n").alias("u"), _node("pivot", "pivot_n").alias("v"))
    known = first.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
    final = components(known.union(more).union(inside), stage, "final")

    classes = profiles.groupBy("key", "n").agg(F.min("doc_id").alias("low")).withColumn("node", _node("key", "n"))
    classes = stage.table(classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node")), "classes")
    lows = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = classes.join(lows, "component").select("key", "n", "component_id")
    alone = F.col("n") == 0
    joined = profiles.select("doc_id", "n", "key").join(classes, ["key", "n"])
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _node(key: str, n: str):
    return F.struct(F.col(key).alias("key"), F.col(n).alias("n"))


def _windowed(pairs: DataFrame, measured: DataFrame) -> DataFrame:
    """Without pairs that were compared, or whose distances to a common pivot differ by more than 0.25."""
    apart = (1 - F.col("shared") / (F.col("n") + F.col("pivot_n") - F.col("shared"))).alias("apart")
    seen = measured.select("key", "n", "pivot", "pivot_n", apart)
    one = seen.select("key", "n", F.struct("pivot", "pivot_n").alias("at"), F.col("apart").alias("d1"))
    two = seen.select(F.col("key").alias("pivot"), F.col("n").alias("pivot_n"), F.struct("pivot", "pivot_n").alias("at"), F.col("apart").alias("d2"))
    too_far = pairs.join(one, ["key", "n"]).join(two, ["pivot", "pivot_n", "at"]).where("abs(d1 - d2) > 0.25 + 1e-9")
    names = ["key", "n", "pivot", "pivot_n"]
    swapped = seen.select(F.col("pivot").alias("key"), F.col("pivot_n").alias("n"), F.col("key").alias("pivot"), F.col("n").alias("pivot_n"))
    drop = too_far.select(names).union(seen.select(names)).union(swapped)
    return pairs.join(drop, names, "left_anti")


def _heavy_pairs(heavy: DataFrame, sets: DataFrame, marks: DataFrame, stage: Stage) -> DataFrame:
    """Pairs of heavy sets that share one of their rarest shingles; whole sets, nothing left out.

    Shingles that one heavy set alone holds are rarest. A set of which these are more than it can do without has no
    link; only what is left is sorted by frequency.
    """
    chosen = sets.join(heavy, ["key", "n"], "left_semi")
    for part in (2, 1):
        # First half of every set, then what is left in whole.
        members = F.slice("members", F.lit(1), F.ceil(F.col("n") / part).cast("int"))
        # Dealt out evenly: where the sets were stored, heavy ones may lie together.
        dealt = chosen.select("key", "n", members.alias("members")).repartition(partitions(sets.sparkSession), "key", "n")
        held = stage.table(runs(dealt.select(F.explode("members").alias("shingle"), "key", "n")).select("shingle", "key", "n"), f"heavy-shared-{part}")
        spare = F.col("n") - F.ceil(0.75 * F.col("n")) + 1 - (F.ceil(F.col("n") / part) - F.col("kept"))
        kept = held.groupBy("key", "n").agg(F.count("*").alias("kept")).withColumn("spare", spare).where("spare > 0")
        kept = stage.table(kept.drop("kept"), f"heavy-kept-{part}")
        chosen = chosen.join(kept, ["key", "n"], "left_semi")
    held = held.join(kept, ["key", "n"])
    counts = held.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1")
    order = Window.partitionBy("key", "n").orderBy("held", "shingle")
    rare = held.join(counts, "shingle").withColumn("place", F.row_number().over(order)).where("place <= spare")
    return _cross_pairs(rare.select("shingle", "key", "n").join(marks, ["key", "n"]), None).drop("met")


def _possible() -> Column:
    """Links keep within a seventh of both sizes; so does the difference of their distances to the pivot, or a centre."""
    return (
        (F.struct("key", "n") != F.struct("other_key", "other_n")) & (F.col("component") != F.col("other_component"))
        & (7 * F.abs(F.col("apart") - F.col("other_apart")) <= F.col("n") + F.col("other_n"))
    )


def _within(homes: DataFrame, first: DataFrame, sets: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """Pairs to compare in small regions, and links (``u, v``) found in large ones, of sets of one region."""
    apart = F.col("n") + F.col("pivot_n") - 2 * F.col("shared")
    members = homes.select("key", "n", "pivot", "pivot_n", "node", apart.alias("apart")).join(first, "node", "left")
    members = members.withColumn("component", F.xxhash64(F.coalesce("component", "node"))).drop("node")
    members = members.withColumn("loose", 7 * F.col("apart") > F.col("n") + F.col("pivot_n"))
    cells = members.groupBy("pivot", "pivot_n").agg(F.count("*").alias("size"), F.count_if("loose").alias("loose_ones"))
    cells = cells.where("size > 1 and loose_ones > 0").drop("loose_ones")
    members = stage.table(members.join(cells, ["pivot", "pivot_n"]), "members")
    one = members.where("loose")
    names = ["key", "n", "apart", "component"]
    other = members.select("pivot", "pivot_n", *[F.col(c).alias(f"other_{c}") for c in names])
    small = one.where(F.col("size") <= CROWD).join(other, ["pivot", "pivot_n"]).where(_possible())
    small = small.select("key", "n", F.col("other_key").alias("pivot"), F.col("other_n").alias("pivot_n")).where(_FITS)
    first_key = F.struct("key", "n") > F.struct("pivot", "pivot_n")
    small = small.select(*[F.when(first_key, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in (("key", "pivot"), ("n", "pivot_n"), ("pivot", "key"), ("pivot_n", "n"))])

    return small, _recentred(members.where(F.col("size") > CROWD), sets, stage)


def _recentred(members: DataFrame, sets: DataFrame, stage: Stage) -> DataFrame:
    """Links (``u, v``) between sets of one large region.

    What the pivot has of its own differs from nearly all sets of its region. So distances are taken from a centre:
    the pivot's set, changed in all that more than half of the region differ in. Any centre gives exact results.
    """
    cell, names = ["pivot", "pivot_n"], ["key", "n", "apart", "component"]
    pairs = members.select("key", "n", *cell)
    changes = _beside(pairs, sets).mapInArrow(_majority, "pivot long, pivot_n long, shingle long, held long")
    changes = changes.groupBy(*cell, "shingle").agg(F.sum("held").alias("held"))
    sizes = members.groupBy(*cell).agg(F.count("*").alias("size"))
    changes = sizes.join(changes, cell, "left").groupBy(*cell).agg(
        F.collect_list(F.when(F.col("held") * 2 > F.col("size"), F.col("shingle"))).alias("changed")
    )
    of_pivot = changes.select(F.col("pivot").alias("key"), F.col("pivot_n").alias("n"), "changed")
    centre = F.array_union(F.array_except("members", "changed"), F.array_except("changed", "members"))
    centres = stage.table(sets.join(of_pivot, ["key", "n"]).select("key", "n", centre.alias("members")), "centres")

    rows = _beside(pairs, sets, centres)
    rows = rows.mapInArrow(_differences, "key long, n long, pivot long, pivot_n long, shingle long").distinct()
    rows = stage.table(rows, "differences")
    shared = rows.groupBy(*cell, "shingle").agg(F.count("*").alias("held"), F.min("key").alias("key"), F.min("n").alias("n"))
    shared = stage.table(shared, "difference-counts")
    # For each set its distance from the centre, and how many of these differences are its alone.
    apart = rows.groupBy(*cell, "key", "n").agg(F.count("*").alias("apart"), F.lit(0).alias("lone"))
    lone = shared.where("held = 1").groupBy(*cell, "key", "n").agg(F.lit(0).alias("apart"), F.count("*").alias("lone"))
    none = members.select(*cell, "key", "n", F.lit(0).alias("apart"), F.lit(0).alias("lone"), "component", F.col("loose").alias("free"))
    missing = [F.lit(None).cast("long").alias("component"), F.lit(None).cast("boolean").alias("free")]
    measures = none.union(apart.select("*", *missing)).union(lone.select("*", *missing)).groupBy(*cell, "key", "n")
    large = measures.agg(F.sum("apart").alias("apart"), F.sum("lone").alias("lone"), F.max("component").alias("component"), F.max("free").alias("free"))
    # x and y can only link if x.need <= y.reach and y.need <= x.reach; they do link if x.need + y.need <= 0.
    reach, need = 7 * (F.col("apart") - 2 * F.col("lone")) + F.col("n"), 7 * F.col("apart") - F.col("n")
    large = stage.table(large.withColumn("reach", reach).withColumn("need", need), "large")
    bounds = large.groupBy(*cell).agg(
        F.min(F.struct("need", "free", "key", "n")).alias("nearest"), F.max("reach").alias("most"), F.max("need").alias("high"),
        *[f(F.when(F.col("free"), F.col(c))).alias(f"free_{name}") for f, c, name in ((F.max, "reach", "most"), (F.max, "need", "high"), (F.min, "need", "low"))],
    )
    # Where the nearest links with the pivot, only sets that don't ("free") can be loose.
    bounds = bounds.withColumn("low", F.col("nearest.need")).select(
        *cell, "nearest", "low", "most", F.col("nearest.free").alias("all"),
        *[F.when(F.col("nearest.free"), F.col(c)).otherwise(F.col(f"free_{c}")).alias(f"loose_{c}") for c in ("most", "high", "low")],
    )
    large = stage.table(large.join(bounds, cell), "bounded")
    star = large.where("need + low <= 0").select(_node("key", "n").alias("u"), _node("nearest.key", "nearest.n").alias("v"))
    # All others are loose: what they need is at least this, and they share a difference with any set they link with.
    floor = F.greatest(1 - F.col("low"), F.col("loose_low"))
    loose = F.expr("(free or all) and need + low > 0 and need <= most")
    right = (F.col("reach") >= floor) & (F.col("need") <= F.col("loose_most"))
    large = large.where("loose_high + low > 0").withColumn("loose", loose).withColumn("right", right).where("loose or right")
    # y shares this many of its differences at least with any loose set of its region, so of its shared differences,
    # rarest first, all but so many are enough to meet it.
    fewest = F.greatest(F.ceil((floor + F.col("need")) / 14), F.lit(1)).alias("fewest")
    candidates = large.select(*cell, *names, "need", "reach", "loose", "right", fewest)
    both = rows.join(candidates, [*cell, "key", "n"]).join(shared.where("held > 1").select(*cell, "shingle", "held"), [*cell, "shingle"])
    both = stage.table(both, "shared-differences")
    left = both.where("loose").select(*cell, "shingle", *names, "need", "reach")
    of_one = Window.partitionBy(*cell, "key", "n")
    right = both.where("right").withColumn("place", F.row_number().over(of_one.orderBy("held", "shingle"))).withColumn("of", F.count("*").over(of_one))
    right = right.where("place <= of - fewest + 1")
    right = right.select(*cell, "shingle", *[F.col(c).alias(f"other_{c}") for c in (*names, "need", "reach")])
    met = left.join(right, [*cell, "shingle"]).where(_possible()).where("need <= other_reach and other_need <= reach")
    met = met.select(*cell, "key", "n", "apart", "other_key", "other_n", "other_apart").distinct()
    whole = both.groupBy(*cell, "key", "n").agg(F.collect_list("shingle").alias("own"))
    other = whole.select(*cell, F.col("key").alias("other_key"), F.col("n").alias("other_n"), F.col("own").alias("other_own"))
    met = met.join(whole, [*cell, "key", "n"]).join(other, [*cell, "other_key", "other_n"])
    met = met.withColumn("common", F.size(F.array_intersect("own", "other_own")))
    found = met.where("7 * (apart + other_apart - 2 * common) <= n + other_n")
    return star.union(found.select(_node("key", "n").alias("u"), _node("other_key", "other_n").alias("v")))


#: Every pair that shares a shingle, and all that links lead to: for small tables.
SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS s
  FROM d
), n AS (
  SELECT doc_id, count(s) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY 1
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM c JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.other = l.x
)
SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM r JOIN n USING (doc_id) GROUP BY 1, 2
"""
