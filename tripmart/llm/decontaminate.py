"""Benchmark decontamination: test items found inside documents, however long these are.

An item is found in a document when at least ``PERCENT`` percent of its distinct five-word shingles occur
anywhere in the document. The search is a containment search by MinHash:

- Items are divided into size classes by powers of two. For a class of up to ``s`` shingles the stream of
  shingles of all documents is cut into windows of ``2 s`` at a step of ``s``. A passage that holds an item
  lies whole in one of them, so its similarity to the item's set has a lower bound that doesn't depend
  on the length of the document (0.17 for three quarters of the smallest item of a class).
- Every window and every item has ``HASHES`` minima. One equal minimum makes a candidate, which misses one in
  ten thousand items at the lower bound, and none in a million whole items.
- Candidates are verified on the exact shingle sets of the whole document, not of the window.

Documents are read once for each block of the benchmark, where they lie: nothing of them is shuffled. A block
holds at most ``BLOCK`` shingles (32 MB; a single longer item is a block of its own), and only a block is
ever sent to the tasks.

NULL texts count as empty; items or documents without words match nothing. An item with fewer than five
words is one shingle and matches only a document that consists of exactly these words. Items with equal
sets are all reported, and so is each of several rows with one ``doc_id``, once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.words import chunks, shingles

PERCENT = 75
HASHES = 48
BLOCK = 4_000_000
#: Smallest window step, and bits of the filter that candidates pass first.
STEP = 4
FILTER_BITS = 20

_FACTORS = np.random.default_rng(48).integers(1, 2**64 - 1, HASHES, dtype=np.uint64) | np.uint64(1)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            values, bounds = shingles(part.column("text"))
            sets = [np.unique(values[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(sets, pa.list_(pa.int64()))], ["item_id", "members"])


@dataclass
class Block:
    """Distinct item sets, the ids of each, and for each size class and permutation the sorted minima."""

    sets: list[np.ndarray]
    ids: list[list[int | None]]
    minima: dict[int, tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]]

    @classmethod
    def of(cls, items: dict[bytes, tuple[np.ndarray, list]]) -> Block:
        sets, ids = [s for s, _ in items.values()], [i for _, i in items.values()]
        level = np.array([max(0, int(np.ceil(np.log2(len(s) / STEP)))) for s in sets])
        minima = {}
        for k in map(int, np.unique(level)):
            own = np.flatnonzero(level == k)
            values, owners = [], []
            passes = np.zeros((HASHES, 1 << FILTER_BITS), bool) if len(own) < 5000 else None
            for h, factor in enumerate(_FACTORS):
                least = np.array([(sets[i] * factor).min() for i in own])
                order = np.argsort(least)
                values.append(least[order])
                owners.append(own[order])
                if passes is not None:
                    passes[h, least >> np.uint64(64 - FILTER_BITS)] = True
            minima[k] = (np.packbits(passes, axis=1) if passes is not None else None, values, owners)
        return cls(sets, ids, minima)

    def candidates(self, values: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """(document, item set) pairs of which some window shares a minimum."""
        found: set[tuple[int, int]] = set()
        if not len(values) or not self.minima:
            return found
        top = max(self.minima)
        padded = np.append(values, np.full(-len(values) % STEP, values[-1]))
        for h, factor in enumerate(_FACTORS):
            hashed = padded * factor
            least = np.minimum(np.minimum(hashed[0::4], hashed[1::4]), np.minimum(hashed[2::4], hashed[3::4]))
            for k in range(top + 1):
                if k:
                    least = np.minimum(least[0::2], np.append(least[1::2], least[-1:]) if len(least) % 2 else least[1::2])
                if k in self.minima:
                    windows = np.minimum(least[:-1], least[1:]) if len(least) > 1 else least
                    self._probe(windows, h, k, bounds, found)
        return found

    def _probe(self, windows: np.ndarray, h: int, k: int, bounds: np.ndarray, found: set) -> None:
        bits, values, owners = self.minima[k]
        hits = np.arange(len(windows))
        if bits is not None:
            place = (windows >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            hits = np.flatnonzero(bits[h][place >> 3] & (128 >> (place & 7)).astype(np.uint8))
        left = np.searchsorted(values[h], windows[hits], "left")
        right = np.searchsorted(values[h], windows[hits], "right")
        size = STEP << k
        for at in np.flatnonzero(right > left):
            begin = int(hits[at]) * size
            first = max(int(np.searchsorted(bounds, begin, "right")) - 1, 0)
            last = min(int(np.searchsorted(bounds, begin + 2 * size, "left")), len(bounds) - 1)
            for item in owners[h][left[at] : right[at]]:
                found.update((doc, int(item)) for doc in range(first, last))

    def found(self, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(document, item set, number of its shingles that the document has)."""
        values, bounds = shingles(texts)
        own, members = None, None
        for doc, item in sorted(self.candidates(values, bounds)):
            if doc != own:
                own, members = doc, np.unique(values[bounds[doc] : bounds[doc + 1]])
            if len(members):
                place = np.searchsorted(members, self.sets[item])
                place[place == len(members)] = 0
                shared = int((members[place] == self.sets[item]).sum())
                if 100 * shared >= PERCENT * len(self.sets[item]):
                    yield doc, item, shared


def blocks(items: DataFrame) -> Iterator[Block]:
    """The benchmark (``item_id``, ``text``) in blocks of bounded size."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = items.mapInArrow(_items, "item_id long, members array<long>").where(F.size("members") > 0)
    held: dict[bytes, tuple[np.ndarray, list]] = {}
    size = 0
    for row in rows.toLocalIterator():
        members = np.array(row.members, np.int64).view(np.uint64)
        if size and size + len(members) > BLOCK:
            yield Block.of(held)
            held, size = {}, 0
        entry = held.setdefault(members.tobytes(), (members, []))
        size += 1 if entry[1] else len(members)
        entry[1].append(row.item_id)
    if held:
        yield Block.of(held)


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_item, n_found, containment`` for every item found in a document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_item long, n_found long"
    result = spark.createDataFrame([], schema)
    for block in blocks(items):

        def search(batches, block=block):
            for batch in batches:
                for part in chunks(batch, "text"):
                    ids, rows = part.column("doc_id").to_pylist(), []
                    for doc, item, n in block.found(part.column("text")):
                        rows += [(ids[doc], i, len(block.sets[item]), n) for i in block.ids[item]]
                    columns = zip(*rows) if rows else ([], [], [], [])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_item", "n_found"])

        result = result.union(docs.mapInArrow(search, schema))
    return result.distinct().withColumn("containment", F.col("n_found") / F.col("n_item"))


def remove(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (any columns, among them ``text``) without the rows in which an item is found; no shuffle."""
    for block in blocks(items):

        def keep(batches, block=block):
            for batch in batches:
                for part in chunks(batch, "text"):
                    clean = np.ones(part.num_rows, bool)
                    clean[[doc for doc, _, _ in block.found(part.column("text"))]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


SQL = rf"""
WITH d AS (
  SELECT DISTINCT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS s
  FROM d WHERE len(w) > 0
), items AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS s
  FROM i WHERE len(w) > 0
), sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY 1),
found AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN items USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM found JOIN sizes USING (item_id) WHERE 100 * n_found >= {PERCENT} * n_item
"""
