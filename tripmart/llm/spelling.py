"""Spelling variants: words that differ by one code point, found with an index of variable-length grams.

``group`` takes words with their numbers of occurrences and finds for each word the words near to it (one code
point inserted, deleted or replaced), its form (the commonest near word, if ten times as common) and its root.

1. The gram dictionary. Occurrences of all grams of 2 to 4 code points are counted. A gram that occurs often is
   extended, one that doesn't is kept as it is; so the dictionary is given by the frequent grams alone. They are those with
   more than 1 in ``DICTIONARY`` of all occurrences, hence at most ``DICTIONARY`` of each length: a proven bound
   for what is broadcast.
2. Each word is decomposed: from every position, a gram grows while it is frequent.
3. One edit can affect only grams that hold the edited place. The most that any place of a word is held by is the word's
   bound: of its grams, one more than the bound can't all be affected. So of each word only its rarest
   grams are listed, bound + 1 of them; two near words have one of these in common, at the
   same place from the left or from the right. (A word of 7 code points has 6 grams and a bound of at most 4. Words of
   fewer than 6, which ``group`` takes too, may have no gram left, and are in one list besides.)
4. Lists. A common gram left of the edit has the same text before it in both words, right of the edit the same text after
   it. So the lists are kept by the word's beginning up to the gram's end, and by its end from the gram's
   begin; members hold only the rest of the word. A list of more than ``LONG`` words is divided by what is
   left of the rest when one code point is deleted (or none): two rests that are one edit apart share such a part, so
   no list makes all its pairs.
5. Rests of one list are compared exactly.

Words are compared by code points. Results don't depend on the dictionary, which only decides how long lists are.
``observed`` makes the words of a corpus. NULL and empty texts have no words; a NULL id counts as an empty number; equal rows
count as often as they are there. An empty table gives no rows. Very long words are words like others; other
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.staging import Stage
from tripmart.llm.words import chunks, mixed, slices, strings

#: Words are runs of these, A-Z counted as a-z.
LETTERS = "a-zÀ-ÿ"
SHORTEST = 7
LEAST = 2
#: One in so many observed runs loses a code point.
SLIP = 31
FORM_FACTOR = 10
GRAM_LEAST, GRAM_MOST = 2, 4
DICTIONARY = 20_000
#: A gram that fewer words hold is rare in any dictionary.
RARE = 16
LONG = 32
PART = 1 << 20
#: Counts that a task holds before it passes them on.
HELD = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))


def _counted(names: list[str], counts: Iterator[Counter]) -> Iterator[pa.RecordBatch]:
    """Batches of summed counts, passed on whenever there are many."""
    total: Counter = Counter()
    for count in counts:
        total.update(count)
        if len(total) >= HELD:
            yield _batch(names, total)
            total = Counter()
    yield _batch(names, total)


def _batch(names: list[str], total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names)


def observed(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word, n``: the words of ``docs`` (``doc_id, text``) and their occurrences.

    Where the hash of a document's id and a run says so, the run loses a code point: slips of the pen,
    which make variants to be found. Words of fewer than ``shortest`` code points or ``least`` occurrences are left out.
    """
    from pyspark.sql.types import LongType, StringType, StructType

    def count(batches):
        import re

        runs = re.compile(f"[{LETTERS}]{{{shortest},}}")

        def counts():
            for batch in batches:
                for part in chunks(batch, "text"):
                    for doc_id, text in zip(part.column("doc_id").to_pylist(), strings(part.column("text"))):
                        own: Counter = Counter()
                        for piece in slices(text, PART):
                            own.update(runs.findall(piece.encode().lower().decode()))
                        begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                        slipped = Counter()
                        for run, n in own.items():
                            h = zlib.crc32(run.encode(), begin)
                            if h % SLIP == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                            if len(run) >= shortest:
                                slipped[run] += n
                        yield slipped

        yield from _counted(["word", "n"], counts())

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = chosen.mapInArrow(count, StructType().add("word", StringType()).add("n", LongType()))
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The grams that are extended, with how often they occur in ``words``: at most ``DICTIONARY`` of each length."""

    def count(batches):
        def counts():
            for batch in batches:
                for word in batch.column("word").to_pylist():
                    yield Counter(word[p : p + q] for q in range(GRAM_LEAST, GRAM_MOST + 1) for p in range(len(word) - q + 1))

        yield from _counted(["gram", "n"], counts())

    grams = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum(F.char_length("word") - 1).alias("n")).first()["n"] or 0
    return {row.gram: row.n for row in grams.where(F.col("n") > max(RARE, total // DICTIONARY)).collect()}


def decompose(word: str, frequent: dict[str, int]) -> tuple[list[tuple[int, int]], int]:
    """The grams of a word, as (begin, end), and the most of them that one edit can affect."""
    size = len(word)
    grams, holds = [], [0] * (size + 1)
    for begin in range(size - GRAM_LEAST + 1):
        end = begin + GRAM_LEAST
        while end - begin < GRAM_MOST and end < size and word[begin:end] in frequent:
            end += 1
        grams.append((begin, end))
        holds[begin] += 1
        holds[end] -= 1
    most = held = 0
    for change in holds:
        held += change
        most = max(most, held)
    return grams, most


def listed(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """The grams under which a word is listed: its rarest, one more than an edit can affect."""
    grams, bound = decompose(word, frequent)
    # Of equal grams the first one comes first: an edit leaves their order as it is.
    return sorted(grams, key=lambda g: (frequent.get(word[g[0] : g[1]], 0), word[g[0] : g[1]], g[0]))[: bound + 1]


def shortened(rests: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of texts and of all that is left of each when one code point is deleted, and of which text each is."""
    sizes = np.array([len(rest) for rest in rests], np.int64)
    points = np.frombuffer("".join(rests).encode("utf-32-le"), "<u4")
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(rests)), sizes)
    powers = np.full(int(sizes.max(initial=0)) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = mixed(points.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(points)) - begins[owner]]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    # Deleting any one of equal neighbours leaves the same.
    first = np.ones(len(points), bool)
    first[1:] = (points[1:] != points[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    own = owner[at]
    # What follows the deleted code point moves one place to the left.
    parts = sums[at] - sums[begins[own]] + (sums[ends[own]] - sums[at + 1]) * _INVERSE
    whole = sums[ends] - sums[begins]
    return np.concatenate([whole, parts]).view(np.int64), np.concatenate([np.arange(len(rests)), own])


LISTED = "side boolean, shared string, rest string, n long"


def lists(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``side, shared, rest, n``: each word (``word, n``) under its rarest grams."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def listing(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                rows = []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                    grams = listed(word, shared.value)
                    if len(word) < GRAM_LEAST + GRAM_MOST:
                        rows.append((True, "", word, n))
                    rows += [(True, word[:end], word[end:], n) for end in {end for _, end in grams}]
                    rows += [(False, word[at:], word[:at], n) for at, _ in grams]
                columns = list(zip(*rows)) if rows else [()] * 4
                kinds = (pa.bool_(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["side", "shared", "rest", "n"])

    return words.select("word", "n").mapInArrow(listing, LISTED)


def _divided(members: DataFrame) -> DataFrame:
    """``key, side, shared, rest, n``: members of lists (with the ``size`` of the list), those of long ones once for each shortened rest."""

    def divide(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                key = part.column("key").to_numpy()
                long = np.flatnonzero(part.column("size").to_numpy() > LONG)
                parts, owner = shortened(part.column("rest").take(pa.array(long)).to_pylist())
                short = np.setdiff1d(np.arange(part.num_rows), long)
                rows = part.select(["side", "shared", "rest", "n"]).take(pa.array(np.concatenate([short, long[owner]])))
                divisions = mixed(parts.view(np.uint64) ^ mixed(key[long[owner]].view(np.uint64))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([key[short], divisions])), *rows.columns], ["key", *rows.schema.names])

    return members.mapInArrow(divide, "key long, " + LISTED)


def near_pairs(words: DataFrame, stage: Stage) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of ``words`` (``word, n``) that differ by one code point."""
    members = lists(words, frequent_grams(words)).withColumn("key", F.xxhash64("side", "shared"))
    members = stage.table(members, "lists")
    # A word alone in its list is near to none there.
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = stage.table(_divided(members.join(sizes.hint("shuffle_hash"), "key")), "divided")
    a, b = members.alias("a"), members.alias("b")
    apart = (F.abs(F.char_length("a.rest") - F.char_length("b.rest")) <= 1) & (F.levenshtein("a.rest", "b.rest", 1) == 1)
    found = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.rest") < F.col("b.rest")) & apart)

    def whole(x: str) -> Column:
        return F.when(F.col(f"{x}.side"), F.concat(f"{x}.shared", f"{x}.rest")).otherwise(F.concat(f"{x}.rest", f"{x}.shared"))

    # Keys are hashes, so what is found is compared as whole words. The lesser word comes first, whichever list a pair is from.
    ends = [F.struct(whole(x).alias("word"), F.col(f"{x}.n").alias("n")) for x in "ab"]
    pairs = found.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
    pairs = pairs.where(F.levenshtein("a.word", "b.word", 1) == 1)
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select(F.explode(both).alias("p")).select(
        F.col("p.a.word").alias("word"), F.col("p.a.n").alias("n"), F.col("p.b.word").alias("near"), F.col("p.b.n").alias("near_n")
    )


def _roots(forms: DataFrame, most: int, stage: Stage) -> DataFrame:
    """``word, root`` of every word that has a form (``word, form``).

    A form is ten times as common as its word, so no chain is longer than the digits of the largest count;
    each round doubles the steps taken.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    for turn in range(math.ceil(math.log(max(most, 1), FORM_FACTOR)).bit_length()):
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = stage.table(
            reached.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"roots-{turn}"
        )
    return reached


def group(words: DataFrame, stage: Stage | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each of ``words`` (``word, n``; rows of one word are summed, NULL is none)."""
    stage = stage or Stage(words.sparkSession)
    words = words.where("word IS NOT NULL").groupBy("word").agg(F.sum(F.col("n").cast("long")).alias("n"))
    words = stage.table(words, "words")
    pairs = near_pairs(words, stage)
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"), F.col("n"))).alias("best")
    )
    enough = -F.col("best.less") >= FORM_FACTOR * F.col("best.n")
    near = stage.table(
        best.select(
            "word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
        ),
        "near",
    )
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(near.where("form IS NOT NULL"), most, stage)
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
