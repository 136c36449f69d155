"""Byte-level BPE: texts to token ids and back, by dynamic programming over byte prefixes.

The tokens of a byte string are such that any two neighbours, put together and merged alone, stay these two
tokens; and that holds for no other way to cut the string. So every prefix has exactly one last token, found
from shorter prefixes alone: of the vocabulary entries that the prefix ends with, the one that fits behind the last token of
what is left. ``Prefixes`` stores it for each prefix. That takes time in proportion to the length, whatever the
text, and what is stored stays right when more bytes follow: appending never looks back
further than the longest entry. After an edit, prefixes are worked out again from the edit on, only until as many in a
row as the longest entry has bytes are what they were; from there the old ones hold.

An automaton finds the entries that end at each byte. Whether two tokens fit is worked out once a pair by
merging their bytes by rank, and kept.

Texts are split by the vocabulary's pattern first, and each match is encoded by itself; a match that is an entry as a whole
is that entry. Encodings of short matches are kept for the next text, at most ``KEPT`` of them. Very long texts are split
in parts, cut where no match can reach over. NULL texts count as empty and have no tokens; NULL id lists too.
Bytes that aren't UTF-8 count as U+FFFD. Ids that are NULL or not in the vocabulary decode to U+FFFD. Rows with equal ids
are separate rows; other columns are ignored. The vocabulary file is a parameter, read on the driver and
broadcast: its size depends on the vocabulary alone (about 1 MB for 50,000 entries).
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.words import chunks, slices, strings

#: How many matches and pairs of tokens are kept, how long a kept match may be, and the parts of long texts.
KEPT, KEPT_CHARS = 1 << 19, 64
PAIRS = 1 << 20
PART = 1 << 20
#: Rows are decoded in groups of about so many ids.
DECODED = 1 << 19
UNKNOWN = "�".encode()
#: A rank above all ids.
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Entries of a file of base64 texts and ranks, with their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(entry): int(rank) for entry, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Entries by id, an automaton that finds them in bytes, and which pairs of tokens fit."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold all single bytes")
        self.ranks = ranks
        self.entries = {rank: entry for entry, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.automaton = ahocorasick.Automaton()
        for entry, rank in ranks.items():
            self.automaton.add_word(entry.decode("latin-1"), (rank, len(entry)))
        self.automaton.make_automaton()
        self.fitting: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """A few bytes, merged pair by pair: always the pair of least rank, the leftmost of equal ones."""
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [rank(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        while ranks and (least := min(ranks)) != NEVER:
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], NEVER)
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before``, or begin a string (-1)."""
        known = self.fitting.get((before, token))
        if known is None:
            if len(self.fitting) >= PAIRS:
                self.fitting.clear()
            tokens = [self.entries[t] for t in (before, token) if t >= 0]
            known = self.fitting[before, token] = self.merged(b"".join(tokens)) == tokens
        return known


class Prefixes:
    """A byte string and the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last = array("i")
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self._work_out()

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of the bytes from ``begin`` to ``end``; returns how many prefixes were worked out again."""
        old = self.last[end:]
        self.data[begin:end] = new
        del self.last[begin:]
        self._work_out(begin + len(new), old)
        count = len(self.last) - begin
        self.last.extend(old[len(self.last) - begin - len(new) :])
        return count

    def _work_out(self, after: int = 0, old: array | None = None) -> None:
        """Finds the last tokens that aren't known, until ``longest`` in a row from ``after`` on are as in ``old``."""
        vocabulary, last = self.vocabulary, self.last
        fitting, same = vocabulary.fitting, 0
        back = max(0, len(last) + 1 - vocabulary.longest)
        wanted = len(last) - back
        for at, (token, size) in vocabulary.automaton.iter(self.data[back:].decode("latin-1")):
            if at != wanted:
                if at < wanted:
                    continue
                break
            before = last[back + at - size] if back + at >= size else -1
            known = fitting.get((before, token))
            if known or known is None and vocabulary.fits(before, token):
                last.append(token)
                wanted += 1
                if old is not None and back + at >= after:
                    same = same + 1 if token == old[back + at - after] else 0
                    if same == vocabulary.longest:
                        return
        if len(last) < len(self.data):
            raise ValueError(f"no token can end byte {len(last)}: the ranks aren't those of merges")

    def tokens(self) -> list[int]:
        whole = self.vocabulary.ranks.get(bytes(self.data)) if len(self.data) <= self.vocabulary.longest else None
        if whole is not None:
            return [whole]
        found, at = [], len(self.data)
        while at:
            token = self.last[at - 1]
            found.append(token)
            at -= len(self.vocabulary.entries[token])
        return found[::-1]


class Pieces(dict):
    """The ids of matches, as little-endian 32-bit numbers; a match is encoded when it is first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(Prefixes(self.vocabulary, piece.encode()).tokens(), "<i4").tobytes()
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes texts and decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces = Pieces(self.vocabulary)

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian 32-bit numbers."""
        parts = (text,) if len(text) <= PART else slices(text, PART)
        return b"".join(b"".join(map(self.pieces.__getitem__, self.pattern.findall(part))) for part in parts)

    def decode(self, ids: np.ndarray) -> bytes:
        entries = self.vocabulary.entries
        return b"".join([entries.get(i, UNKNOWN) for i in ids.tolist()])


class Tokenizer:
    """Encodes and decodes columns with the entries of one file.

    A worker builds its codec once, next to the broadcast entries, and uses it for all of its tasks.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = spark.sparkContext.broadcast({"ranks": read_ranks(path), "pattern": pattern})

    def _codec(self):
        shared = self.shared

        def codec() -> Codec:
            held = shared.value
            if "codec" not in held:
                held["codec"] = Codec(held["ranks"], held["pattern"])
            return held["codec"]

        return codec

    def encode(self, docs: DataFrame) -> DataFrame:
        """``doc_id, ids`` for every row of ``docs`` (``doc_id, text``)."""
        codec = self._codec()

        def encode(batches):
            for batch in batches:
                for part in chunks(batch, "text"):
                    ids = [codec().encode(text) for text in strings(part.column("text"))]
                    offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

        chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        return chosen.mapInArrow(encode, "doc_id long, ids array<int>")

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``doc_id, data`` for every row of ``encoded`` (``doc_id, ids``): the bytes that the ids stand for."""
        codec = self._codec()

        def decode(batches):
            for batch in batches:
                sizes = np.cumsum(batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                cuts = np.searchsorted(sizes, np.arange(DECODED, int(sizes[-1:].sum()), DECODED))
                bounds = np.unique(np.concatenate([[0], cuts, [batch.num_rows]]))
                for begin, end in zip(bounds[:-1], bounds[1:]):
                    part = batch.slice(begin, end - begin)
                    data = [codec().decode(ids) for ids in _lists(part.column("ids"))]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

        return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(decode, "doc_id long, data binary")

    def digests(self, encoded: DataFrame) -> DataFrame:
        """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of what they decode to."""
        codec = self._codec()

        def digest(batches):
            for batch in batches:
                rows = [
                    (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(codec().decode(ids)).hexdigest())
                    for ids in _lists(batch.column("ids"))
                ]
                kinds = (pa.int64(), pa.string(), pa.string())
                columns = list(zip(*rows)) if rows else [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

        return encoded.select("doc_id", "ids").mapInArrow(
            digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        )


def _lists(lists: pa.ListArray) -> Iterator[np.ndarray]:
    """The ids of each row; NULL lists are empty, NULL ids -1."""
    lists = lists.fill_null([]) if lists.null_count else lists
    values = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    at = 0
    for size in lists.value_lengths().to_pylist():
        yield values[at : at + size]
        at += size
