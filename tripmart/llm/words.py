"""Words and word shingles of a column of texts, as 64-bit hashes, worked out on whole Arrow buffers.

A word is a run of bytes other than space and the five control characters from tab to carriage
return. Letters A-Z count as a-z. A shingle is a run of ``SHINGLE`` words; a text with fewer words has
one shingle, its whole sequence of words, and a text without words has none. NULL counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Texts are worked on in groups of about so many bytes, which bounds the memory of a task.
CHUNK_BYTES = 2 << 20
#: Words of a group are hashed so many bytes at a time (a longer word alone), as each byte takes a few 8-byte numbers.
BLOCK_BYTES = 1 << 16

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 2**64 - 1, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SHORT = _RANDOM.integers(1, 2**64 - 1, SHINGLE, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """The powers of ``base`` modulo 2**64, from 0."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, BLOCK_BYTES), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = known
    return known[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on 64-bit numbers whose results look random."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each text begins (with the end of the last)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``CHUNK_BYTES`` of text each, a longer text alone."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + CHUNK_BYTES, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def strings(texts: pa.Array) -> list[str]:
    """The texts, NULL as empty; bytes that aren't UTF-8 become U+FFFD."""
    texts = texts.fill_null("")
    try:
        return texts.to_pylist()
    except UnicodeDecodeError:
        return [text.decode("utf-8", "replace") for text in texts.cast(pa.large_binary()).to_pylist()]


def slices(text: str, size: int) -> Iterator[str]:
    """A text in parts of at least ``size`` code points, cut only before a space that follows no white space."""
    begin, at = 0, size
    while (at := text.find(" ", at)) >= 0:
        if text[at - 1].isspace():
            at += 1
        else:
            yield text[begin:at]
            begin, at = at, at + size
    yield text[begin:]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and the first word of each text (with the number of words last)."""
    solid = ~_SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    if len(data):
        first = offsets[:-1][offsets[:-1] < len(data)]
        begins[first] = solid[first]
        last = offsets[1:][offsets[1:] > 0] - 1
        ends[last] = solid[last]
    begins = np.flatnonzero(begins)
    return begins, np.flatnonzero(ends) + 1, np.searchsorted(begins, offsets)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A hash of each word, wherever it stands; words come in order and don't overlap."""
    codes = _BYTE[_LOWER] if lower else _BYTE
    inverse = pow(_BASE, -1, 2**64)
    found = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        low = int(begins[at])
        until = max(at + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, "right")))
        first, last = begins[at:until] - low, ends[at:until] - low
        values = codes[data[low : ends[until - 1]]]
        values *= _power(_BASE, len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        found[at:until] = mixed((sums[last] - sums[first]) * _power(inverse, len(values))[first])
        at = until
    return found


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all texts in order, and where each text's begin (with the end)."""
    data, offsets = buffers(texts)
    begins, ends, first = spans(data, offsets)
    words = word_hashes(data, begins, ends)
    count = np.diff(first)
    size = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(size)])
    # Word w of text i is the first of shingle w - (words of earlier texts) + (shingles of earlier texts).
    start = np.repeat(first[:-1] - bounds[:-1], size) + np.arange(bounds[-1])
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    total = np.zeros(len(start), np.uint64)
    left = np.repeat(count, size)
    for place in range(SHINGLE):
        part = padded[start + place] * _PLACE[place]
        total += np.where(left > place, part, _SHORT[place])
    return mixed(total), bounds
