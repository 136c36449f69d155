import tracemalloc

import numpy as np
import pyarrow as pa

from tripmart.llm import words
from tripmart.llm.quality import measures


def peak_bytes(function, *args):
    function(*args)  # what is kept from call to call isn't counted twice
    words._powers.clear()
    tracemalloc.start()
    try:
        function(*args)
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_word_has_one_hash_wherever_it_stands():
    long = "x" * (5 * words.BLOCK_BYTES)
    text = " ".join(["ab", long, "é", *(f"w{i % 97}" for i in range(60_000)), long + "y", "ab"])
    data, offsets = words.buffers(pa.array([None, text, "ab x", ""]))
    begins, ends, first = words.spans(data, offsets)
    found = words.word_hashes(data, begins, ends)
    alone = {}
    for at in [*range(50), *range(len(begins) - 50, len(begins))]:
        word = data[begins[at] : ends[at]]
        alone[at] = words.word_hashes(word, np.array([0]), np.array([len(word)]))[0]
    assert all(found[at] == value for at, value in alone.items())
    assert list(first) == [0, 0, 60_005, 60_007, 60_007]
    assert found[0] == found[60_004] == found[60_005] and len(set(found)) == 97 + 5
    assert not len(words.word_hashes(data[:0], begins[:0], ends[:0]))


def test_memory_of_hashes_is_that_of_the_words_and_a_block():
    text = " ".join(f"word{i}" for i in range(words.CHUNK_BYTES // 10))
    data, offsets = words.buffers(pa.array([text]))
    begins, ends, _ = words.spans(data, offsets)
    assert peak_bytes(words.word_hashes, data, begins, ends) < 8 * len(begins) + 64 * words.BLOCK_BYTES
    assert peak_bytes(measures, pa.array([text])) < 20 * len(data)
