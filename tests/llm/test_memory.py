"""What steps of the training data hold at once, by tracemalloc, to which numpy reports."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from newslens.llm import arrays
from newslens.llm.pitman_yor import Chunk, Read, _by_number, line_pairs, widened


def peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_pairs_of_a_chunk_take_few_arrays():
    rng = np.random.default_rng(1)
    places = 400_000
    tokens = rng.integers(2, 50_000, places).astype(np.int32)
    hashes = np.unique(rng.integers(2, 1 << 62, 60_000).astype(np.uint64))
    found = []
    held = peak(lambda: found.append(line_pairs(tokens, np.full(places // 8, 8), hashes, 51)))
    assert held < 80 * places
    pairs, which, before, after = found[0]
    assert (pairs[1:] >= pairs[:-1]).all() and len(which) == places + places // 8 + 1
    assert (after[which[:8]] == tokens[:8]).all() and (before[which[1:8]] == tokens[:7]).all()


def test_answers_by_number():
    hashes = np.array([5, 1, 9], dtype=np.uint64)
    found = [{"slice": 1, "n": b"c"}, {"slice": 0, "n": b"ab"}]  # ascending by hash: 1, 5, 9
    got = _by_number(np.argsort(hashes), found, "n", lambda b: np.frombuffer(b, np.uint8))
    assert got.tobytes() == b"bac"


def test_powers_take_no_more_than_twice_what_is_asked_for():
    store = {}
    for n in (1, 5, 1000, 900):
        got = arrays._powers(7, n, store)
        assert len(got) == n and all(int(v) == pow(7, k, 1 << 64) for k, v in enumerate(got[:20]))
        assert len(store[7]) <= 2048


@pytest.mark.parametrize("texts", [[""], ["", "a b\nc", "", "b  a"], ["x"]])
def test_a_chunk_spells_its_words(texts):
    data, offsets = arrays.string_buffer(pa.array(texts))
    chunk = Chunk()
    for _ in range(2):  # two pieces have the same words
        chunk.add(pa.array(range(len(texts))), np.zeros(len(texts), dtype=bool), data, offsets)
    row = chunk.row(0).to_pylist()[0]
    spelled, lengths = zlib.decompress(row["spelled"]), widened(row["lengths"])
    ends = np.cumsum(lengths)
    words = [spelled[end - n : end].decode() for end, n in zip(ends, lengths)]
    assert words[:2] == ["", "\n"] and sorted(words[2:]) == sorted({w for t in texts for w in t.split()})
    assert [words[k] for k in Read(row).tokens] == [w for t in texts for w in t.split()] * 2
