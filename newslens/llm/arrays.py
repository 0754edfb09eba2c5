"""Arrays of bytes, code points and words for the Arrow steps of this subpackage.

Texts of a batch lie end to end in one buffer, so the work per character is array operations.
Hashes are sums of random byte values times powers of an odd number, modulo 2**64: the hash of
any part of a buffer is a difference of prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2_000_000  # bytes worked on at once; a longer text is one piece

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread permutation of uint64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int, store: dict = {}) -> np.ndarray:  # noqa: B006  kept for the worker's life
    have = store.get(base)
    if have is None or len(have) < n:
        size = max(1 << (n - 1).bit_length(), 1)  # no more than twice of what is asked for
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = store[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column in UTF-8; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_string())
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def pieces(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; at least one row each."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def _code_terms(seed: int, salt: np.uint64, store: dict = {}) -> np.ndarray:  # noqa: B006  kept as above
    if seed not in store:
        store[seed] = mixed((np.arange(0x10000, dtype=np.uint64) + _U(1)) * salt)
    return store[seed]


class Spans:
    """Hashes of parts of a sequence of bytes, code points (uint32) or other hashes (uint64)."""

    def __init__(self, values: np.ndarray, seed: int = 0):
        salt = _U((0xD1B54A32D192ED03 * (2 * seed + 1)) % (1 << 64))
        table = mixed((np.arange(256, dtype=np.uint64) + _U(1)) * salt)
        if values.dtype == np.uint8:
            terms = table[values]
        elif values.dtype == np.uint32:  # code points
            terms = _code_terms(seed, salt)[np.minimum(values, 0xFFFF)]
            far = np.flatnonzero(values >= 0xFFFF)
            terms[far] = mixed((values[far].astype(np.uint64) + _U(1)) * salt)
        else:
            terms = mixed((values.astype(np.uint64) + _U(1)) * salt)
        self.base = (_BASE + 2 * 0x51_7CC1_B727 * seed) % (1 << 64)
        self.inverse = pow(self.base, -1, 1 << 64)
        terms *= _powers(self.base, len(values))
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sum over [start, end), shifted so that equal parts are equal wherever they stand."""
        return (self.sums[end] - self.sums[start]) * _powers(self.inverse, len(self.sums))[start]

    def power(self, n: np.ndarray) -> np.ndarray:
        return _powers(self.base, len(self.sums))[n]


_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return _LOWER[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; a run never crosses an offset."""
    n = len(inside)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n + 1, dtype=bool)
    before[0], before[1:] = False, inside
    here = np.empty(n + 1, dtype=bool)
    here[:n], here[n] = inside, False
    return np.flatnonzero(here & (~before | edge)), np.flatnonzero(before & (~here | edge))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``."""
    return runs(~_GAP[data], offsets)


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row in which each position lies."""
    return np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed(Spans(data).raw(starts, ends))
