"""Words and word-window hashes of whole Arrow text columns, computed with numpy.

Texts stay UTF-8 bytes. A *word* is a maximal run of bytes that are no ASCII white space
(x20, x09-x0D); every separator is ASCII, so bytes and code points give the same words.
Working memory follows the slice of texts at hand (``SLICE_BYTES``, or one text if that is longer): about 80 bytes for
one of text, which every worker process keeps for later slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18  # few enough for a core's cache
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_U = np.uint64
_RNG = np.random.default_rng(20240817)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """``base ** i`` modulo 2**64, kept per process; it travels to the tasks empty."""

    def __init__(self):
        self.known: dict[int, np.ndarray] = {}

    def __reduce__(self):
        return Powers, ()

    def upto(self, base: int, n: int) -> np.ndarray:
        known = self.known.get(base)
        if known is None or len(known) < n:
            known = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            known[0] = 1
            known = np.multiply.accumulate(known)
            if n <= 2 * SLICE_BYTES:  # a longer one is not kept
                self.known[base] = known
        return known[:n]


_POWERS = Powers()


def span_hashes(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-dependent 64-bit hash of ``values[start:end]`` for every span."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _POWERS.upto(base, n), out=sums[1:])
    back = _POWERS.upto(pow(base, -1, 1 << 64), n + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts, in order: byte borders, the text each belongs to, and a hash."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # first[i]:first[i + 1] are the words of text i
    hashes: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every run of ``k`` words inside one text."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        return at, span_hashes(self.hashes, _STEP, at, at + k)

    def window_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hashes(self.hashes, _STEP, starts, ends)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from row, to row, bytes, borders)`` of consecutive rows of a text column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, borders, data = column.buffers()
    offsets = np.frombuffer(borders, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, len(column))
        yield at, to, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def split_words(data: np.ndarray, borders: np.ndarray, lower: bool = False, gap: np.ndarray = SPACE) -> Words:
    """Words of consecutive texts; ``lower`` lower-cases A-Z before hashing."""
    n = len(data)
    if lower:
        data = _LOWER[data]
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, none, np.zeros(len(borders), np.int64), np.zeros(0, np.uint64))
    inside = ~gap[data]
    cut = np.zeros(n + 1, bool)  # a text begins here
    cut[borders] = True
    starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1] | cut[1:n])))
    ends = np.flatnonzero(inside & np.concatenate((~inside[1:] | cut[1:n], [True]))) + 1
    first = np.searchsorted(starts, borders)
    doc = np.repeat(np.arange(len(borders) - 1), np.diff(first))
    return Words(data, starts, ends, doc, first, span_hashes(_BYTE[data], _BASE, starts, ends))


def words_of(text: str, lower: bool = False) -> Words:
    data = np.frombuffer(text.encode(), np.uint8)
    return split_words(data, np.array([0, len(data)]), lower)


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as a Spark ``bigint`` column."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
