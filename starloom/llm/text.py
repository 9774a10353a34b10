"""Words and hashes of whole texts, worked out for a slice of an Arrow column at a time.

A word is a longest run of bytes that are not separators; separators are ASCII, so words of UTF-8
text can be found in its bytes. Hashes depend on the bytes alone and are alike in every task.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_separators = np.zeros(256, bool)
_separators[[0x20, *range(0x09, 0x0E)]] = True
IN_WORD = ~_separators
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


def _random64(label: str, n: int) -> np.ndarray:
    seed = hashlib.sha256(label.encode()).digest()
    return np.random.Generator(np.random.PCG64(int.from_bytes(seed, "big"))).integers(0, 1 << 63, n, np.uint64)


_BYTE = _random64("byte", 256) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))
_powers = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the step and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_STEP, _INVERSE)):
            table = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts: text ``i`` has those from ``first[i]`` to before ``first[i + 1]``."""

    data: np.ndarray  # bytes of all texts, one after the other
    bounds: np.ndarray  # where each text begins in ``data``, and the end
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    sums: np.ndarray  # running sums of the bytes' hashes times the step's powers

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """For every word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from start to before end."""
        _, inverse = _power(len(self.data) + 1)
        return mix((self.sums[end] - self.sums[start]) * inverse[start])

    def hashes(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def characters(self) -> np.ndarray:
        """Where each code point begins in ``data``, and the end."""
        return np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it


def release() -> None:
    """Gives memory that is free back to the system: Python workers outlive the task, and the next one may need other memory."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of consecutive texts of at most ``limit`` bytes (or one longer text), with their first row; null: empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + limit, "right")))
        yield row, texts.slice(row, stop - row)
        row = stop
    del texts
    release()


def words(texts: pa.Array, *, fold: bool = False, in_word: np.ndarray = IN_WORD) -> Words:
    """Words of a column slice from :func:`slices`. ``fold`` lower-cases A-Z."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    if fold:
        raw = FOLD[raw]
    inside = in_word[raw]
    begin = inside.copy()
    last = inside.copy()
    if len(raw):
        begin[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        inner = bounds[(bounds > 0) & (bounds < len(raw))]
        begin[inner] = inside[inner]
        last[inner - 1] = inside[inner - 1]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(last) + 1
    power, _ = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:-1], out=sums[1:])
    return Words(raw, bounds, start, end, np.searchsorted(start, bounds), sums)


_WEIGHTS = _random64("window", 64) * np.uint64(2) + np.uint64(1)


def windows(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``k`` words from each word on; the last ``k - 1`` have none. Windows may reach into the next text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * _WEIGHTS[(j + 31 * seed) % 64]
    return mix(total)


def whole_windows(first: np.ndarray, k: int) -> np.ndarray:
    """For each window of all words in a row, whether it lies in one text."""
    n = int(first[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n, bool)
    for j in range(1, k):  # a window that begins j words before a text's end is cut, for j < k
        cut = first[1:] - j
        ok[cut[(cut >= 0) & (cut < n)]] = False
    return ok


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values from each bound to the next."""
    running = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bi" else np.float64)
    np.cumsum(values, out=running[1:])
    return running[bounds[1:]] - running[bounds[:-1]]


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and which of them are there at all."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def strings(arrow_column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return arrow_column.combine_chunks() if isinstance(arrow_column, pa.ChunkedArray) else arrow_column
