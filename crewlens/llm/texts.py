"""Texts of an Arrow batch as one byte array, with hashes of any byte range.

The range hash is polynomial: ``sum(table[byte] * BASE**position)`` modulo 2**64, kept as a
running sum, so that the hash of any range costs one subtraction and one multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes handled at once; a longer text is handled alone.
CHUNK = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256).astype(_U) * _U(2) + _U(1)
_powers = [np.ones(1, _U), np.ones(1, _U)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of several aligned hash arrays; their order matters."""
    out = parts[0]
    for p in parts[1:]:
        out = mix(out * _U(0x9FB21C651E98DF25) + p)
    return out


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=_U)
    return _powers[0][:n], _powers[1][:n]


class Ranges:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray) -> None:
        up, self.down = _power(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, _U)
        np.cumsum(_TABLE[buf] * up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self.sums[end] - self.sums[start]
        out *= self.down[start]
        return mix(out + (end - start).astype(_U))

    def windows(self, size: int) -> np.ndarray:
        """Hash of every range of ``size`` bytes, by start."""
        out = self.sums[size:] - self.sums[:-size]
        out *= self.down[: len(out)]
        return mix(out)


def chunks(texts: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of a string column: first row, one past the last row, bytes, offsets of the rows.

    Whole texts only; a null counts as empty.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + chunk, "right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row's first."""
    solid = ~SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:-1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)
