"""Words and word shingles of whole texts as 64-bit hashes, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. Hashes do not
depend on the process, the batch or the place of a word. Two different words (or
shingles) share a hash with odds of about 2**-64 a pair; counts and similarities
below take equal hashes for equal words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
CHUNK = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Splits texts into words and hashes them a megabyte at a time."""

    def __init__(self) -> None:
        byte = np.arange(256)
        lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        self._of_byte = seeded(256, 77)[lower]
        self._space = (byte == 32) | ((byte >= 9) & (byte <= 13))
        self._up = self._down = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            self._up, self._down = _powers(_ODD, n), _powers(_INVERSE, n)

    def _chunk(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of every word of ``data``; no word crosses a cut."""
        n = len(data)
        self._grow(n)
        word = ~self._space[data]
        first = np.ones(n + 1, bool)
        first[1:n] = ~word[:-1]
        first[cuts] = True
        starts = np.flatnonzero(word & first[:-1])
        ends = np.flatnonzero(word & np.append(~word[1:], True) | word & first[1:]) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self._of_byte[data] * self._up[:n], out=total[1:])
        hashes = (total[ends] - total[starts]) * self._down[starts]
        return mix(hashes + (ends - starts).astype(np.uint64)), starts, ends

    def words(self, column: pa.Array, tails: bool = False) -> tuple[np.ndarray, ...]:
        """Word hashes of all rows and the rows' bounds in them.

        With ``tails`` also each word's byte length and last byte. Null is empty.
        """
        data, offsets = text_bytes(column)
        hashes, counts, lengths, last = [], np.zeros(len(offsets) - 1, np.int64), [], []
        row = 0
        while row < len(offsets) - 1:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
            for lo, hi in self._pieces(data, int(offsets[row]), int(offsets[stop])):
                inner = offsets[row:stop][(offsets[row:stop] >= lo) & (offsets[row:stop] < hi)] - lo
                h, starts, ends = self._chunk(data[lo:hi], inner)
                hashes.append(h)
                if tails:
                    lengths.append(ends - starts)
                    last.append(data[lo:hi][ends - 1])
                counts[row:stop] += np.diff(np.searchsorted(starts + lo, np.append(offsets[row:stop], offsets[stop])))
            row = stop
        bounds = np.append(0, np.cumsum(counts))
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        if not tails:
            return flat, bounds
        join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        return flat, bounds, join(lengths), join(last)

    def _pieces(self, data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Cut one long text at white space, so that memory does not follow its length."""
        while hi - lo > 2 * CHUNK:
            cut = lo + CHUNK
            while cut < hi:
                near = np.flatnonzero(self._space[data[cut : min(cut + CHUNK, hi)]])
                if len(near):
                    cut += int(near[0])
                    break
                cut = min(cut + CHUNK, hi)
            yield lo, cut
            lo = cut
        if hi > lo:
            yield lo, hi


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets, without copies."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), offsets


def shingles(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order; of the whole run where it is shorter."""
    if not len(hashes):
        return hashes
    n = min(width, len(hashes))
    runs = len(hashes) - n + 1
    out = np.full(runs, n, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + runs]
    return mix(out)


def shingle_sets(column: pa.Array, hasher: Hasher) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each row's text."""
    for part in pieces(column):
        flat, bounds = hasher.words(part)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(shingles(flat[lo:hi]))


def pieces(column: pa.Array, rows: int = 250) -> Iterator[pa.Array]:
    """``column`` a few rows at a time, so that arrays per word stay small."""
    for at in range(0, len(column), rows):
        yield column.slice(at, rows)
