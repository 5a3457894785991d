"""Word hashing over raw Arrow string buffers (numpy, inside tasks).

Texts arrive as Arrow arrays, so a batch is one UTF-8 byte buffer plus offsets.
Words are maximal runs of bytes outside 0x20 and 0x09-0x0D, with A-Z
lower-cased on request; each gets a 64-bit polynomial hash, computed with
prefix sums over the whole buffer instead of one Python string per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_CHUNK = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def fmix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * _CHUNK)
        for i, p in enumerate((_P, _P_INV)):
            steps = np.full(size, p, np.uint64)
            steps[0] = 1
            _POWERS[i:i + 1] = [np.cumprod(steps)]
    return _POWERS[0], _POWERS[1]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or buffers[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; ``cuts`` are offsets that no word crosses."""
    word = ~_SPACE[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = word[1:] != word[:-1]
    edge[cuts] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = word[starts] if len(starts) else np.empty(0, bool)
    return starts[keep], ends[keep]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand.

    Works through about 1 MB of the buffer at a time, so memory does not grow with
    the batch (a single word above that size is one piece)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(int(np.searchsorted(ends, lo + _CHUNK, side="right")), i + 1)
        hi = ends[j - 1]
        power, inverse = _powers(int(hi - lo) + 1)
        piece = data[lo:hi]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(((_LOWER[piece] if lower else piece).astype(np.uint64) + np.uint64(1)) * power[:len(piece)],
                  out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return fmix(out ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def pieces(batch: pa.RecordBatch, column: str, size: int = 1 << 22):
    """Slices of a batch that hold about ``size`` bytes of ``column`` each (a longer text is one slice),
    so that what a task builds from one of them is bounded by the longest text."""
    sizes = np.diff(utf8(batch[column])[1])
    at = np.cumsum(sizes)
    lo = 0
    while lo < len(batch):
        hi = max(lo + 1, int(np.searchsorted(at, (at[lo - 1] if lo else 0) + size, side="right")))
        hi = min(hi, lo + 2000)
        yield batch.slice(lo, hi - lo)
        lo = hi
