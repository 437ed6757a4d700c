"""Vectorised text primitives over Arrow string columns.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  All functions work on
the UTF-8 buffer of a whole column at once; nothing loops over words in Python.
Large columns are processed in slices of bounded bytes, so memory does not follow
the length of the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WHITE_BYTES = b" \t\n\x0b\x0c\r"

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_CHUNK = 1 << 19


def _byte_codes() -> np.ndarray:
    """One odd 64-bit code per byte, from a splitmix sequence."""
    return mix(np.arange(1, 257, dtype=_U) * _U(0xBF58476D1CE4E5B9)) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection on 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


CODES = _byte_codes()
LOWER_CODES = CODES.copy()
LOWER_CODES[65:91] = CODES[97:123]
_POW = np.ones(1, _U)
_INV = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        n = 1 << int(n - 1).bit_length()
        _POW, _INV = np.full(n, _P, _U), np.full(n, _PINV, _U)
        _POW[0] = _INV[0] = 1
        np.multiply.accumulate(_POW, out=_POW)
        np.multiply.accumulate(_INV, out=_INV)
    return _POW, _INV


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    return raw, off - off[0]


def slices(off: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents that hold about ``most`` bytes each (one longer document alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(raw: np.ndarray, off: np.ndarray, gaps: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs outside ``gaps``), and for each document its first word's index (n+1 values)."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    white = gaps[raw]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = cut[:n].copy()
    before[1:] |= white[:-1]
    after = cut[1:].copy()
    after[:-1] |= white[1:]
    solid = ~white
    starts = np.flatnonzero(solid & before)
    ends = np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """64-bit hashes of the byte spans, which must not overlap and must ascend."""
    out = np.empty(len(starts), _U)
    a = 0
    while a < len(starts):
        b = max(int(np.searchsorted(ends, starts[a] + _CHUNK, "right")), a + 1)
        lo, hi = int(starts[a]), int(ends[b - 1])
        power, inverse = _powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, _U)
        np.cumsum(codes[raw[lo:hi]] * power[: hi - lo], out=total[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93))
        a = b
    return out


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one document, and each document's first run's index."""
    n = len(hashes)
    count = np.maximum(np.diff(first) - width + 1, 0)
    at = np.concatenate([[0], np.cumsum(count)])
    if n < width:
        return np.zeros(0, _U), at
    run = np.zeros(n - width + 1, _U)
    for k in range(width):
        run = (run ^ mix(hashes[k : n - width + 1 + k] + _U(k * 2 + 1))) * _U(_P)
    run = mix(run)
    good = np.ones(len(run), bool)
    for k in range(1, width):  # runs that would cross the end of a document
        edge = first[1:-1] - k
        good[edge[(edge >= 0) & (edge < len(run))]] = False
    return run[good], at


def shingle_sets(hashes: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per document the sorted distinct shingle hashes; fewer words than ``width`` make one shingle, none an empty set."""
    run, at = windows(hashes, first, width)
    for d in range(len(first) - 1):
        if at[d + 1] > at[d]:
            yield np.unique(run[at[d] : at[d + 1]])
        elif first[d + 1] > first[d]:
            own = hashes[first[d] : first[d + 1]]
            x = np.uint64(len(own) + 0x51ED)
            with np.errstate(over="ignore"):
                for h in own:
                    x = mix(np.array([(x ^ h) * _U(_P)]))[0]
            yield np.array([x], _U)
        else:
            yield np.zeros(0, _U)
