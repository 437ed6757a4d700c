"""PNG files from and to pixel arrays, without an imaging library (8 bits a channel, not interlaced)."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}  # by the format's colour type


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(pixels: np.ndarray) -> bytes:
    """A gray (h, w) or BGR (h, w, 3) array as a PNG file."""
    rows = pixels if pixels.ndim == 2 else pixels[:, :, 0] if pixels.shape[2] == 1 else pixels[:, :, 2::-1]
    h, w = rows.shape[:2]
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if rows.ndim == 2 else 2, 0, 0, 0)
    flat = np.ascontiguousarray(rows).reshape(h, -1)
    lines = np.concatenate([np.zeros((h, 1), np.uint8), flat], axis=1).tobytes()
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines, 6)) + _chunk(b"IEND", b"")


def from_png(data: bytes) -> np.ndarray:
    """Gray (h, w) or BGR (h, w, 3) pixels of a PNG file; transparency is dropped."""
    if data[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, packed, head = 8, b"", None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        at += n + 12
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed += body
    if head is None or head[2] != 8 or head[3] not in _CHANNELS or head[6]:
        raise ValueError("a kind of PNG that is not read here")
    w, h, many = head[0], head[1], _CHANNELS[head[3]]
    lines = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(h, w * many + 1)
    if not lines[:, 0].any():  # no row is filtered
        rows = lines[:, 1:].reshape(h, w, many)
        return np.ascontiguousarray(rows[:, :, 0] if many < 3 else rows[:, :, 2::-1])
    out = np.zeros((h + 1, w * many), np.int64)  # a row of zeros stands above the first
    for y, line in enumerate(lines):
        out[y + 1] = _unfiltered(int(line[0]), line[1:].astype(np.int64), out[y], many)
    rows = out[1:].astype(np.uint8).reshape(h, w, many)
    return rows[:, :, 0] if many < 3 else rows[:, :, 2::-1]


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A row of bytes from its differences, by the format's filter types."""
    if kind == 0:
        return line
    if kind == 2:
        return (line + above) & 255
    out = line.copy()
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0).reshape(-1) & 255
    for x in range(len(out)):
        left = out[x - step] if x >= step else 0
        if kind == 3:
            guess = (left + above[x]) // 2
        else:
            corner = above[x - step] if x >= step else 0
            base = left + above[x] - corner
            guess = min((left, above[x], corner), key=lambda v: abs(base - v))
        out[x] = (out[x] + guess) & 255
    return out
