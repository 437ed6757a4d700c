"""Pixel kernels in NumPy: binarising, lines, components, edges, deskewing, crop metrics.

They stand in for an imaging library, with the same parameters; results are close to, not
bit for bit, what such a library gives.  Rows are images, so they run in ``mapInPandas``
with small batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from docengine.functions import labels as L
from docengine.sources.providers import opened


def to_gray(pixels: np.ndarray) -> np.ndarray:
    """Gray levels of BGR pixels."""
    if pixels.ndim == 2 or pixels.shape[2] == 1:
        return pixels.reshape(pixels.shape[:2]).astype(np.uint8)
    return np.rint(pixels[:, :, :3].astype(np.float64) @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


#: Rows of an image that are summed at once.
_BAND = 128


def _of_sixteenths(total: np.ndarray) -> np.ndarray:
    """Sums of weights of a sixteenth as means, rounded half to even."""
    return (total + 7 + (total >> 4 & 1) >> 4).astype(np.uint8)


def blurred(gray: np.ndarray) -> np.ndarray:
    """Means with weights 1, 2, 1 along both axes, with mirrored borders."""
    out = gray.astype(np.int16)
    for axis in (0, 1):
        wide = np.pad(out, [(1, 1) if a == axis else (0, 0) for a in (0, 1)], mode="reflect" if out.shape[axis] > 1 else "edge")
        out = wide[:-2] + 2 * wide[1:-1] + wide[2:] if axis == 0 else wide[:, :-2] + 2 * wide[:, 1:-1] + wide[:, 2:]
    return _of_sixteenths(out)


def adaptive_ink(gray: np.ndarray, block: int = 31, drop: float = 12) -> np.ndarray:
    """Pixels darker than the mean of their block by ``drop`` or more."""
    r, (h, w) = block // 2, gray.shape
    wide = np.pad(gray, r, mode="edge")
    out = np.empty(gray.shape, bool)
    # Sums of whole numbers, first along the rows and then down the columns; compared without a division.
    # A band of rows at a time stays in the processor's cache; its sums fit 32 bits.
    for y in range(0, h, _BAND):
        part = wide[y : y + _BAND + 2 * r]
        run = np.zeros((len(part), wide.shape[1] + 1), np.int32)
        np.cumsum(part, axis=1, dtype=np.int32, out=run[:, 1:])
        total = np.zeros((len(part) + 1, w), np.int32)
        np.cumsum(run[:, block : block + w] - run[:, :w], axis=0, dtype=np.int32, out=total[1:])
        np.less_equal(gray[y : y + _BAND] * np.int32(block**2), total[block:] - total[:-block] - drop * block**2, out=out[y : y + _BAND])
    return out


def grown(mask: np.ndarray, r: int = 1) -> np.ndarray:
    for axis in (0, 1):
        out = mask.copy()
        to, of = (out, mask) if axis == 0 else (out.T, mask.T)
        for k in range(1, r + 1):
            to[k:] |= of[:-k]
            to[:-k] |= of[k:]
        mask = out
    return mask


def closed(mask: np.ndarray, times: int = 1) -> np.ndarray:
    return ~grown(~grown(mask, times), times)


def line_mask(ink: np.ndarray, share: int = 6, least: int = 40) -> np.ndarray:
    """Long straight strokes in either direction."""
    h, w = ink.shape
    return closed(opened(ink, max(least, w // share), 1) | opened(ink, max(least, h // share), 0))


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the runs of a mask, row by row."""
    wide = np.pad(mask, ((0, 0), (1, 1)))
    width = wide.shape[1]
    flat = wide.ravel()
    starts, ends = (np.flatnonzero(flat[1:] != flat[:-1]) + 1).reshape(-1, 2).T
    return starts // width, starts % width - 1, ends % width - 1


def _joined(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 8-connected component of each run, numbered from 1 by first run."""
    if not len(rows):
        return np.zeros(0, np.int64)
    width = int(ends.max()) + 1
    # The runs of the row above that touch a run stand one after the other.
    low = np.searchsorted(rows * width + ends, (rows - 1) * width + starts, "left")
    high = np.searchsorted(rows * width + starts, (rows - 1) * width + ends, "right")
    many = np.maximum(high - low, 0)
    below = np.repeat(np.arange(len(rows)), many)
    above = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    first = np.arange(len(rows))
    while True:
        a, b = first[above], first[below]
        apart = a != b
        if not apart.any():
            break
        above, below = above[apart], below[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(first, np.maximum(a, b), np.minimum(a, b))
        while (first[first] != first).any():
            first = first[first]
    return np.cumsum(first == np.arange(len(rows)))[first]


def components(mask: np.ndarray) -> np.ndarray:
    """8-connected labels from 1, by joining the runs of adjacent rows."""
    rows, starts, ends = _runs(mask)
    out = np.zeros(mask.shape, np.int32)
    out[mask] = np.repeat(_joined(rows, starts, ends), ends - starts)
    return out


#: By the size of a gradient along one axis, up to which and from which size the other makes it flat and steep.
_FLAT, _STEEP = np.floor(0.414 * np.arange(1021)).astype(np.int16), np.ceil(2.414 * np.arange(1021)).astype(np.int16)


def edges(gray: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Thin gradient ridges above ``low`` that hang together with one above ``high``."""
    wide = np.pad(gray.astype(np.int16), 1, mode="edge")
    dx = (wide[:, 2:] - wide[:, :-2])
    dy = (wide[2:, :] - wide[:-2, :])
    gx = dx[:-2] + 2 * dx[1:-1] + dx[2:]
    gy = dy[:, :-2] + 2 * dy[:, 1:-1] + dy[:, 2:]
    size = np.abs(gx) + np.abs(gy)
    ridge = np.zeros(gray.shape, bool)
    # Most pixels have no gradient, so the rest is looked at for those that have one.
    at = np.flatnonzero(size > low)
    if not len(at):
        return ridge
    gx, gy, own = gx.ravel()[at], gy.ravel()[at], size.ravel()[at]
    ring = np.pad(size, 1)
    width = ring.shape[1]
    place = at // gray.shape[1] * width + at % gray.shape[1] + width + 1
    flat, steep = np.abs(gy) <= _FLAT[np.abs(gx)], np.abs(gy) >= _STEEP[np.abs(gx)]
    step = np.where(flat, 1, np.where(steep, width, np.where((gx > 0) == (gy > 0), width + 1, width - 1)))
    around = ring.ravel()
    kept = (own > around[place - step]) & (own >= around[place + step])
    at, own = at[kept], own[kept]
    ridge.ravel()[at] = True
    if (own <= high).any():
        rows, starts, ends = _runs(ridge)
        label = np.repeat(_joined(rows, starts, ends), ends - starts)
        ridge.ravel()[at] = np.bincount(label, own > high)[label] > 0
    return ridge


def share_of(mask: np.ndarray) -> float:
    return np.count_nonzero(mask) / mask.size


def crop_metrics(pixels: np.ndarray) -> dict[str, float | int]:
    """What tells record crops from diagrams and photos."""
    gray = blurred(to_gray(pixels))
    ink = adaptive_ink(gray)
    lines = line_mask(ink)
    rest = ink & ~lines
    square = rest[:-1, :-1] & rest[1:, :-1] & rest[:-1, 1:] & rest[1:, 1:]
    text = np.zeros_like(rest)
    for i in (0, 1):
        for j in (0, 1):
            text[i : i + square.shape[0], j : j + square.shape[1]] |= square
    rows, starts, ends = _runs(text)
    areas = np.bincount(_joined(rows, starts, ends), ends - starts)[1:].astype(np.int64)
    most = max(80, int(text.size * 0.002))
    count = np.count_nonzero
    return {
        "ink_frac": share_of(ink), "line_ratio": float(count(lines) / max(1, count(ink))), "small_components": int(((areas >= 10) & (areas <= most)).sum()),
        "largest_cc_ratio": float(areas.max(initial=0) / max(1, count(text))), "edge_frac": share_of(edges(gray)),
    }


def grid_boxes(gray: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """x, y, w, h, corners of the connected line structures of a page on the canonical canvas."""
    ink = adaptive_ink(gray)
    h, w = ink.shape
    grid = closed(opened(ink, max(10, w // 25), 1) | opened(ink, max(10, h // 25), 0), 2)
    rows, starts, ends = _runs(grid)
    label = _joined(rows, starts, ends)
    order = np.argsort(label, kind="stable")
    label = label[order]
    out = []
    for own in np.split(order, np.flatnonzero(np.diff(label)) + 1) if len(order) else []:
        x, y = starts[own].min(), rows[own].min()
        out.append((int(x), int(y), int(ends[own].max() - x), int(rows[own].max() - y + 1), 4))
    return out


def skew(gray: np.ndarray, limit: float = 30, step: float = 0.5) -> float:
    """The angle within ``limit`` whose projection of the edges is sharpest; 0 without edges."""
    y, x = np.nonzero(edges(gray))
    if not len(x):
        return 0.0
    angles = np.arange(-limit, limit + step, step)
    y, x, reach = y.astype(np.float64), x.astype(np.float64), sum(gray.shape)
    sharp = []
    for a in np.radians(angles):
        rows = y * np.cos(a)
        rows -= x * np.sin(a)
        places = np.rint(rows, out=rows).astype(np.int64)
        places += reach
        many = np.bincount(places)
        sharp.append(int(many @ many))
    best = np.flatnonzero(np.array(sharp) == max(sharp))
    return float(np.median(angles[best]))


def rotated(gray: np.ndarray, angle: float) -> np.ndarray:
    """Turned by ``angle`` about the centre with repeated borders; angles under 0.2 leave it."""
    if abs(angle) < 0.2:
        return gray
    h, w = gray.shape
    a = np.radians(angle)
    y, x = np.mgrid[:h, :w]
    u, v = x - w / 2, y - h / 2
    return _sampled(gray, u * np.cos(a) - v * np.sin(a) + w / 2, u * np.sin(a) + v * np.cos(a) + h / 2)


def _sampled(gray: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h, w = gray.shape
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    i, j = np.minimum(y.astype(int), h - 2 if h > 1 else 0), np.minimum(x.astype(int), w - 2 if w > 1 else 0)
    fy, fx = y - i, x - j
    i2, j2 = np.minimum(i + 1, h - 1), np.minimum(j + 1, w - 1)
    g = gray.astype(np.float64)
    top, low = g[i, j] * (1 - fx) + g[i, j2] * fx, g[i2, j] * (1 - fx) + g[i2, j2] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def enlarged(gray: np.ndarray, factor: float) -> np.ndarray:
    h, w = int(gray.shape[0] * factor), int(gray.shape[1] * factor)
    # As _sampled, but a place along one axis is the same all along the other.
    places = []
    for count, most in ((h, gray.shape[0]), (w, gray.shape[1])):
        at = np.clip((np.arange(count) + 0.5) / factor - 0.5, 0, most - 1)
        low = np.minimum(at.astype(int), most - 2 if most > 1 else 0)
        places.append((low, np.minimum(low + 1, most - 1), at - low))
    (i, i2, fy), (j, j2, fx) = places
    fy = fy[:, None]
    if all((f * 4 % 1 == 0).all() for f in (fy, fx)):  # as when doubled: whole numbers do
        gray, fy, fx = gray.astype(np.int16), (fy * 4).astype(np.int16), (fx * 4).astype(np.int16)
        across = gray[:, j] * (4 - fx) + gray[:, j2] * fx
        return _of_sixteenths(across[i] * (4 - fy) + across[i2] * fy)
    across = gray[:, j] * (1 - fx) + gray[:, j2] * fx
    return np.rint(across[i] * (1 - fy) + across[i2] * fy).astype(np.uint8)


def denoised(gray: np.ndarray) -> np.ndarray:
    wide = np.pad(gray, 1, mode="edge")
    h, w = gray.shape
    p = [wide[i : i + h, j : j + w] for i in range(3) for j in range(3)]
    # The exchanges that bring the median of nine to the middle.
    for a, b in ((1, 2), (4, 5), (7, 8), (0, 1), (3, 4), (6, 7), (1, 2), (4, 5), (7, 8), (0, 3), (5, 8), (4, 7), (3, 6), (1, 4), (2, 5), (4, 7), (4, 2), (6, 4), (4, 2)):
        p[a], p[b] = np.minimum(p[a], p[b]), np.maximum(p[a], p[b])
    return p[4]


def stretched(gray: np.ndarray) -> np.ndarray:
    low, high = int(gray.min()), int(gray.max())
    if high == low or (low, high) == (0, 255):
        return gray
    return np.rint(np.clip((np.arange(256.0) - low) * 255 / (high - low), 0, 255)).astype(np.uint8)[gray]


def preprocess(pixels: np.ndarray) -> np.ndarray:
    """Gray, deskewed, twice as large, denoised, full contrast."""
    gray = to_gray(pixels)
    return stretched(denoised(enlarged(rotated(gray, skew(gray)), 2)))


def for_code(pixels: np.ndarray) -> np.ndarray:
    """Twice as large and denoised: code and house regions."""
    return denoised(enlarged(to_gray(pixels), 2))


def for_serial(pixels: np.ndarray) -> np.ndarray:
    """Three times as large, blurred, binarised, light on dark turned over."""
    white = np.where(adaptive_ink(blurred(enlarged(to_gray(pixels), 3)), 31, 8), 0, 255).astype(np.uint8)
    return 255 - white if white.mean() > 180 else white


def region(pixels: np.ndarray, roi: tuple[float, float, float, float]) -> np.ndarray:
    h, w = pixels.shape[:2]
    x1, y1, x2, y2 = (int(round(r * n)) for r, n in zip(roi, (w, h, w, h)))
    return pixels[max(0, min(h - 1, y1)) : max(1, min(h, y2)), max(0, min(w - 1, x1)) : max(1, min(w, x2))]


def without_label(pixels: np.ndarray, share: float) -> np.ndarray:
    """A region without its left label column."""
    w = pixels.shape[1]
    return pixels if share <= 0 else pixels[:, max(0, min(w - 1, int(w * share))) :]


def outlined(pixels: np.ndarray, rois=((L.EPIC_ROI, (0, 255, 0)), (L.SERIAL_ROIS[0], (255, 0, 0)), (L.HOUSE_ROI, (0, 0, 255)))) -> np.ndarray:
    """A copy with the regions' borders drawn, for checking coordinates."""
    out = pixels.copy()
    h, w = out.shape[:2]
    for (x1, y1, x2, y2), colour in rois:
        a, b, c, d = int(x1 * w), int(y1 * h), int(x2 * w), int(y2 * h)
        for t in (0, 1):
            out[min(b + t, h - 1), a : c + 1] = out[max(min(d - t, h - 1), 0), a : c + 1] = colour
            out[b : d + 1, min(a + t, w - 1)] = out[b : d + 1, max(min(c - t, w - 1), 0)] = colour
    return out


def measured(crops: DataFrame) -> DataFrame:
    """crop_metrics of rows with Spark's ``image`` struct, and the edge share after preprocessing."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in crops.schema if f.name != "image"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                i = row.pop("image")
                pixels = np.frombuffer(i["data"], np.uint8).reshape(i["height"], i["width"], i["nChannels"])
                out.append(row | crop_metrics(pixels) | {"post_edge_frac": share_of(edges(preprocess(pixels)))})
            yield pd.DataFrame(out)

    more = "ink_frac double, line_ratio double, small_components int, largest_cc_ratio double, edge_frac double, post_edge_frac double"
    return crops.mapInPandas(run, ", ".join([*kept, more]))
