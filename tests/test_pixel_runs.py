"""Straight runs, components and edges against their plain definitions, which cost several times as much."""

import time

import numpy as np
import pytest

from docengine.plans.fixtures import form
from docengine.sources import pixels as P
from docengine.sources.providers import opened


def _opened(mask, length, axis):
    rows = mask if axis == 1 else mask.T
    out = np.zeros_like(rows, bool)
    for r, row in enumerate(rows):
        start = 0
        for x in range(len(row) + 1):
            if x == len(row) or not row[x]:
                out[r, start:x] = x - start >= length
                start = x + 1
    return out if axis == 1 else out.T


def _components(mask):
    out, last = np.zeros(mask.shape, np.int32), 0
    for y, x in np.argwhere(mask):
        if not out[y, x]:
            last, todo = last + 1, [(y, x)]
            while todo:
                a, b = todo.pop()
                if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not out[a, b]:
                    out[a, b] = last
                    todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return out


def _edges(gray, low=50, high=150):
    wide = np.pad(gray.astype(np.float64), 1, mode="edge")
    h, w = gray.shape
    own = lambda i, j: wide[1 + i : 1 + i + h, 1 + j : 1 + j + w]
    gx = sum(k * (own(i, 1) - own(i, -1)) for i, k in ((-1, 1), (0, 2), (1, 1)))
    gy = sum(k * (own(1, j) - own(-1, j)) for j, k in ((-1, 1), (0, 2), (1, 1)))
    size = np.abs(gx) + np.abs(gy)
    ring = np.pad(size, 1)
    at = lambda i, j: ring[1 + i : 1 + i + h, 1 + j : 1 + j + w]
    kinds = [np.abs(gy) <= 0.414 * np.abs(gx), np.abs(gy) >= 2.414 * np.abs(gx), gx * gy > 0]
    before = np.select(kinds, [at(0, -1), at(-1, 0), at(-1, -1)], at(-1, 1))
    after = np.select(kinds, [at(0, 1), at(1, 0), at(1, 1)], at(1, -1))
    ridge = (size > low) & (size > before) & (size >= after)
    label = _components(ridge)
    return ridge & np.isin(label, np.unique(label[ridge & (size > high)]))


@pytest.mark.parametrize("shape", [(1, 1), (1, 9), (9, 1), (40, 57), (33, 120)])
def test_kernels_equal_their_definitions(shape):
    draw = np.random.default_rng(7)
    for share in (0.0, 0.3, 0.6, 1.0):
        mask = draw.random(shape) < share
        for length in (1, 2, 3, 7, 40):
            assert all(np.array_equal(opened(mask, length, axis), _opened(mask, length, axis)) for axis in (0, 1))
        assert np.array_equal(P.components(mask), _components(mask))
        gray = P.blurred(np.where(mask, 40, draw.integers(150, 256, shape)).astype(np.uint8))
        assert np.array_equal(P.edges(gray), _edges(gray)) and np.array_equal(P.edges(gray, 20, 400), _edges(gray, 20, 400))


def test_a_page_costs_a_few_passes_over_its_pixels():
    page = form(3)
    took = {}
    for name, run in (("boxes", P.grid_boxes), ("passes", lambda p: [(p.astype(np.float64) + 1).sum() for _ in range(20)])):
        took[name] = []
        for _ in range(3):
            began = time.process_time()
            run(page)
            took[name].append(time.process_time() - began)
    assert min(took["boxes"]) < min(took["passes"])
