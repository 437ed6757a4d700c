"""The pixel kernels against their plain definitions, which cost several times as much."""

import time

import numpy as np

from docengine.plans.fixtures import form
from docengine.sources import images, pixels as P


def _median(gray):
    wide = np.pad(gray, 1, mode="edge")
    h, w = gray.shape
    return np.median([wide[i : i + h, j : j + w] for i in range(3) for j in range(3)], axis=0).astype(np.uint8)


def _enlarged(gray, factor):
    y, x = np.mgrid[: gray.shape[0] * factor, : gray.shape[1] * factor]
    return P._sampled(gray, (x + 0.5) / factor - 0.5, (y + 0.5) / factor - 0.5)


def _seconds(run, *args):
    took = []
    for _ in range(3):
        began = time.perf_counter()
        run(*args)
        took.append(time.perf_counter() - began)
    return min(took)


def test_kernels_are_their_definitions_but_faster():
    draw = np.random.default_rng(3)
    for shape in ((1, 1), (1, 7), (7, 1), (40, 57)):
        gray = draw.integers(0, 256, shape).astype(np.uint8)
        wide = np.pad(gray.astype(float), 2, mode="edge")
        mean = np.array([[wide[y : y + 5, x : x + 5].sum() / 25 for x in range(shape[1])] for y in range(shape[0])])
        assert np.array_equal(P.denoised(gray), _median(gray)) and np.array_equal(P.enlarged(gray, 2), _enlarged(gray, 2))
        assert np.array_equal(P.adaptive_ink(gray, 5, 12), gray <= mean - 12)
        assert np.array_equal(images.from_png(images.to_png(gray)), gray)
    crop = form(1)[40:400, 20:600]
    assert 2 * _seconds(P.denoised, crop) < _seconds(_median, crop)
    assert 2 * _seconds(P.enlarged, crop, 2) < _seconds(_enlarged, crop, 2)
