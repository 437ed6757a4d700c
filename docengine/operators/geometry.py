"""Boxes of detected cells: filters, duplicates, nesting, reading order, scaling."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.functions import labels as L


def plausible(width: int = L.CANVAS[0], height: int = L.CANVAS[1]) -> Column:
    """Area, aspect and corner filter over x, y, w, h, n_vertices."""
    area, page = F.col("w") * F.col("h"), width * height
    aspect = F.try_divide(F.col("w").cast("double"), F.col("h").cast("double"))
    return area.between(F.lit(page * L.BOX_AREA[0]), F.lit(page * L.BOX_AREA[1])) & aspect.between(*L.BOX_ASPECT) & (F.col("n_vertices") >= 4)


#: Boxes of a page up to which all of them are compared with each other, natively; beyond it they meet through cells.
CROWDED = 300
_BOX = "array<struct<x:int,y:int,w:int,h:int>>"
_STEPS = list(itertools.product((-1, 0, 1), repeat=4))


def _arrays(boxes: pd.Series) -> Iterator[list[tuple[int, int, int, int]] | None]:
    for own in boxes:
        yield None if own is None else [(int(b["x"]), int(b["y"]), int(b["w"]), int(b["h"])) for b in own]


def _kept_in_cells(tolerance: int):
    """Which of a crowded page's sorted boxes the greedy fold keeps; a box looks at its own and the neighbouring cells of size ``tolerance``."""

    def flags(boxes: list[tuple[int, int, int, int]]) -> list[bool]:
        cells: dict[tuple, list] = {}
        out = []
        for box in boxes:
            at = tuple(v // max(tolerance, 1) for v in box)
            near = (k for step in _STEPS for k in cells.get((at[0] + step[0], at[1] + step[1], at[2] + step[2], at[3] + step[3]), ()))
            out.append(not any(all(abs(x - y) < tolerance for x, y in zip(box, k, strict=True)) for k in near))
            if out[-1]:
                cells.setdefault(at, []).append(box)
        return out

    return F.pandas_udf(lambda boxes: pd.Series([None if b is None else flags(b) for b in _arrays(boxes)]), "array<boolean>")


def _free_in_cells(margin: int, ratio: float):
    """Which of a crowded page's boxes lie in no larger one.

    A box stands in the cells, at most four, that it touches in the grid of its own size; a box asks in each
    grid at least as wide as itself for the cell of its corner, where any box around it must stand.
    """

    def level(box: tuple[int, int, int, int]) -> int:
        return max(box[2], box[3], 1).bit_length()

    def inside(a: tuple, b: tuple) -> bool:
        around = a[0] >= b[0] + margin and a[1] >= b[1] + margin and a[0] + a[2] <= b[0] + b[2] - margin and a[1] + a[3] <= b[1] + b[3] - margin
        return around and a[2] * a[3] / max(1, b[2] * b[3]) <= ratio

    def flags(boxes: list[tuple[int, int, int, int]]) -> list[bool]:
        cells: dict[tuple, list] = {}
        for b in boxes:
            k = level(b)
            for cx in range(b[0] >> k, (b[0] + b[2] >> k) + 1):
                for cy in range(b[1] >> k, (b[1] + b[3] >> k) + 1):
                    cells.setdefault((k, cx, cy), []).append(b)
        levels = sorted({k for k, _, _ in cells})
        return [not any(inside(a, b) for k in levels if k >= level(a) for b in cells.get((k, a[0] >> k, a[1] >> k), ())) for a in boxes]

    return F.pandas_udf(lambda boxes: pd.Series([None if b is None else flags(b) for b in _arrays(boxes)]), "array<boolean>")


def _by_flags(boxes: Column, flags: Column) -> Column:
    return F.filter(boxes, lambda b, i: F.get(flags, i))


def dedupe(boxes: DataFrame, page: list[str], tolerance: int = L.DEDUPE_TOLERANCE) -> DataFrame:
    """Boxes in (x, y, w, h) order without those close to one kept before.

    Greedy by definition: a dropped box does not drop others, so the page's sorted boxes are
    folded.  A page has some dozens; the boxes of a crowded one are folded over a grid of cells, in
    time that grows with their number and not its square.
    """

    def close(a: Column, b: Column) -> Column:
        test = F.lit(True)
        for c in ("x", "y", "w", "h"):
            test = test & (F.abs(a[c] - b[c]) < tolerance)
        return test

    packed = boxes.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("x", "y", "w", "h"))).cast(_BOX).alias("all"))
    packed = packed.withColumn("flags", _kept_in_cells(tolerance)(F.when(F.size("all") > CROWDED, F.col("all"))))
    fold = F.aggregate("all", F.array().cast(_BOX), lambda acc, b: F.when(F.exists(acc, lambda k: close(k, b)), acc).otherwise(F.concat(acc, F.array(b))))
    kept = F.when(F.col("flags").isNull(), fold).otherwise(_by_flags(F.col("all"), F.col("flags")))
    return packed.select(*page, F.inline(kept))


def remove_contained(boxes: DataFrame, page: list[str], margin: int = L.CONTAIN_MARGIN, ratio: float = L.CONTAIN_AREA_RATIO) -> DataFrame:
    """Boxes that lie in no larger box of their page.

    Containment is transitive, so each box is looked at alone.  The boxes of a page meet in one
    row, which needs no other shuffle than that of ``dedupe``; those of a crowded one meet through cells.
    """

    def inside(a: Column, b: Column) -> Column:
        around = (a["x"] >= b["x"] + margin) & (a["y"] >= b["y"] + margin) & (a["x"] + a["w"] <= b["x"] + b["w"] - margin) & (a["y"] + a["h"] <= b["y"] + b["h"] - margin)
        return around & (a["w"] * a["h"] / F.greatest(F.lit(1), b["w"] * b["h"]).cast("double") <= ratio)

    rest = [c for c in boxes.columns if c not in page]
    packed = boxes.groupBy(*page).agg(F.collect_list(F.struct(*rest)).alias("all"))
    sides = F.transform("all", lambda b: F.struct(*[b[c].cast("int").alias(c) for c in "xywh"]))
    packed = packed.withColumn("flags", _free_in_cells(margin, ratio)(F.when(F.size("all") > CROWDED, sides)))
    alone = F.filter("all", lambda a: ~F.exists("all", lambda b: F.coalesce(inside(a, b), F.lit(False))))
    free = F.when(F.col("flags").isNull(), alone).otherwise(_by_flags(F.col("all"), F.col("flags")))
    return packed.select(*page, F.inline(free)).select(*boxes.columns)


def reading_order(boxes: DataFrame, page: list[str]) -> DataFrame:
    """Boxes with row_id and their position ``ord`` from the top left, row by row.

    A row ends where y jumps by more than 0.55 of the upper median height (10 at least).
    """
    by_y = Window.partitionBy(*page).orderBy("y", "x")
    whole = Window.partitionBy(*page)
    heights = F.array_sort(F.collect_list("h").over(whole))
    median = F.get(heights, F.floor(F.size(heights) / 2).cast("int"))
    jump = (F.abs(F.col("y") - F.lag("y").over(by_y)) > F.col("limit")).cast("int")
    rows = boxes.withColumn("limit", F.greatest(F.lit(10), F.floor(median * F.lit(0.55)).cast("int"))).withColumn("row_id", F.sum(F.coalesce(jump, F.lit(0))).over(by_y.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.withColumn("ord", F.row_number().over(whole.orderBy("row_id", "x", "y", "w", "h"))).drop("limit")


def scaled(value: Column, factor: Column) -> Column:
    """Half-even rounding."""
    return F.bround(value.cast("double") * factor).cast("int")


def padded(width: Column, height: Column, pad: int = L.PAD) -> dict[str, Column]:
    """Corners of padded boxes, clamped to the page."""
    return {
        "x1": F.greatest(F.lit(0), F.col("x") - pad), "y1": F.greatest(F.lit(0), F.col("y") - pad),
        "x2": F.least(width, F.col("x") + F.col("w") + pad), "y2": F.least(height, F.col("y") + F.col("h") + pad),
    }


def numbered(boxes: DataFrame, page: list[str], width: Column, height: Column) -> DataFrame:
    """Padded boxes with the number i that they have before empty ones go, so numbers have gaps."""
    return boxes.withColumn("i", F.row_number().over(Window.partitionBy(*page).orderBy("ord"))).withColumns(padded(width, height)).where("x2 > x1 and y2 > y1")


def region(roi: tuple[float, float, float, float], width: Column, height: Column) -> dict[str, Column]:
    """Pixel corners of a relative region: half-even, starts below and ends above the image's edge."""
    x1, y1, x2, y2 = roi
    at = lambda r, n: F.bround(F.lit(r) * n.cast("double")).cast("int")
    return {
        "X1": F.greatest(F.lit(0), F.least(width - 1, at(x1, width))), "X2": F.greatest(F.lit(1), F.least(width, at(x2, width))),
        "Y1": F.greatest(F.lit(0), F.least(height - 1, at(y1, height))), "Y2": F.greatest(F.lit(1), F.least(height, at(y2, height))),
    }
