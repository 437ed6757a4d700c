"""Choosing folders and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docengine.functions import labels as L


def first_folders(rows: DataFrame, limit: int | None, zero_is_all: bool = True) -> DataFrame:
    """Rows of the first folders by name.  Zero means all, or (crop stage) nothing; None means all.

    The names are a top-k of distinct values, so no task ranks all rows.
    """
    if limit is None or (zero_is_all and limit <= 0):
        return rows
    names = rows.select("file").distinct().orderBy("file").limit(max(limit, 0))
    return rows.join(F.broadcast(names), "file", "left_semi")  # at most ``limit`` names


def first_pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of the first pages of every file; zero means all."""
    if limit <= 0:
        return rows
    pages = rows.select("file", "page").distinct()
    top = pages.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("page"))).where(F.col("_n") <= limit)
    return rows.join(top.select("file", "page"), ["file", "page"], "left_semi")


def only(rows: DataFrame, folder: str | None = None, page: str | None = None) -> DataFrame:
    """Equality filters, which come before the limits."""
    rows = rows if folder is None else rows.where(F.col("file") == folder)
    return rows if page is None else rows.where(F.col("page") == page)


def unfinished(rows: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """Rows of folders without an output yet."""
    return rows if force else rows.join(outputs.select("file"), "file", "left_anti")


def pick_pages(scores: DataFrame, folder: list[str], need: int = 2) -> DataFrame:
    """folder, n_images, front and back position of folders with ``need`` images or more.

    The back page is the last of the final LOOKBACK images with enough ink and table lines;
    else the one with most lines, then ink, then the later; else, if that one is blank or no
    image is readable, the second to last.  Only images within LOOKBACK of the end are ranked.
    """
    whole = Window.partitionBy(*folder)
    ranked = scores.withColumn("_n", F.count("*").over(whole)).withColumn("_back", F.row_number().over(whole.orderBy(F.desc("pos"))))
    near = (F.col("_back") <= L.LOOKBACK) & F.col("readable")
    strong = near & (F.col("ink_ratio") >= L.INK_MIN) & (F.col("table_line_ratio") >= L.TABLE_MIN)
    best = F.max(F.when(near, F.struct(F.col("table_line_ratio").alias("t"), F.col("ink_ratio").alias("k"), (-F.col("_back")).alias("b"), F.col("pos").alias("pos"))))
    agg = ranked.groupBy(*folder).agg(
        F.max("_n").alias("n_images"), F.min("pos").alias("front"), F.max(F.when(strong, F.col("pos"))).alias("strong"), best.alias("best"),
        F.max(F.when(F.col("_back") == 2, F.col("pos"))).alias("second"),
    )
    back = F.when(F.col("n_images") == 1, F.col("front")).otherwise(
        F.coalesce(F.col("strong"), F.when(F.col("best.k") < L.INK_MIN, F.col("second")).otherwise(F.col("best.pos")), F.col("second"))
    )
    return agg.where(F.col("n_images") >= need).select(*folder, "n_images", "front", back.alias("back"))
