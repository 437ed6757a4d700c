"""Which crops of a page hold records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.functions import labels as L


def is_record(metrics: DataFrame | None = None) -> Column:
    """The threshold test over ink_frac, line_ratio, small_components, largest_cc_ratio, edge_frac."""
    return (
        F.col("ink_frac").between(*L.INK_FRAC) & (F.col("line_ratio") <= L.MAX_LINE_RATIO) & (F.col("small_components") >= L.MIN_SMALL_COMPONENTS)
        & (F.col("largest_cc_ratio") <= L.MAX_LARGEST_CC) & (F.col("edge_frac") >= L.MIN_EDGE_FRAC)
    )


def select_crops(metrics: DataFrame, page: list[str], mode: str = "auto") -> DataFrame:
    """Crops that go on: all (off), those that pass (on), or, of pages where none passes, all unless the page clearly has no records (auto)."""
    if mode == "off":
        return metrics
    passed = metrics.withColumn("_ok", is_record())
    if mode == "on":
        return passed.where("_ok").drop("_ok")
    whole = Window.partitionBy(*page)
    mean = lambda c: F.avg(F.col(c).cast("double")).over(whole)
    clear = (
        (mean("small_components") <= L.SKIP_SMALL_COMPONENTS) | (mean("line_ratio") >= L.SKIP_LINE_RATIO)
        | (mean("largest_cc_ratio") >= L.SKIP_LARGEST_CC) | (mean("edge_frac") <= L.SKIP_EDGE_FRAC)
    )
    judged = passed.withColumn("_any", F.max(F.col("_ok").cast("int")).over(whole)).withColumn("_clear", clear)
    return judged.where("_ok or (_any = 0 and not _clear)").drop("_ok", "_any", "_clear")


def post_filter(crops: DataFrame, mode: str = "auto") -> DataFrame:
    """After preprocessing, smooth crops go."""
    return crops if mode == "off" else crops.where(F.col("post_edge_frac") >= L.POST_MIN_EDGE_FRAC)


def crop_names(crops: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Names for (file, page_id, page_base, path_pos, i) in the order of their pages, last writer wins.

    A crop has the plain name unless a file of that name is there already and its page_base has an
    extra part, which it then carries.  Files are there from earlier runs (``existing``: file,
    page_id, crop_name) or from crops before it, the first of which always leaves the plain name
    behind: so the order within a (page, i) and one look at the snapshot decide, and a
    second run over its own output renames the first crops that have an extra part.
    """
    group = Window.partitionBy("file", "page_id", "i").orderBy("path_pos")
    extra = F.regexp_replace(F.expr("substring(page_base, length(page_id) + 1)"), "^[-_]+", "")
    number = F.lpad(F.col("i").cast("string"), 3, "0")
    number = F.when(F.col("i") > 999, F.col("i").cast("string")).otherwise(number)
    plain = F.concat(F.concat_ws("-", F.col("page_id"), number), F.lit(".png"))
    there = F.row_number().over(group) > 1
    rows = crops.withColumn("_plain", plain)
    if existing is not None:
        old = existing.select("file", "page_id", F.col("crop_name").alias("_plain")).distinct().withColumn("_old", F.lit(True))
        rows = rows.join(old, ["file", "page_id", "_plain"], "left")
        there = there | F.coalesce("_old", F.lit(False))
    name = F.when(there & (F.col("page_base") != F.col("page_id")) & (extra != ""), F.concat(F.concat_ws("-", F.col("page_id"), extra, number), F.lit(".png"))).otherwise(F.col("_plain"))
    named = rows.withColumn("crop_name", name).drop("_plain", "_old")
    last = Window.partitionBy("file", "page_id", "crop_name").orderBy(F.desc("path_pos"))
    return named.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def written_names(files: DataFrame) -> DataFrame:
    """(file, page_id, crop_name) of the crops in a listing: the snapshot that ``crop_names`` looks at."""
    return files.where((F.col("kind") == "crops") & F.col("page").isNotNull()).select("file", F.col("page").alias("page_id"), F.col("name").alias("crop_name")).distinct()
