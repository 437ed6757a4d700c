"""File listings as DataFrames of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docengine.functions import labels as L
from docengine.functions import text as T


def pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """PDF files of a folder (not below it) with their safe stem as key."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    stem = F.regexp_replace(F.regexp_extract("path", "([^/]+)$", 1), r"\.pdf$", "")
    return rows.withColumn("file", T.safe_stem(stem))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below a folder with file, kind, page and name parts: <file>/<kind>/[<page>/[images/]]<name>."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    return parts(rows, folder)


def parts(paths: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Path segments below ``root``."""
    below = F.regexp_replace(F.col(path), "^.*?" + _quoted(root.rstrip("/").split(":")[-1]) + "/", "")
    s = F.split(below, "/")
    name = F.element_at(s, -1)
    return paths.withColumns({
        "file": F.get(s, F.lit(0)), "kind": F.get(s, F.lit(1)), "page": F.when(F.size(s) >= 4, F.get(s, F.lit(2))), "in_images": F.when(F.size(s) >= 5, F.get(s, F.lit(3)) == "images").otherwise(False),
        "name": name, "stem": F.regexp_replace(name, r"\.[^.]*$", ""), "ext": F.regexp_extract(name, r"\.([^.]*)$", 1),
    })


def _quoted(s: str) -> str:
    import re

    return re.escape(s)


def page_images(files: DataFrame) -> DataFrame:
    """Page images: known extensions in lower or upper case, not mixed, once each, by path."""
    known = F.col("ext").isin([e for x in L.PAGE_EXTENSIONS for e in (x, x.upper())])
    return files.where((F.col("kind") == "images") & known).distinct()


def crop_images(files: DataFrame) -> DataFrame:
    """Crop images: known extensions in any case (tif is not one of them)."""
    return files.where(F.lower("ext").isin(L.CROP_EXTENSIONS))


def scan_images(files: DataFrame) -> DataFrame:
    """Images of the metadata stage: known extensions in any case, ranked by lower-cased name, then name."""
    known = files.where((F.col("kind") == "images") & F.lower("ext").isin(L.PAGE_EXTENSIONS))
    return known.withColumn("pos", F.row_number().over(Window.partitionBy("file").orderBy(F.lower("name"), "name")))


def folders_with(files: DataFrame, kind: str) -> DataFrame:
    """Folders that have a sub-folder of a kind."""
    return files.where(F.col("kind") == kind).select("file").distinct()


def page_folders(files: DataFrame) -> DataFrame:
    """Sub-folders of crops/, each once."""
    return files.where(F.col("kind") == "crops").select("file", "page").distinct()


def resolved(crops: DataFrame, page: list[str]) -> DataFrame:
    """Images of <page>/images/ where that exists, else of <page>/."""
    has = F.max(F.col("in_images").cast("int")).over(Window.partitionBy(*page))
    return crops.withColumn("_has", has).where(F.col("in_images").cast("int") == F.col("_has")).drop("_has")


def embedded_name(page: Column, index: Column, ext: Column) -> Column:
    """page-%03d-img-%02d.<ext>; an unknown extension is bin."""
    return F.format_string("page-%03d-img-%02d.%s", page, index, F.when(F.coalesce(ext, F.lit("")) == "", "bin").otherwise(ext))


def rendered_name(page: Column) -> Column:
    return F.format_string("page-%03d.png", page)


def combined_text(pages: DataFrame) -> DataFrame:
    """input_pdf, text struct<combined, pages> from (input_pdf, page, text)."""
    page = F.struct("page", F.format_string("text/page-%03d.txt", "page").alias("path"), F.length("text").alias("chars"))
    in_order = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("input_pdf").agg(
        F.struct(F.array_join(F.transform(in_order, lambda p: p["text"]), "\n").alias("combined"), F.array_sort(F.collect_list(page)).alias("pages")).alias("text")
    )


def manifests(pages: DataFrame, images: DataFrame | None = None, about: DataFrame | None = None) -> DataFrame:
    """One manifest row per input: page count, the document's own metadata, optional images and rendered pages.

    ``about`` has (input_pdf, metadata map); documents without one have an empty map.
    """
    made = pages.groupBy("input_pdf").agg(F.count("*").cast("int").alias("pages"), F.array_sort(F.collect_list(rendered_name(F.col("page")))).alias("rendered_pages"))
    if about is not None:
        known = F.map_filter("metadata", lambda k, v: F.coalesce(v, F.lit("")) != "")
        made = made.join(about.select("input_pdf", known.alias("metadata")), "input_pdf", "left").withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))
        made = made.select("input_pdf", "pages", "metadata", "rendered_pages")
    if images is None:
        return made
    row = F.struct("page", "index", F.concat(F.lit("embedded_images/"), embedded_name(F.col("page"), F.col("index"), F.col("ext"))).alias("path"), "ext", "width", "height")
    listed = images.where("size > 0").groupBy("input_pdf").agg(F.array_sort(F.collect_list(row)).alias("images"))
    return made.join(listed, "input_pdf", "left")
