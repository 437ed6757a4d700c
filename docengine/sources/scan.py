"""Names first, bytes second: a run opens only the files that it has chosen.

A listing reads no file: Spark's ``binaryFile`` source opens a file only for its ``content``.
Choices (kind, extension, folder, page, limits, resume) are made on the names, and the chosen
paths are then loaded in waves, so neither the driver nor a plan ever holds more than a wave
of them.  Where a choice is a plain condition on the path, ``pruned`` gives it to the scan
itself, which drops the other files when it plans its splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.operators import pages as P
from docengine.session import settled
from docengine.sources import files as S
from docengine.sources.config import Settings

#: Paths that the driver holds at once.
WAVE = 10_000


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Names below a folder, with their parts; no file is opened."""
    return S.images(spark, folder)


def choose(files: DataFrame, settings: Settings, done: DataFrame | None = None) -> DataFrame:
    """Rows of a listing (file, page, name, ..) that a run reads: equality filters, then limits, then what is done goes.

    The order is the compatible one: ``only_folder`` and ``only_page`` come before the limits, and
    a page that is done still counts for its file's limit.  ``done`` has (file, page).  Files
    without a page folder have page null; they belong to no page that can be done.
    """
    kept = P.first_pages(P.first_folders(P.only(files, settings.only_folder, settings.only_page), settings.limit), settings.limit_pages)
    return kept if done is None or settings.force else kept.join(done.select("file", "page").distinct(), ["file", "page"], "left_anti")


def contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, modificationTime, length and content of exactly these files."""
    if not paths:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return spark.read.format("binaryFile").load([re.sub(r"([*?{}\[\]\\])", r"\\\1", p) for p in paths])  # a name is no pattern


def waves(spark: SparkSession, chosen: DataFrame, most: int = WAVE, keep_together: list[str] | None = None) -> Iterator[DataFrame]:
    """``chosen`` (path, ..) with ``content``, at most ``most`` files at a time, in the order of their keys.

    Rows that share the ``keep_together`` columns come in one wave, which may then be larger by
    one group.  The choice is settled first, so a wave's files are those that were listed.
    """
    order = [*(keep_together or []), "path"]
    rows = settled(chosen)
    after: list | None = None
    while True:
        rest = rows if after is None else rows.where(_beyond(order[: len(after)], after))
        ahead = rest.orderBy(*order).limit(most).select(*order).collect()
        if not ahead:
            return
        last = [ahead[-1][c] for c in order]
        if keep_together and len(ahead) == most:
            after = last[: len(keep_together)]
            group = rest.where(_same(keep_together, after)).select("path").collect()
            paths = [r["path"] for r in ahead if [r[c] for c in keep_together] != after] + [r["path"] for r in group]
        else:
            after, paths = last, [r["path"] for r in ahead]
        here = spark.createDataFrame([(p,) for p in paths], "path string")
        yield rows.join(F.broadcast(here), "path", "left_semi").join(contents(spark, paths).select("path", "content"), "path")


def _same(columns: list[str], values: list) -> Column:
    out = F.lit(True)
    for c, v in zip(columns, values, strict=True):
        out &= F.col(c).eqNullSafe(F.lit(v))
    return out


def _beyond(columns: list[str], values: list) -> Column:
    """Rows after the key ``values``, null first."""
    out = F.lit(False)
    for i, (c, v) in enumerate(zip(columns, values, strict=True)):
        later = F.col(c).isNotNull() if v is None else F.col(c) > F.lit(v)
        out |= _same(columns[:i], values[:i]) & F.coalesce(later, F.lit(False))
    return out


def pruned(spark: SparkSession, folder: str, condition: Column) -> DataFrame:
    """Files with content, of which the scan opens those whose path meets ``condition``.

    The condition is over the columns of ``files.parts`` (file, kind, page, name, stem, ext, in_images).  Bound to
    the scan's own path column, it is applied to the file listing before splits are made.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = "path_of_scan"
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    parted = S.parts(rows.withColumn(name, at), folder, name)
    return parted.where(condition).drop(name)
