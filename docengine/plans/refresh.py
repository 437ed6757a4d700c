"""Incremental runs: pages whose crops changed are read again, all others stay as they are.

A ledger keeps a fingerprint of each page's crops (names, sizes and times of change, from the
listing alone).  A run compares it with what is there now, reads the stale pages in waves, and writes
each wave's records by dynamic partition overwrite, one partition a page.  The ledger's rows of a wave follow
its records, so a run that breaks off repeats one wave and finds the rest done.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.plans import stages
from docengine.session import settled
from docengine.sources import files as S, providers as V, scan as N
from docengine.sources.config import Settings

PAGE = ["file", "page"]
LEDGER = "file string, page string, images int, fingerprint string, run long"


def fingerprints(crops: DataFrame) -> DataFrame:
    """file, page, images and fingerprint of crops (file, page, name, length, modificationTime); a page's crops in any order."""
    one = F.sha2(F.concat_ws("\n", "name", F.col("length").cast("string"), F.col("modificationTime").cast("string")), 256)
    return crops.groupBy(*PAGE).agg(F.count("*").cast("int").alias("images"), F.sha2(F.array_join(F.array_sort(F.collect_list(one)), ""), 256).alias("fingerprint"))


def current(ledger: DataFrame) -> DataFrame:
    """The last entry of every page in an append-only ledger; pages whose last entry has no images are gone."""
    last = ledger.groupBy(*PAGE).agg(F.max(F.struct("run", "images", "fingerprint")).alias("last"))
    return last.select(*PAGE, "last.images", "last.fingerprint").where("images > 0")


def changes(now: DataFrame, ledger: DataFrame) -> DataFrame:
    """file, page and change (new, changed, gone) of the pages that differ between ``now`` and the ledger."""
    known = current(ledger).select(*PAGE, F.col("fingerprint").alias("known"))
    both = now.select(*PAGE, "fingerprint").join(known, PAGE, "full_outer")
    change = F.when(F.col("known").isNull(), "new").when(F.col("fingerprint").isNull(), "gone").when(F.col("known") != F.col("fingerprint"), "changed")
    return both.select(*PAGE, change.alias("change")).where("change is not null")


@dataclass
class Refreshed:
    """What a run did: pages read, pages removed, waves."""

    read: int = 0
    removed: int = 0
    waves: int = 0


def refresh(spark: SparkSession, folder: str, output: str, provider: V.OcrProvider, settings: Settings, run: int, most: int = N.WAVE) -> Refreshed:
    """Bring ``output``/records up to date with the crops below ``folder``; ``output``/ledger remembers.

    ``run`` numbers runs upwards.  With ``force`` every page is read.  Pages that have gone lose
    their partition.
    """
    records, book = f"{output}/records", f"{output}/ledger"
    # Other folders have no page, and no limit hides a page that has gone.
    every = S.crop_images(N.listing(spark, folder)).where("kind = 'crops' and page is not null")
    ledger = spark.read.schema(LEDGER).parquet(book) if _exists(spark, book) else spark.createDataFrame([], LEDGER)
    now = fingerprints(every)
    different = settled(changes(now, ledger))
    done = Refreshed()
    stale = now.select(*PAGE) if settings.force else different.where("change <> 'gone'").select(*PAGE)
    chosen = N.choose(every, settings).join(stale, PAGE, "left_semi")
    for wave in N.waves(spark, chosen, most, keep_together=PAGE):
        crops = settled(wave.select(*PAGE, F.col("name").alias("image"), "content", "name", "length", "modificationTime"))
        made = stages.read(crops.select(*PAGE, "image", "content"), provider, Settings(**{**settings.__dict__, "limit": None, "limit_pages": 0, "only_folder": None, "only_page": None}))
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PAGE).parquet(records)
        entries = fingerprints(crops).withColumn("run", F.lit(run).cast("long"))
        entries = settled(entries.select(*PAGE, "images", "fingerprint", "run"))
        entries.coalesce(1).write.mode("append").parquet(book)
        done.read += entries.count()
        done.waves += 1
    for page in different.where("change = 'gone'").orderBy(*PAGE).toLocalIterator():
        _remove(spark, f"{records}/file={_escaped(spark, page['file'])}/page={_escaped(spark, page['page'])}")
        done.removed += 1
    if done.removed:
        gone = different.where("change = 'gone'").select(*PAGE, F.lit(0).alias("images"), F.lit("").alias("fingerprint"), F.lit(run).cast("long").alias("run"))
        gone.coalesce(1).write.mode("append").parquet(book)
    return done


def read_records(spark: SparkSession, output: str) -> DataFrame:
    """The records as they are now; folder and page names stay strings."""
    some = spark.read.parquet(f"{output}/records")
    schema = ", ".join(f"`{f.name}` {'string' if f.name in PAGE else f.dataType.simpleString()}" for f in some.schema)
    return spark.read.schema(schema).parquet(f"{output}/records")


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, store = _path(spark, name)
    return store.exists(path)


def _remove(spark: SparkSession, name: str) -> None:
    path, store = _path(spark, name)
    store.delete(path, True)


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it into a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
