"""Continuous ingestion (an extension): new crops become records as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docengine.plans import stages
from docengine.sources import files, providers
from docengine.sources.config import Settings


def crops(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    """New files below a folder as a stream of file, page, image, content."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    rows = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(folder)
    return files.crop_images(files.parts(rows, folder)).select("file", "page", F.col("name").alias("image"), "content")


def records(stream: DataFrame, provider: providers.OcrProvider, settings: Settings, output: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch is read and written once under its batch number, so a restart overwrites, not repeats."""

    def write(batch: DataFrame, number: int) -> None:
        stages.read(batch, provider, settings).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
