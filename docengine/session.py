"""Making the package importable for Python workers, and bounding what they are sent at once."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

#: Arrow batches end at so many rows or bytes, so long texts don't add up in a worker's memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Put this checkout on the workers' path; on a cluster it must also be deployed there or passed by --py-files."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    for name, most in BATCHES.items():  # what the session sets itself stays
        if name not in spark.conf.getAll:
            spark.conf.set(name, most)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset (tests)."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return told or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"


def settled(df: DataFrame) -> DataFrame:
    """``df`` as it is now, by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
