"""Shared plumbing of the operators: tables, checkpoints, row numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where that is unset (unit tests) the session's warehouse is used, which is shared as well.
    """
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return told or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, folder: str) -> DataFrame:
    """Written to a folder of the shared file system and read again: the lineage is cut and the size is the files'."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def let(value, body):
    """Bind an expensive array or struct expression once inside a native expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, prolonged until no column of ``df`` bears them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
