"""Connected components of an edge table, fully distributed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import materialise, remove, shared_folder, stored


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every end of the undirected ``edges`` (c1, c2); comp is the smallest id reachable.

    Every round takes the least label among the neighbours and then jumps to the label's
    own label, so paths halve.  Only a count of the changed labels comes to the driver.  Joins put
    the skewed side (edges of a hub, members of a giant component) on the left of an inner or left
    join, which adaptive execution splits.

    Labels are written each round and read again, and a round's files go with the next one.  A
    checkpoint would cut the lineage too, but it keeps the plan's size estimate, which every join
    multiplies: after some dozens of rounds the number alone fills the driver.
    """
    spark = edges.sparkSession
    folder = f"{shared_folder(spark)}/components-{uuid.uuid4().hex}"
    both = stored(edges.select("c1", "c2").union(edges.select("c2", "c1")).where("c1 <> c2").distinct(), f"{folder}/edges")
    label = both.groupBy(F.col("c1").alias("id")).agg(F.least(F.first("c1"), F.min("c2")).alias("comp"))
    k = 0
    while True:
        of = label.select(F.col("id").alias("c2"), F.col("comp").alias("near"))
        near = both.join(of, "c2").groupBy(F.col("c1").alias("id")).agg(F.min("near").alias("near"))
        step = stored(label.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")), f"{folder}/step-{k}")
        up = step.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
        new = stored(step.join(up, "comp", "left").select("id", "old", F.least("comp", F.coalesce("top", "comp")).alias("comp")), f"{folder}/label-{k}")
        remove(spark, f"{folder}/step-{k}")
        if k:
            remove(spark, f"{folder}/label-{k - 1}")
        if not new.agg(F.max(F.col("old") != F.col("comp")).alias("moved")).head()["moved"]:
            found = materialise(new.select("id", "comp"))
            remove(spark, folder)
            return found
        label = new.select("id", "comp")
        k += 1
