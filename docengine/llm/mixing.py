"""Mixing sources to target weights.

Sizes are added up per source (map-side partial sums, so a hot source is a few rows),
targets follow by water-filling, and every document is emitted floor(rate) times plus one
Bernoulli copy whose uniform number is a hash of its doc_id.  Everything is native.

Targets: source i gets min(limit * size_i, theta * weight_i), with theta such that the
targets share ``share`` of all sizes.  theta is the fixpoint of resharing the excess of
the capped sources; each step is one aggregate over the (source, size) table, so the
number of sources is not bounded by the driver.

Draws: ``DRAWS`` hash seeds are compared for each source (sums only) and the seed whose mix
comes nearest to the target is used.  Each draw is a Bernoulli copy per document with the
exact fraction; comparing a few fixed draws narrows the deviation on small sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.llm.common import materialise

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # targets share 3/2 of all sizes
LIMIT = 2
DRAWS = 8
SALTS = 32
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Rank of each source by code point, null last, without gathering the sources in one task.

    UTF-8 order is code point order, and Spark compares strings by bytes.  The table is
    range-partitioned; the partitions' row counts give each partition's first rank.
    """
    ordered = materialise(
        sources.repartitionByRange(F.col("source").isNull(), "source")
        .sortWithinPartitions(F.col("source").isNull(), "source")
        .withColumn("at", F.monotonically_increasing_id())
    )
    part = F.shiftright("at", 33)
    firsts, total = [], 0
    for row in sorted(ordered.groupBy(part.alias("part")).count().collect()):  # one row per partition
        firsts.append((row["part"], total))
        total += row["count"]
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("first", T.LongType())])
    starts = ordered.sparkSession.createDataFrame(firsts, schema)
    return ordered.withColumn("part", part).join(F.broadcast(starts), "part").select(
        "source", "source_size", (F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank")
    )


def targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT) -> DataFrame:
    """source, source_size, target of each source of ``sized`` (source, size)."""
    ranked = _ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = materialise(ranked.withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int"))))
    row = weighed.agg(F.sum("source_size").alias("all"), F.sum(F.when(F.col("source_size") > 0, F.col("weight"))).alias("w")).head()
    total, theta, capped = (row["all"] or 0) * share[0], None, -1
    spent, open_weight = 0, row["w"] or 0
    while open_weight:
        theta = (total - share[1] * spent) / (share[1] * open_weight)
        over = F.col("source_size") * limit < F.col("weight") * F.lit(theta)
        row = weighed.where("source_size > 0").agg(
            F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, F.col("source_size") * limit)).alias("spent"), F.sum(F.when(~over, F.col("weight"))).alias("open")
        ).head()
        if row["n"] == capped:
            break
        capped, spent, open_weight = row["n"], row["spent"] or 0, row["open"] or 0
    most = (F.col("source_size") * limit).cast("double")
    target = most if theta is None else F.least(most, F.col("weight") * F.lit(float(theta)))
    return weighed.select("source", "source_size", target.alias("target"))


def uniform(key: Column, draw: int) -> Column:
    """A number in [0, 1) from 32 bits of md5(draw group : key)."""
    digest = F.md5(F.concat(F.lit(f"{draw // 4}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1 + 8 * (draw % 4), 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def mix(docs: DataFrame, draws: int = DRAWS, **how) -> DataFrame:
    """All rows and columns of ``docs`` with size, source_size, target and copies.

    A null text has size 0 and a null source is a source of its own, ranked last.  Sources
    without words have target 0 and keep no copies.  Rows that repeat a doc_id (or have none)
    share one uniform number, hence their copies.  Columns of ``docs`` that clash with the
    names above are replaced.  An empty table gives an empty result.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "salt", "rate", "draw", "to")
    sized = docs.withColumn("size", size_of(F.col("text")))
    narrow = materialise(sized.select("doc_id", "source", "size"))
    goal = materialise(targets(narrow, **how))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    floor = F.floor("rate").cast("long")
    goal = goal.withColumn("rate", rate)

    def copies(draw: int) -> Column:
        return floor + (uniform(F.col("doc_id"), draw) < F.col("rate") - floor).cast("long")

    # A hot source is spread over SALTS groups; the source table, a row a source, is repeated for each.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("to_salt")
    same = F.col("source").eqNullSafe(F.col("to")) & (F.col("salt") == F.col("to_salt"))
    aims = goal.withColumnRenamed("source", "to")
    drawn = (
        narrow.withColumn("salt", salt).join(aims.select("*", every), same).groupBy("to", "salt")
        .agg(*[F.sum(copies(k) * F.col("size")).alias(f"d{k}") for k in range(draws)], F.first("target").alias("aim"))
        .groupBy("to").agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(draws)], F.first("aim").alias("aim"))
    )
    off = [F.struct(F.abs(F.col(f"d{k}") - F.col("aim")).alias("off"), F.lit(k).alias("draw")) for k in range(draws)]
    best = materialise(drawn.select(F.col("to").alias("for"), (F.least(*off) if draws > 1 else off[0])["draw"].alias("draw")))
    aims = aims.join(best, F.col("to").eqNullSafe(F.col("for"))).drop("for").select("*", every)
    chosen = F.coalesce(*[F.when(F.col("draw") == k, copies(k)) for k in range(draws)])
    return sized.withColumn("salt", salt).join(aims, same).withColumn("copies", chosen).drop("to", "to_salt", "salt", "rate", "draw")


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``mix`` as often as its copies say."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copy")
