"""A ledger of model calls: no question is asked twice, failures are retried a fixed number of times, costs end a run.

A question is addressed by its content (model, prompt and the images' bytes), so a renamed folder
finds its answer and a changed page does not.  The ledger is append-only: a row for each attempt, with
answer, usage, cost and error.  Each round asks what is still open by an anti join, and no more of it than
the rest of the budget pays for at the mean cost so far; what a round has written is known to the next,
so a run that breaks off loses one round at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docengine.functions import text as T
from docengine.session import settled
from docengine.sources import providers as V

LEDGER = "question string, attempt int, round int, answer string, prompt_tokens int, completion_tokens int, total_tokens int, cost double, error string"


def question(model: str, prompt: str, *images: Column) -> Column:
    """The address of a question: a digest of all that is sent."""
    return F.sha2(F.concat_ws("\x1f", F.lit(model), F.sha2(F.lit(prompt), 256), *[F.sha2(i, 256) for i in images]), 256)


def state(ledger: DataFrame) -> DataFrame:
    """question, attempts, answered and, of the first attempt with an answer, answer and usage."""
    good = F.min(F.when(F.col("error").isNull(), F.struct("attempt", "answer", "prompt_tokens", "completion_tokens", "total_tokens")))
    rows = ledger.groupBy("question").agg(F.count("*").cast("int").alias("attempts"), good.alias("good"), F.max(F.struct("attempt", "error")).alias("last"))
    return rows.select("question", "attempts", F.col("good").isNotNull().alias("answered"), "good.answer", "good.prompt_tokens", "good.completion_tokens", "good.total_tokens", F.when(F.col("good").isNull(), F.col("last.error")).alias("error"))


def open_questions(questions: DataFrame, ledger: DataFrame, attempts: int) -> DataFrame:
    """Distinct questions (question, ..) without an answer and with attempts left, with the number of the next attempt."""
    known = state(ledger).select("question", F.col("attempts").alias("_n"), "answered")
    rows = questions.dropDuplicates(["question"]).join(known, "question", "left")
    return rows.where(~F.coalesce("answered", F.lit(False)) & (F.coalesce("_n", F.lit(0)) < attempts)).withColumn("attempt", F.coalesce("_n", F.lit(0)) + 1).drop("_n", "answered")


def running(rows: DataFrame, order: list[str], value: str, total: str = "running") -> DataFrame:
    """``rows`` with the sum of ``value`` up to and including each, in the order of all rows.

    No window spans the table: rows are ranged and summed inside their partition, and what the
    partitions before hold, one number each, is added.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settled(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = F.broadcast(sums.select("_part", before.alias("_ahead")))  # a row for each partition
    return ranged.withColumn(total, F.sum(value).over(inside)).join(ahead, "_part").withColumn(total, F.col(total) + F.col("_ahead")).drop("_part", "_ahead")


def affordable(questions: DataFrame, estimate: Column, budget: float, order: list[str]) -> DataFrame:
    """Questions, in order, whose estimated costs together stay within ``budget``."""
    return running(questions.withColumn("estimate", F.coalesce(estimate, F.lit(0.0))), order, "estimate").where(F.col("running") <= budget)


@dataclass
class Asked:
    """What a run did: rounds, calls, failures, and whether the budget ended it."""

    rounds: int = 0
    calls: int = 0
    failed: int = 0
    spent: float = 0.0
    broke: bool = False


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def ask(spark: SparkSession, questions: DataFrame, provider: V.VisionProvider, prompt: str, pricing: dict, path: str, attempts: int = 3, budget: float | None = None, first_estimate: float = 0.0) -> Asked:
    """Ask what is open among ``questions`` (question, front_url, back_url) and write it to the ledger at ``path``.

    A round asks every open question once; there are at most ``attempts`` rounds.  With a
    ``budget`` (all that the ledger may come to cost), a round takes only as many as the rest
    pays for at the mean cost of an answer so far, ``first_estimate`` before there is one.
    """
    price = [F.lit(pricing[k]).cast("double") for k in ("input_cost_per_1m_tokens", "output_cost_per_1m_tokens")]
    done = Asked()
    while done.rounds < attempts:
        ledger = read_ledger(spark, path)
        so_far = ledger.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"), F.count_if(F.col("error").isNull()).alias("answers"), F.coalesce(F.max("round"), F.lit(0)).alias("round")).head()
        todo = open_questions(questions, ledger, attempts)
        if budget is not None:
            mean = so_far["cost"] / so_far["answers"] if so_far["answers"] else first_estimate
            every = settled(todo)
            todo = affordable(every, F.lit(mean), budget - so_far["cost"], ["question"]).drop("estimate", "running")
            done.broke = todo.count() < every.count()
        made = V.ask_once(todo.select("question", "attempt", "front_url", "back_url"), provider, prompt)
        usage = F.col("prompt_tokens").isNotNull() | F.col("completion_tokens").isNotNull()
        cost = F.when(F.col("error").isNull(), T.cost(F.col("prompt_tokens"), F.col("completion_tokens"), *price, usage))
        made = made.withColumns({"round": F.lit(so_far["round"] + 1), "cost": cost}).select(*[c.split()[0] for c in LEDGER.split(", ")])
        made = settled(made)  # calls are made once
        seen = made.agg(F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost")).head()
        if not seen["n"]:
            break
        made.write.mode("append").parquet(path)
        done.rounds += 1
        done.calls += seen["n"]
        done.failed += seen["failed"]
        done.spent += seen["cost"]
        if done.broke or not seen["failed"]:
            break
    return done
