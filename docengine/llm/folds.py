"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A sampled text is given to training whole up to PIECES * PIECE code points; of a longer one, PIECES
#: pieces spread evenly from its start to its end.  Bounds the driver's memory by bytes, drops no row.
PIECES = 8
PIECE = 1500


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0.  A null id counts as the empty text, whose remainder is 0."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def excerpt(text: Column) -> Column:
    """A short text as it is; PIECES evenly spread pieces of a longer one."""
    n = F.length(text)
    start = lambda k: (F.floor(k * (n - PIECE) / (PIECES - 1)) + 1).cast("int")
    pieces = F.concat_ws("\n", *[F.substring(text, start(F.lit(k)), F.lit(PIECE)) for k in range(PIECES)])
    return F.when(n <= PIECES * PIECE, text).otherwise(pieces)


def _order(*more: str) -> list[Column]:
    return [F.xxhash64("doc_id", F.lit(11)), *map(F.col, more)]


def _fetch(chosen: DataFrame, docs: DataFrame, most: int, *columns: str) -> list:
    """Excerpts of the texts of at most ``most`` broadcast ids; no text is shuffled, and ties are broken by content."""
    fit = docs.where(F.length("text") > 0).select("doc_id", "text", *columns).join(F.broadcast(chosen), "doc_id", "left_semi")
    rows = fit.select("doc_id", excerpt(F.col("text")).alias("text"), *columns)
    return rows.orderBy(*_order("doc_id", "text", *columns)).limit(most).collect()


def sample(ids: DataFrame, docs: DataFrame, most: int, *columns: str) -> list:
    """Rows (doc_id, text, columns) of ``docs`` for up to ``most`` of the doc_ids in ``ids``, chosen by a hash: the same in each run."""
    chosen = ids.where("doc_id is not null").select("doc_id").orderBy(*_order("doc_id")).limit(most).distinct()
    return _fetch(chosen, docs, most, *columns)


def stratified(ids: DataFrame, docs: DataFrame, most: int, by: str) -> list:
    """Like ``sample``, with about equal numbers of each value of ``by``; rare values give what they have.

    Values are counted first; a hash threshold by value keeps a few times its share, so the
    ranking by value only sees a bounded number of rows.
    """
    ids = ids.where("doc_id is not null").select("doc_id", by)
    count = {r[by]: r["count"] for r in ids.groupBy(by).count().orderBy(F.desc("count"), by).limit(most).collect()}
    left, share = most, {}
    for k, v in enumerate(sorted(count, key=lambda v: (count[v], v))):  # rare values first; what they leave goes to the others
        share[v] = min(count[v], max(left // (len(count) - k), 1))
        left -= share[v]
    if not share:
        return []
    spark = docs.sparkSession
    quota = spark.createDataFrame([(v, share[v], min(1.0, (4.0 * share[v] + 100) / count[v])) for v in sorted(share)], f"{by} {ids.schema[by].dataType.simpleString()}, quota int, part double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = ids.join(F.broadcast(quota), by).where(draw < F.col("part"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*_order("doc_id")))
    chosen = few.withColumn("rank", rank).where(F.col("rank") <= F.col("quota")).select("doc_id").distinct()
    return _fetch(chosen.limit(most), docs, most, by)


def release() -> None:
    """Give the memory of a finished training back to the system, where the C library can."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: nothing to give back
