"""Words of recognised images: cleaning, filtering, lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions import text as T
from docengine.functions.labelindex import LabelIndex

LINE = ["block_num", "par_num", "line_num"]


def explode_words(ocr: DataFrame, keys: list[str], arrays: list[str] | None = None) -> DataFrame:
    """One row a word from parallel arrays, with its position i."""
    arrays = arrays or ["text", "conf", "left", "top", "width", "height", "block_num", "par_num", "line_num", "word_num"]
    rows = ocr.select(*keys, F.posexplode(F.arrays_zip(*arrays)).alias("i", "w"))
    rename = {"left": "x", "top": "y", "width": "w", "height": "h"}
    return rows.select(*keys, "i", *[F.col("w")[a].alias(rename.get(a, a)) for a in arrays])


def not_blank(words: DataFrame) -> DataFrame:
    return words.withColumn("text", T.strip("text")).where("text <> ''")


def confident(conf: Column, text: Column) -> Column:
    """Known confidence of 20 or more, unknown confidence, or a Tamil character."""
    c = T.safe_int(conf)
    return (c == -1) | (c >= 20) | text.rlike(f"[{T.TAMIL}]")


def usable(words: DataFrame) -> DataFrame:
    """Words that are neither blank nor doubtful."""
    return not_blank(words).where(confident(F.col("conf"), F.col("text")))


def lines(words: DataFrame, image: list[str], tie: str = "i") -> DataFrame:
    """image, line key, line_pos and the joined text of every line, left to right; ``tie`` orders words at one x."""
    word = F.struct(F.col("x").alias("x"), F.col(tie).alias("tie"), F.col("i").alias("i"), F.col("text").alias("text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(word)), lambda w: w["text"]), " ")
    return not_blank(words).groupBy(*image, *LINE).agg(joined.alias("line"))


def line_arrays(words: DataFrame, image: list[str]) -> DataFrame:
    """image and its lines in key order."""
    key = F.struct(*LINE, "line")
    return lines(words, image).groupBy(*image).agg(F.transform(F.array_sort(F.collect_list(key)), lambda k: k["line"]).alias("lines"))


def word_arrays(words: DataFrame, image: list[str], index: LabelIndex | None = None) -> DataFrame:
    """image and its usable words in recognition order, each with its normal form and whether it stops a value.

    Both are computed once per word here, so the array functions that follow only compare; with
    an ``index``, so are the labels' tokens that a word fits (``hits``).
    """
    told = usable(words).withColumn("norm", T.normalize_text(F.col("text"))).withColumn("_match", F.translate("norm", "0", "o")).withColumn("stop", T.stops(F.col("_match")))
    if index is not None:
        told = told.withColumn("hits", index.mask(F.col("norm")))
    word = F.struct("i", "text", "x", "y", "w", "h", *LINE, "norm", "stop", *(["hits"] if index is not None else []))
    return told.groupBy(*image).agg(F.array_sort(F.collect_list(word)).alias("words"))
