"""Quality rules with adaptive thresholds, DataFrame expressions only.

Fixed cutoffs are replaced by fences from quantile sketches per (lang, source).  The sketch
is a log-bucket histogram kept as a table: a value v falls into bucket floor(log(1 + UNIT * v) /
log(GAMMA)), a row counts the documents of one (lang, source, metric, bucket), and a quantile is read off
the running counts with a relative error below GAMMA - 1.  Such sketches merge by adding counts, do
not depend on row order and pre-aggregate on the map side, so a hot source is a few hundred rows.
Sketches of small groups are merged upwards: (lang, source), then lang, then all.

Every fence comes from its group's sketch alone.  ``mean_word`` has a middle, so its fences lie SPREAD
interquartile ranges outside the quartiles.  The rates are 0 in most documents and have none: their
sketch is split where the variance between the two sides is largest, and if the upper side is a minority
(at most one in MINORITY) and lies apart (SEPARATION, after Ashman), the fence stands midway in the gap; a group
whose rates are spread without a gap gets no fence for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.llm.common import let, materialise

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5
GAMMA = 1.02
UNIT = 100.0  # rates are looked at per hundred words
SMALL = 200  # documents a group needs for fences of its own
SPREAD = 8.0
MINORITY = 4
SEPARATION = 4.3
BLUR = 35  # buckets of a factor of two: what lies closer is not apart, however alike each side is
#: Metrics with a middle, and rates.
MIDDLED = ("mean_word",)
RATES = ("symbol_rate", "dup_line_rate", "repeat_rate")
METRICS = (*MIDDLED, *RATES)


#: Columns of the table of measures, which carried columns must not bear.
NAMES = ("lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *METRICS)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text.

    Windows are hashed to 64 bits; (hash, position) pairs are sorted once, and the lengths
    of the covered stretches are added up from the sorted positions: O(n log n) in a row.
    """

    def covered(spots: Column) -> Column:
        nxt = F.concat(F.slice(spots, 2, F.greatest(F.size(spots) - 1, F.lit(0))), F.array(F.lit(2**31 - 1)))
        return F.aggregate(F.zip_with(spots, nxt, lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda s, x: s + x)

    def repeated(pairs: Column) -> Column:
        ordered = F.array_sort(pairs)

        def keep(o: Column) -> Column:
            left = F.concat(F.array(F.lit(None).cast("long")), F.transform(o, lambda x: x["h"]))
            right = F.concat(F.slice(F.transform(o, lambda x: x["h"]), 2, F.greatest(F.size(o) - 1, F.lit(0))), F.array(F.lit(None).cast("long")))
            three = F.arrays_zip(o.alias("o"), left.alias("l"), right.alias("r"))
            hits = F.filter(three, lambda t: t["o"]["h"].eqNullSafe(t["l"]) | t["o"]["h"].eqNullSafe(t["r"]))
            return F.sort_array(F.filter(F.transform(hits, lambda t: t["o"]["i"]), lambda i: i.isNotNull()))

        return let(let(ordered, keep), covered)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def count(h: Column) -> Column:
        again = F.size(F.array_distinct(h)) < F.size(h)
        return F.when(again, repeated(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(F.lit(0))

    return F.when(F.size(words) > WINDOW, let(windows(words), count)).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    blank = r"[\x20\x09-\x0D]"

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, blank + "+"), lambda x: x != "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        return F.struct(
            let(words, of_words).alias("w"),
            (F.length(t) - F.regexp_count(t, F.lit(blank))).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, of_lines).alias("n_dup_lines"),
        )

    return let(F.coalesce(text, F.lit("")), of)


def _bucket(value: Column) -> Column:
    import math

    return F.floor(F.ln(F.lit(1.0) + F.lit(UNIT) * value) / F.lit(math.log(GAMMA))).cast("int")


def _value(bucket: Column) -> Column:
    return (F.pow(F.lit(GAMMA), bucket + F.lit(0.5)) - F.lit(1.0)) / F.lit(UNIT)


def sketches(measured: DataFrame) -> DataFrame:
    """The merged sketches as a table: lang, source, metric, bucket, n, with grouping levels 0 to 2."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), _bucket(F.col(m)).alias("bucket")) for m in METRICS]))
    base = measured.where("not base_failed").select("lang", "source", pairs.alias("p")).groupBy("lang", "source", "p.metric", "p.bucket").agg(F.count("*").alias("n"))
    levels = [base.withColumn("level", F.lit(0))]
    levels.append(base.groupBy("lang", "metric", "bucket").agg(F.sum("n").alias("n")).select("lang", F.lit(None).cast("string").alias("source"), "metric", "bucket", "n", F.lit(1).alias("level")))
    levels.append(base.groupBy("metric", "bucket").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), "metric", "bucket", "n", F.lit(2).alias("level")))
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


def fences(measured: DataFrame) -> DataFrame:
    """Per level, lang and source: documents, the low and high fence of ``mean_word``, and the last bucket of each rate that is inside (null: no fence)."""
    group = ["level", "lang", "source", "metric"]
    up = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    sums = {"c": F.col("n"), "s": F.col("n") * F.col("bucket"), "q": F.col("n") * F.col("bucket") * F.col("bucket")}
    run = sketches(measured).withColumn("after", F.lead("bucket").over(Window.partitionBy(*group).orderBy("bucket")))
    run = run.withColumns({**{f"{k}1": F.sum(e).over(up) for k, e in sums.items()}, **{f"{k}0": F.sum(e).over(whole) for k, e in sums.items()}})
    c1, s1, q1, c0, s0, q0 = (F.col(c).cast("double") for c in ("c1", "s1", "q1", "c0", "s0", "q0"))
    between = F.when(F.col("after").isNotNull(), (c0 * s1 - c1 * s0) * (c0 * s1 - c1 * s0) / (c1 * (c0 - c1)))
    # The best split of a group; of equal ones the lowest.
    best = F.max(F.when(between.isNotNull(), F.struct(between.alias("b"), (-F.col("bucket")).alias("lower"), "bucket", "after", "c1", "s1", "q1"))).alias("best")
    found = run.groupBy(*group).agg(
        F.max("c0").alias("docs"), F.max("s0").alias("s0"), F.max("q0").alias("q0"), best,
        F.min(F.when(F.col("c1") * 4 >= F.col("c0"), F.col("bucket"))).alias("b1"), F.min(F.when(F.col("c1") * 4 >= F.col("c0") * 3, F.col("bucket"))).alias("b3"),
    )
    n1, n2 = F.col("best.c1").cast("double"), F.col("docs").cast("double") - F.col("best.c1")
    m1, m2 = F.col("best.s1") / n1, (F.col("s0") - F.col("best.s1")) / n2
    v1, v2 = F.col("best.q1") / n1 - m1 * m1, (F.col("q0") - F.col("best.q1")) / n2 - m2 * m2
    apart = (n2 * MINORITY <= F.col("docs")) & (F.lit(2.0) * (m2 - m1) * (m2 - m1) >= F.lit(SEPARATION * SEPARATION) * (v1 + v2 + F.lit(float(BLUR * BLUR))))
    reach = F.lit(SPREAD) * (_value(F.col("b3")) - _value(F.col("b1")))
    edges = found.select("level", "lang", "source", "docs", "metric", (_value(F.col("b1")) - reach).alias("low"), (_value(F.col("b3")) + reach).alias("high"),
                         F.when(apart, F.floor((F.col("best.bucket") + F.col("best.after")) / 2)).alias("cut"))
    of = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    return edges.groupBy("level", "lang", "source").agg(F.max("docs").alias("docs"), *[of(m, side).alias(f"{m}_{side}") for m in MIDDLED for side in ("low", "high")], *[of(m, "cut").alias(f"{m}_cut") for m in RATES])


def quality_rules(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Base measures, base_failed and the adaptive verdict of every row of ``docs``.

    A null text counts as empty: no words, so base_failed.  Null lang or source form groups
    of their own.  kept is false if base_failed, or if a metric lies outside the fences of
    the finest of (lang, source), lang and all that has SMALL documents that pass the base rules.  Very long texts are measured whole.  Equal rows get equal verdicts, extra columns are
    ignored unless carried, and an empty table gives an empty result.
    """
    carry = ["doc_id", *[c for c in carry or [] if c not in ("doc_id", *NAMES)]]
    m = docs.select(*carry, "lang", "source", measures(F.col("text")).alias("m")).select(
        *carry, "lang", "source", "m.w.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.w.n_repeat_words", "m"
    ).drop("m")
    return judge(materialise(m), carry)  # a few numbers a row, so that the texts are measured once


def judge(measured: DataFrame, carry: list[str]) -> DataFrame:
    """The joined filter over a table of base measures."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    rated = measured.withColumns({
        "base_failed": (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20),
        "mean_word": F.col("word_chars") / n,
        "symbol_rate": F.col("n_symbols") / n,
        "dup_line_rate": F.col("n_dup_lines") / n * F.lit(10.0),
        "repeat_rate": F.col("n_repeat_words") / n,
    })
    edges = fences(rated)
    names = [*[f"{m}_{side}" for m in MIDDLED for side in ("low", "high")], *[f"{m}_cut" for m in RATES]]

    def level(k: int, *keys: str) -> DataFrame:
        rows = edges.where(F.col("level") == k)
        rows = rows.where(F.col("docs") >= SMALL) if k < 2 else rows
        return rows.select(*[F.col(c).alias(f"{c}_{k}") for c in keys], F.struct(*names).alias(f"f{k}"))

    found = (
        rated.join(level(0, "lang", "source"), F.col("lang").eqNullSafe(F.col("lang_0")) & F.col("source").eqNullSafe(F.col("source_0")), "left")
        .join(level(1, "lang"), F.col("lang").eqNullSafe(F.col("lang_1")), "left")
        .join(F.broadcast(level(2)), F.lit(True), "left")  # one row
    )
    found = found.withColumn("f", F.coalesce("f0", "f1", "f2"))
    inside = F.lit(True)
    for m in MIDDLED:
        inside = inside & F.coalesce((F.col(m) >= F.col(f"f.{m}_low")) & (F.col(m) <= F.col(f"f.{m}_high")), F.lit(True))
    for m in RATES:
        inside = inside & F.coalesce(_bucket(F.col(m)) <= F.col(f"f.{m}_cut"), F.lit(True))
    return found.select(*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"))
