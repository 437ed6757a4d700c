"""From words to records, pages and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docengine.functions import fields, labels as L, text as T
from docengine.functions.labelindex import LabelIndex
from docengine.operators import words as W

FIELDS = ["serial_no", "epic_no", "epic_valid", "name", "relation_type", "relation_name", "house_no", "age", "gender"]


def with_line_fields(images: DataFrame, lines: Column, strict: bool = False) -> DataFrame:
    """``images`` with name, relation (struct), house_no, age, gender from an array of lines, whose normal form is made once."""
    normal = F.col("_normal")
    return images.withColumn("_normal", fields.normal_lines(lines)).withColumns({
        "name": fields.name_of(lines, normal), "relation": fields.relation_of(lines, normal), "house_no": fields.house_of(lines, normal),
        "age": fields.age_of(lines, normal), "gender": fields.gender_of(lines, strict, normal),
    }).drop("_normal")


#: Column -> label variants and longest value.
WANTED = {
    "_v_name": (L.NAME_LABELS, 80), "_v_house": (L.HOUSE_LABELS, 80), "_v_age": (L.AGE_LABELS, 6), "_v_gender": (L.GENDER_LABELS, 12),
    **{f"_v_{kind}": (variants, 80) for kind, variants in L.RELATION_LABELS.items()},
}
INDEX = LabelIndex.of({c: variants for c, (variants, _) in WANTED.items()})


def with_word_fields(images: DataFrame, next_line: bool = True, strict: bool = False, prefix: str = "") -> DataFrame:
    """``images`` with the same fields from word boxes: label search, value until the next label, next visual line.

    Words that carry the ``hits`` of INDEX are searched once for all labels.
    """
    known = any(f.name == "hits" for f in images.schema["words"].dataType.elementType)
    rows, wanted = fields.with_label_values(images, WANTED, next_line, index=INDEX if known else None), WANTED
    options = F.array(*[F.struct(F.lit(kind).alias("type"), T.strip_name_label(F.col(f"_v_{kind}")).alias("name")) for kind in L.RELATION_LABELS])
    none = F.struct(F.lit("").alias("type"), F.lit("").alias("name"))
    return rows.withColumns({
        f"{prefix}name": F.col("_v_name"), f"{prefix}relation": F.coalesce(F.get(F.filter(options, lambda o: o["name"] != ""), F.lit(0)), none),
        f"{prefix}house_no": T.clean_house_value(F.col("_v_house")), f"{prefix}age": T.clean_digits(F.col("_v_age")), f"{prefix}gender": T.map_gender(F.col("_v_gender"), strict),
    }).drop(*wanted)


def assemble(images: DataFrame, next_line: bool = True, strict: bool = False) -> DataFrame:
    """Records of images with lines, words, epic_raw, serial_raw (ordered readings), serial_fallback, house_roi and error.

    Line fields come first; word fields, which cost more, are only computed for the images
    that lack one: the others go on without words, in the same pass.  Photo text is no relation.  Images with an error keep
    only their codes.
    """
    keep = [c for c in images.columns if c not in ("lines", "words", "epic_raw", "serial_raw", "serial_fallback", "house_roi")]
    epic = T.clean_epic(F.coalesce("epic_raw", F.lit("")))
    serial = fields.either(T.fold_serial(F.coalesce("serial_raw", F.array().cast("array<string>"))), T.clean_serial(F.coalesce("serial_fallback", F.lit(""))))
    coded = images.withColumn("epic_no", epic).withColumn("epic_valid", T.epic_valid(F.col("epic_no"))).withColumn("serial_no", serial)
    read = with_line_fields(coded, F.coalesce("lines", F.array().cast("array<string>")), strict)
    lacks = (F.col("name") == "") | (F.col("relation.name") == "") | (F.col("house_no") == "") | (F.col("age") == "") | (F.col("gender") == "")
    none = F.array().cast(images.schema["words"].dataType)
    filled = read.withColumn("words", F.when(lacks, F.coalesce("words", none)).otherwise(none))
    part = with_word_fields(filled, next_line, strict, "_")
    rows = part.withColumns({
        "name": fields.either(F.col("name"), F.col("_name")),
        "relation": F.when(F.col("relation.name") != "", F.col("relation")).otherwise(F.col("_relation")),
        "house_no": fields.either(fields.either(F.col("house_no"), F.col("_house_no")), T.clean_house_value(F.coalesce("house_roi", F.lit("")))),
        "age": fields.either(F.col("age"), F.col("_age")), "gender": fields.either(F.col("gender"), F.col("_gender")),
    }).drop("_name", "_relation", "_house_no", "_age", "_gender")
    relation = T.strip_name_label(F.col("relation.name"))
    rows = rows.withColumn("relation_name", relation)
    photo = (F.col("relation_name") != "") & T.has_photo_marker(F.col("relation_name"))
    rows = rows.withColumn("relation_type", F.when(photo, "").otherwise(F.col("relation.type"))).withColumn("relation_name", F.when(photo, "").otherwise(F.col("relation_name")))
    known = ["serial_no", "epic_no", "epic_valid"]
    failed = F.col("error").isNotNull() if "error" in images.columns else F.lit(False)
    return rows.select(*keep, *known, *[F.when(~failed, F.col(c)).alias(c) for c in FIELDS if c not in known])


def blank(value: Column) -> Column:
    return T.strip(F.coalesce(value, F.lit(""))) == ""


def page_stats(records: DataFrame, page: list[str]) -> DataFrame:
    """Records, valid codes and missing fields of every page."""
    missing = {"name": "name", "epic": "epic_no", "house": "house_no", "age": "age", "gender": "gender"}
    return records.groupBy(*page).agg(
        F.count("*").alias("total"), F.count_if(F.coalesce("epic_valid", F.lit(False))).alias("epic_valid_count"),
        *[F.count_if(blank(F.col(c))).alias(f"missing_{n}") for n, c in missing.items()],
    )


def timing(rows: DataFrame, by: list[str], seconds: str = "seconds") -> DataFrame:
    """Images, total and average seconds, rounded to four places."""
    total = F.sum(seconds)
    return rows.groupBy(*by).agg(F.count("*").alias("images_processed"), F.round(total, 4).alias("total_seconds"), F.round(total / F.count("*"), 4).alias("avg_seconds_per_image"))


def levels(rows: DataFrame, seconds: str = "seconds", error: str = "error") -> DataFrame:
    """Totals of a run, its files and their pages: level, file, page, images, ok, failed, seconds, average and milliseconds for each image that is ok.

    One pass over the rows makes sums per page; the grouping sets then expand pages, not
    images.  Names are null above their level, so a level is told by ``level``, not by null.
    """
    sums = rows.groupBy("file", "page").agg(F.count("*").alias("images"), F.count_if(F.col(error).isNull()).alias("ok"), F.sum(seconds).alias("seconds"))
    total = F.sum("seconds")
    kind = F.when(F.grouping("file") == 1, "run").when(F.grouping("page") == 1, "file").otherwise("page")
    return sums.rollup("file", "page").agg(
        kind.alias("level"), F.sum("images").alias("images"), F.sum("ok").alias("ok"), (F.sum("images") - F.sum("ok")).alias("failed"), F.round(total, 4).alias("total_seconds"),
        F.round(F.try_divide(total, F.sum("images")), 4).alias("avg_seconds_per_image"), F.round(F.coalesce(F.try_divide(total, F.sum("ok")), F.lit(0.0)) * 1000, 1).alias("ms_per_ok"),
    )


def watched(rows: DataFrame, error: str = "error") -> tuple[DataFrame, Observation]:
    """``rows``, and what will be known of them once they have been written: images, ok, failed; no second pass."""
    seen = Observation()
    failed = F.count_if(F.col(error).isNotNull())
    return rows.observe(seen, F.count(F.lit(1)).alias("images"), (F.count(F.lit(1)) - failed).alias("ok"), failed.alias("failed")), seen
