"""Input views derived from the benchmark tables, as SQL that Spark and DuckDB both run.

The tables hold no images, recognised words or labelled lines, so these views make them
with plain arithmetic.  ``{array}`` style differences are kept out: each view is scalar SQL.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.sources.images import to_png

RECORDS = """
SELECT c_custkey AS k, 'file-' || CAST(CAST(floor(c_custkey / 150) AS INT) AS STRING) AS file, 'page-' || CAST(c_custkey % 50 AS STRING) AS page,
  'img-' || CAST(c_custkey AS STRING) || '.png' AS image,
  CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'பெயர் : ' || c_name WHEN 2 THEN 'Name - ' || c_name || ' -' WHEN 3 THEN 'na‌me : ' || c_name
    WHEN 4 THEN 'NAME:' || c_name || '  Photo is available' ELSE ' Name  : ' || c_name END AS l0,
  CASE c_custkey % 6 WHEN 0 THEN 'Father Name : ' || n_name WHEN 1 THEN 'தந்தையின் பெயர் : ' || n_name WHEN 2 THEN 'Husband''s Name - ' || n_name
    WHEN 3 THEN 'தாய் பெயர்: ' || n_name || ' -' WHEN 4 THEN 'Mother ' || n_name ELSE '' END AS l1,
  CASE c_custkey % 5 WHEN 0 THEN 'House No : ' || CAST(c_custkey % 300 AS STRING) || '/A' WHEN 1 THEN 'வீட்டு எண் : ' || CAST(c_custkey % 90 AS STRING) || ' Photo'
    WHEN 2 THEN 'House Number - - ' || CAST(c_custkey % 77 AS STRING) || ' B 1' WHEN 3 THEN 'House : Old ' || CAST(c_custkey % 9 AS STRING) ELSE 'ட்டு எண் ' || CAST(c_custkey AS STRING) END AS l2,
  CASE c_custkey % 8 WHEN 0 THEN 'Age : 45 Gender : Male' WHEN 1 THEN 'வயது : 79 பாலினம் : ஆண்' WHEN 2 THEN 'Age 33 Gender Female' WHEN 3 THEN 'வயது ௪௫ பாலினம் - பெண்'
    WHEN 4 THEN 'village 12 gender: M' WHEN 5 THEN 'Age: Gender : Unknownxyz' WHEN 6 THEN 'Age - 101 பாலினம் : திருநங்கை' ELSE 'Gender : averyveryverylongvalue here' END AS l3,
  CASE WHEN c_custkey % 3 = 0 THEN 'Photo is available' ELSE '' END AS l4
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

CODES = """
SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN 'a8c' WHEN 1 THEN 'X Y-Z' WHEN 2 THEN '01' WHEN 3 THEN '1s2' WHEN 4 THEN '' ELSE 'B0l ' END || CAST(o_orderkey * 7 AS STRING)
  || CASE o_orderkey % 4 WHEN 0 THEN 'OIZSB' WHEN 1 THEN ' o1' ELSE '' END AS raw,
  CASE o_orderkey % 5 WHEN 0 THEN '000' WHEN 1 THEN '' WHEN 2 THEN '12.9' WHEN 3 THEN '-3.7' ELSE ' x' || CAST(o_orderkey AS STRING) END AS number,
  CASE o_orderkey % 5 WHEN 0 THEN '007' WHEN 1 THEN '' WHEN 2 THEN '0000' WHEN 3 THEN '12345' ELSE CAST(o_custkey % 100 AS STRING) END AS r0,
  CAST(o_custkey % 20 AS STRING) AS r1, CASE WHEN o_orderkey % 3 = 0 THEN '0' || CAST(o_custkey % 1000 AS STRING) ELSE '' END AS r2
FROM orders
"""

FILES = """
SELECT p_partkey AS id, 'roll ' || CAST(p_partkey % 40 AS STRING) || '/ஆவி' AS folder_name, 'f' || CAST(p_partkey % 40 AS STRING) AS file,
  CASE p_partkey % 4 WHEN 0 THEN 'images' WHEN 1 THEN 'crops' WHEN 2 THEN 'images' ELSE 'text' END AS kind,
  'page-' || CASE WHEN p_partkey % 1200 < 10 THEN '00' WHEN p_partkey % 1200 < 100 THEN '0' ELSE '' END || CAST(p_partkey % 1200 AS STRING)
    || CASE p_partkey % 5 WHEN 0 THEN '-img-01' WHEN 1 THEN '_IMG_02' WHEN 2 THEN '-img3' ELSE '' END AS stem,
  CASE p_partkey % 9 WHEN 0 THEN 'png' WHEN 1 THEN 'JPG' WHEN 2 THEN 'Png' WHEN 3 THEN 'tif' WHEN 4 THEN 'jpeg' WHEN 5 THEN 'txt' WHEN 6 THEN 'webp' WHEN 7 THEN 'bmp' ELSE 'tiff' END AS ext,
  CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS in_images
FROM part
"""

BOXES = """
SELECT l_orderkey AS page, CAST((l_partkey * 13) % 40 * 20 + (l_linenumber % 2) * 5 AS INT) AS x, CAST((l_suppkey * 7) % 30 * 40 + (l_partkey % 3) * 3 AS INT) AS y,
  CAST(60 + (l_partkey % 5) * 60 AS INT) AS w, CAST(40 + (l_suppkey % 7) * 30 AS INT) AS h, CAST(3 + l_linenumber % 4 AS INT) AS n_vertices
FROM lineitem
"""

METRICS = """
SELECT l_orderkey AS page, l_partkey AS part, l_suppkey AS supp, l_linenumber AS i, l_discount AS ink_frac, l_tax * 10.0 AS line_ratio, CAST(l_quantity AS INT) AS small_components,
  l_tax * 3.0 AS largest_cc_ratio, l_discount * 0.4 AS edge_frac, l_tax * 0.5 AS post_edge_frac
FROM lineitem
"""

SCORES = """
SELECT l_orderkey AS folder, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS INT) AS pos,
  l_discount / 10.0 AS ink_ratio, l_tax / 20.0 AS table_line_ratio, l_quantity > 3.0 AS readable
FROM lineitem
"""

USAGE = """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS INT) END AS prompt_tokens, CAST(o_custkey % 1000 AS INT) AS completion_tokens,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 0.2 END AS input_cost, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 0.6 END AS output_cost, o_orderkey % 11 <> 0 AS has_usage
FROM orders
"""

RESPONSES = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '```json
' || props || '
```' WHEN 2 THEN 'Here it is: ' || props || ' as asked' WHEN 3 THEN 'none' WHEN 4 THEN '[1, {"a": "}"}] tail' ELSE '{"cut": ' || props END AS content
FROM events
"""

#: Metadata documents of both layouts, with values of wrong kinds, and text that is no JSON.
METADATA = """
SELECT o_orderkey AS k, CASE o_orderkey % 8 WHEN 7 THEN 'no document' WHEN 6 THEN
  '{"document_metadata":{"electoral_roll_year":' || CAST(2000 + o_custkey % 26 AS STRING) || ',"page_number":' || CAST(o_orderkey % 40 AS STRING) || '},"constituency":{"assembly_constituency_number":"'
    || CAST(o_custkey % 234 AS STRING) || '"},"authority":{"signature_present":' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"yes"' END || '},"elector_summary":{"total_electors":"1,' || CAST(100 + o_custkey % 900 AS STRING) || '"}}'
  ELSE '{"document_metadata":{"electoral_roll_year":' || CASE WHEN o_orderkey % 5 = 0 THEN '"unknown"' WHEN o_orderkey % 5 = 1 THEN '[2024]' ELSE CAST(2000 + o_custkey % 26 AS STRING) END || ',"page_number_current":"'
    || CAST(o_orderkey % 40 AS STRING) || '"},"constituency_details":{"assembly_constituency_number":' || CAST(o_custkey % 234 AS STRING) || '},"authority_verification":{"signature_present":'
    || CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN '"perhaps"' ELSE 'false' END || '},"detailed_elector_summary":{"net_total":{"total":' || CASE WHEN o_orderkey % 4 = 0 THEN '{"all":5}' ELSE CAST(o_custkey AS STRING) END || '}}}' END AS document
FROM orders
"""


def spread(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` dealt out by their first column if the scan has fewer splits than there are cores.

    Row-wise work then uses all cores on a small table; a scan with splits enough gets no shuffle.
    """
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, rows.columns[0]) if rows.rdd.getNumPartitions() < cores else rows


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view's SQL over the tables of a folder, without registering names in the session."""
    import re

    tables = sorted(set(re.findall(r"\b(?:FROM|JOIN) ([a-z]+)", sql)))
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    driving = re.search(r"\bFROM ([a-z]+)", sql).group(1)
    frames[driving] = spread(spark, frames[driving])
    escaped = sql.replace("{", "{{").replace("}", "}}")
    named = re.sub(r"\b(FROM|JOIN) ([a-z]+)", r"\1 {\2}", escaped)
    return spark.sql(named, **frames)


def doc_words(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """Words of all documents as a recogniser would give them; one line of text is one line.

    ``gathered`` deals the texts out by doc_id before they become words, whose rows are some ten times
    as large: what is collected by document or line afterwards then needs no shuffle of words.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.repartition("doc_id") if gathered else spread(spark, docs)
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_num", "line")).select("doc_id", "line_num", F.posexplode(F.split("line", " ")).alias("i", "text"))
    conf = ((F.col("doc_id") * 31 + F.col("line_num") * 7 + F.col("i") * 13) % 100 - 1).cast("int")
    one = F.lit(1)
    return rows.select(
        "doc_id", "line_num", "i", "text", conf.alias("conf"), (F.col("i") * 10).alias("x"), (F.col("line_num") * 20).alias("y"), (F.length("text") * 8).alias("w"), F.lit(12).alias("h"),
        one.alias("block_num"), one.alias("par_num"), (F.col("i") + 1).alias("word_num"),
    )


def doc_word_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """text, conf and x of the words of ``doc_words``, as parallel arrays of each document in its order.

    They are made from the texts of a document at once, so that no word is a row that a sort must
    hold; only where a doc_id has several texts are their words brought into one order.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("text is not null").repartition("doc_id")
    texts = docs.groupBy("doc_id").agg(F.collect_list("text").alias("texts"))

    def word(line_num: Column, i: Column, text: Column) -> Column:
        conf = ((F.col("doc_id") * 31 + line_num * 7 + i * 13) % 100 - 1).cast("int")
        return F.struct(line_num.alias("line_num"), i.alias("i"), text.alias("text"), conf.alias("conf"), (i * 10).alias("x"))

    def words(text: Column) -> Column:
        return F.flatten(F.transform(F.split(text, "\n"), lambda line, n: F.transform(F.split(line, " "), lambda w, i: word(n, i, w))))

    several = F.array_sort(F.flatten(F.transform("texts", words)))
    packed = texts.select("doc_id", F.when(F.size("texts") == 1, words(F.get("texts", F.lit(0)))).otherwise(several).alias("w"))
    return packed.select("doc_id", *[F.col(f"w.{c}").alias(c) for c in ("text", "conf", "x")])


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record view with its non-empty lines as an array."""
    rows = view(spark, sf_dir, RECORDS)
    return rows.select("k", "file", "page", "image", F.filter(F.array("l0", "l1", "l2", "l3", "l4"), lambda x: x != "").alias("lines"))


def record_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record view as recognised words; labels and values may stand on different lines."""
    rows = view(spark, sf_dir, RECORDS).select("k", F.posexplode(F.array("l0", "l1", "l2", "l3", "l4")).alias("line_num", "line"))
    words = rows.select("k", "line_num", F.posexplode(F.split("line", " ")).alias("pos", "text"))
    at = F.col("line_num") * 100 + F.col("pos")
    return words.select(
        "k", at.alias("i"), "text", F.lit(90).alias("conf"), (F.col("pos") * 60).alias("x"), (F.col("line_num") * 30).alias("y"), (F.length("text") * 5).alias("w"), F.lit(20).alias("h"),
        F.lit(1).alias("block_num"), F.lit(1).alias("par_num"), "line_num", (F.col("pos") + 1).alias("word_num"),
    )


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawn pages (file, page, path_pos, png), one a supplier, with one to three rows of two framed boxes with strokes.

    A page costs about a second of pixel work, so these come from the smallest table that grows.
    """
    def run(frames):
        drawn = cache(lambda n: to_png(form(n)))  # one drawing for each number of rows
        for frame in frames:
            yield frame.assign(png=[drawn(int(n)) for n in frame["n"]])[["file", "page", "path_pos", "png"]]

    key = F.col("s_suppkey")
    rows = spread(spark, spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey")).select(
        F.concat(F.lit("f"), F.floor(key / 20).cast("string")).alias("file"), F.format_string("page-%03d", (key % 20).cast("int")).alias("page"), key.cast("int").alias("path_pos"), (key % 3 + 1).alias("n")
    )
    return rows.mapInPandas(run, "file string, page string, path_pos int, png binary")


def form(rows: int = 3, columns: int = 2) -> np.ndarray:
    """A white page with framed boxes that hold some strokes."""
    page = np.full((1679, 1187), 255, np.uint8)
    for r in range(rows):
        for c in range(columns):
            box = page[60 + r * 400 :, 40 + c * 560 :][:300, :500]
            box[:3] = box[-3:] = box[:, :3] = box[:, -3:] = 0
            for k in range(6):
                for m in range(12):
                    box[40 + 40 * k : 48 + 40 * k, 30 + 35 * m : 45 + 35 * m] = 0
    return page
