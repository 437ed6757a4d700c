"""Nested page and file documents, and their Markdown.

Headings, table heads and field names of the documents are fixed values of the output format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.functions import labels as L
from docengine.functions.text import md_escape, yes_no
from docengine.operators import words as W
from docengine.plans.records import FIELDS, page_stats

RECORD = ["image", *FIELDS]


def _in_order(order: str, value: Column) -> Column:
    """Values of a group in the order of a key."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))), lambda s: s["v"])


def _roi(box: tuple[float, ...]) -> Column:
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), box)])


def page_payloads(records: DataFrame, languages: str, next_line: bool, epoch: int, seconds: str | None = None) -> DataFrame:
    """One nested document per (file, page); records in the order of their images."""
    time = F.round(F.col(seconds), 4) if seconds else F.lit(0.0)
    total = F.sum(seconds) if seconds else F.lit(0.0)
    return records.groupBy("file", "page").agg(
        F.count("*").cast("int").alias("images_count"), F.lit(epoch).alias("generated_at_epoch"), F.lit(languages).alias("languages"), F.lit(next_line).alias("allow_next_line"),
        _roi(L.EPIC_ROI).alias("epic_roi"), _roi(L.SERIAL_ROIS[0]).alias("serial_roi"),
        F.struct(F.round(total, 4).alias("page_total_seconds"), F.round(total / F.count("*"), 4).alias("avg_seconds_per_image"), _in_order("image", time).alias("per_image_seconds")).alias("timing"),
        _in_order("image", F.struct(*RECORD)).alias("records"),
    )


def file_payloads(pages: DataFrame) -> DataFrame:
    """One nested document per file from its pages that have images."""
    kept = pages.where("images_count > 0")
    return kept.groupBy(F.col("file").alias("folder")).agg(
        F.count("*").cast("int").alias("pages_count"), F.sum("images_count").cast("int").alias("images_count"), F.first("languages").alias("languages"),
        F.first("allow_next_line").alias("allow_next_line"), _in_order("page", page_of_file()).alias("pages"),
    )


#: Order columns of a document's pieces: head, body, end; then the page and what is in it.
PIECE_ORDER = ["section", "page", "item"]


def _pieces(rows: DataFrame, path: Column, section: int, piece: Column, page: str | None = None, item: str | None = None) -> DataFrame:
    at = lambda c: (F.col(c) if c else F.lit("")).cast("string")
    return rows.select(path.alias("path"), F.lit(section).alias("section"), at(page).alias("page"), at(item).alias("item"), piece.alias("piece"))


def single(rows: DataFrame, path: Column) -> DataFrame:
    """Documents (.., markdown) of one piece each."""
    return _pieces(rows, path, 0, F.col("markdown"))


def page_documents(pages: DataFrame, path: Column) -> DataFrame:
    """Pieces of the page documents: each is one."""
    return _pieces(pages, path, 0, F.to_json(F.struct(*[c for c in pages.columns if c != "file"])))


def file_documents(pages: DataFrame, path: Column) -> DataFrame:
    """Pieces of the file documents: head, a piece for each page with images, end.

    Joined, a file's pieces are the JSON of its row in ``file_payloads``, but no row holds more
    than a page.  The first page of a file is told by a join on file and page, so a file with most of the
    pages is no hot key.
    """
    kept = pages.where("images_count > 0")
    sums = kept.groupBy("file").agg(
        F.count("*").cast("int").alias("pages_count"), F.sum("images_count").cast("int").alias("images_count"), F.first("languages").alias("languages"), F.first("allow_next_line").alias("allow_next_line"), F.min("page").alias("first"),
    )
    head = F.concat(F.regexp_replace(F.to_json(F.struct(F.col("file").alias("folder"), "pages_count", "images_count", "languages", "allow_next_line")), r"\}$", ""), F.lit(',"pages":['))
    body = F.concat(F.when(F.col("leads"), "").otherwise(","), F.to_json(page_of_file()))
    firsts = sums.select("file", F.col("first").alias("page"), F.lit(True).alias("leads"))
    marked = kept.join(firsts, ["file", "page"], "left").withColumn("leads", F.coalesce("leads", F.lit(False)))
    return _pieces(sums, path, 0, head).unionByName(_pieces(marked, path, 1, body, "page")).unionByName(_pieces(sums, path, 2, F.lit("]}")))


def page_of_file() -> Column:
    """A page as a file's document holds it."""
    return F.struct("page", F.col("images_count").alias("images_processed"), F.concat_ws("/", F.lit("page_wise"), F.concat(F.col("page"), F.lit(".json"))).alias("page_output_path"),
                    F.col("timing.page_total_seconds").alias("page_total_seconds"), F.col("timing.avg_seconds_per_image").alias("avg_seconds_per_image"), "records")


def _table_row(cells: list[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def page_markdown(records: DataFrame, languages: str, next_line: bool) -> DataFrame:
    """file, page, markdown: header, quick statistics and the table of records."""
    numbered = _in_order("image", F.struct(*RECORD))
    body = F.array_join(F.transform(F.col("rows"), lambda r, i: _table_row([
        (i + 1).cast("string"), md_escape(r["image"]), md_escape(r["serial_no"]), md_escape(r["epic_no"]), yes_no(r["epic_valid"]), md_escape(r["name"]), md_escape(r["relation_type"]),
        md_escape(r["relation_name"]), md_escape(r["house_no"]), md_escape(r["age"]), md_escape(r["gender"]),
    ])), "\n")
    stats = page_stats(records, ["file", "page"])
    tables = records.groupBy("file", "page").agg(numbered.alias("rows")).select("file", "page", body.alias("body"))
    of = lambda c: F.concat(F.col(c).cast("string"), F.lit("/"), F.col("total").cast("string"))
    text = F.concat_ws(
        "\n", F.lit("# OCR Preview"), F.lit(""), F.concat(F.lit("- **File**: "), md_escape(F.col("file"))), F.concat(F.lit("- **Page**: "), md_escape(F.col("page"))),
        F.concat(F.lit("- **Images**: "), F.col("total").cast("string")), F.lit(f"- **Languages**: {languages}"), F.lit(f"- **Allow next line**: {'Y' if next_line else 'N'}"),
        F.concat(F.lit("- **Records**: "), F.col("total").cast("string")), F.lit(""), F.lit("## Quick stats"), F.lit(""),
        F.concat(F.lit("- EPIC valid: "), of("epic_valid_count")), F.concat(F.lit("- Missing name: "), of("missing_name")), F.concat(F.lit("- Missing EPIC: "), of("missing_epic")),
        F.concat(F.lit("- Missing house no: "), of("missing_house")), F.concat(F.lit("- Missing age: "), of("missing_age")), F.concat(F.lit("- Missing gender: "), of("missing_gender")),
        F.lit(""), F.lit("## Records"), F.lit(""), F.lit("| # | image | serial | epic | epic_valid | name | relation_type | relation_name | house_no | age | gender |"),
        F.lit("|---:|---|---|---|:---:|---|---|---|---|---|---|"), F.col("body"), F.lit(""),
    )
    return stats.join(tables, ["file", "page"]).select("file", "page", text.alias("markdown"))


def _file_head() -> Column:
    """Header of a file's Markdown, up to the first row of its table."""
    return F.concat_ws(
        "\n", F.lit("# OCR Preview (File)"), F.lit(""), F.concat(F.lit("- **Folder**: "), md_escape(F.col("folder"))), F.concat(F.lit("- **Pages**: "), F.col("pages_count").cast("string")),
        F.concat(F.lit("- **Images**: "), F.col("images_count").cast("string")), F.concat(F.lit("- **Languages**: "), md_escape(F.col("languages"))),
        F.concat(F.lit("- **Allow next line**: "), yes_no(F.col("allow_next_line"))), F.lit(""), F.lit("## Pages"), F.lit(""),
        F.lit("| page | images_processed | avg_seconds_per_image | records | page_json |"), F.lit("|---|---:|---:|---:|---|"),
    )


def _file_row(p: Column) -> Column:
    return _table_row([md_escape(p["page"]), md_escape(p["images_processed"]), md_escape(p["avg_seconds_per_image"]), F.size(p["records"]).cast("string"), md_escape(p["page_output_path"])])


def file_markdown(files: DataFrame) -> DataFrame:
    """folder, markdown: header and the table of pages."""
    rows = F.array_join(F.transform("pages", _file_row), "\n")
    return files.select("folder", F.concat_ws("\n", _file_head(), rows, F.lit("")).alias("markdown"))


def file_markdown_pieces(pages: DataFrame, path: Column) -> DataFrame:
    """Pieces of the files' Markdown: the header, then a row for each page with images."""
    kept = pages.where("images_count > 0")
    sums = kept.groupBy("file").agg(F.count("*").alias("pages_count"), F.sum("images_count").alias("images_count"), F.first("languages").alias("languages"), F.first("allow_next_line").alias("allow_next_line"))
    head = _pieces(sums.withColumn("folder", F.col("file")), path, 0, F.concat(_file_head(), F.lit("\n")))
    return head.unionByName(_pieces(kept.withColumn("p", page_of_file()), path, 1, F.concat(_file_row(F.col("p")), F.lit("\n")), "page"))


def _line_list(words: DataFrame, image: list[str]) -> DataFrame:
    """image and the Markdown list of its lines."""
    named = W.lines(words, image, tie="word_num").withColumn(
        "item", F.format_string("- **b%d/p%d/l%d**: %s", "block_num", "par_num", "line_num", md_escape(F.col("line")))
    )
    key = F.struct(*W.LINE, "item")
    return named.groupBy(*image).agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda k: k["item"]), "\n").alias("items"))


def raw_text_markdown(words: DataFrame, image: list[str], languages: str, config: str) -> DataFrame:
    """file, page, image, markdown: the plain dump of an image, a list item per line."""
    text = F.concat_ws(
        "\n", F.concat(F.lit("## "), md_escape(F.col("page")), F.lit(" / "), md_escape(F.col("image"))), F.lit(""), F.concat(F.lit("- **File**: "), md_escape(F.col("file"))),
        F.lit(f"- **Languages**: {languages}"), F.lit(f"- **Tesseract config**: `{config}`"), F.lit(""), F.lit("### Text by line"), F.lit(""), F.col("items"), F.lit(""),
    )
    return _line_list(words, image).select(*image, text.alias("markdown"))


def _raw_head(languages: str, config: str) -> Column:
    return F.concat(F.lit("# Raw OCR (Text Only)\n\n- **File**: "), md_escape(F.col("file")), F.lit(f"\n- **Languages**: {languages}\n- **Tesseract config**: `{config}`\n"))


def raw_text_file(dumps: DataFrame, languages: str, config: str) -> DataFrame:
    """file, markdown: header and all dumps of a file in order; one aggregate instead of appends.

    A row holds a whole file; ``raw_text_pieces`` with an ordered sink does not.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page", "image", "markdown"))), lambda d: d["markdown"])
    return dumps.groupBy("file").agg(F.array_join(ordered, "").alias("all")).select("file", F.concat(_raw_head(languages, config), F.col("all")).alias("markdown"))


def raw_text_pieces(dumps: DataFrame, path: Column, languages: str, config: str) -> DataFrame:
    """Pieces of the files' raw dumps: the header, then each image's dump."""
    head = _pieces(dumps.select("file").distinct(), path, 0, _raw_head(languages, config))
    return head.unionByName(_pieces(dumps, path, 1, F.col("markdown"), "page", "image"))


def piece_index(pieces: DataFrame) -> DataFrame:
    """path, section, page, item, start and bytes of every piece: where it stands in its document.

    Starts are summed in two steps, over the pieces of a page and over the pages of a
    document, so a window holds a page's pieces or a document's pages, and of these only numbers.
    """
    sized = pieces.select("path", *PIECE_ORDER, F.coalesce(F.octet_length("piece"), F.lit(0)).cast("long").alias("bytes"))
    before = lambda w: F.coalesce(F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    group = ["path", "section", "page"]
    per_page = sized.groupBy(*group).agg(F.sum("bytes").alias("bytes"))
    per_page = per_page.select(*group, before(Window.partitionBy("path").orderBy("section", "page")).alias("ahead"))
    inside = sized.withColumn("inner", before(Window.partitionBy(*group).orderBy("item")))
    return inside.join(per_page, group).select("path", *PIECE_ORDER, (F.col("ahead") + F.col("inner")).alias("start"), "bytes")


def raw_detail_markdown(words: DataFrame, image: list[str], languages: str, config: str) -> DataFrame:
    """file, page, image, markdown: token count with blanks, confidence range, lines and the token table."""
    from docengine.functions.text import safe_int, strip

    conf = F.trim(F.col("conf").cast("string"))
    known = F.when(conf.isNotNull() & ~conf.isin("", "-1"), safe_int(F.col("conf")))
    cells = [F.col("i").cast("string"), md_escape(strip(F.col("text"))), *[md_escape(F.col(c)) for c in ("conf", "x", "y", "w", "h", "block_num", "par_num", "line_num", "word_num")]]
    row = F.struct("i", F.when(strip(F.col("text")) != "", _table_row(cells)).alias("row"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["row"]), "\n")
    stats = words.groupBy(*image).agg(F.count("*").alias("n"), F.min(known).alias("low"), F.max(known).alias("high"), rows.alias("rows"))
    text = F.concat_ws(
        "\n", F.lit("# Raw OCR Dump (Detailed)"), F.lit(""), F.concat(F.lit("- **File**: "), md_escape(F.col("file"))), F.concat(F.lit("- **Page**: "), md_escape(F.col("page"))),
        F.concat(F.lit("- **Image**: "), md_escape(F.col("image"))), F.lit(f"- **Languages**: {languages}"), F.lit(f"- **Tesseract config**: `{config}`"),
        F.concat(F.lit("- **Token rows**: "), F.col("n").cast("string")), F.when(F.col("low").isNotNull(), F.format_string("- **Conf (min..max)**: %d..%d", "low", "high")),
        F.lit(""), F.lit("## Text by line (as Tesseract tokens)"), F.lit(""), F.col("items"), F.lit(""), F.lit("## Tokens"), F.lit(""),
        F.lit("| i | text | conf | left | top | width | height | block | par | line | word |"), F.lit("|---:|---|---:|---:|---:|---:|---:|---:|---:|---:|---:|"), F.col("rows"), F.lit(""),
    )
    return stats.join(_line_list(words, image), image, "left").select(*image, text.alias("markdown"))
