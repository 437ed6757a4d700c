"""The four stages end to end: extract, crop, read, ask."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.functions import labels as L, modeljson as J, text as T
from docengine.operators import crops as C, geometry as G, pages as P, words as W
from docengine.plans import outputs as O, records as R
from docengine.sources import files as S, ordered, providers as V, scan as N
from docengine.sources.config import Settings, pricing


def documents(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """file, input_pdf and content of the first PDFs of a folder; only these are opened."""
    names = S.pdfs(spark, folder).select("path", "file")
    if not settings.limit or settings.limit < 0:
        return S.pdfs(spark, folder).select("file", F.col("path").alias("input_pdf"), "content")
    # One name may stand for several files; the limit is of names.
    chosen = P.first_folders(names, settings.limit)
    paths = [r["path"] for r in chosen.orderBy("file", "path").collect()]
    found = N.contents(spark, paths).select("path", "content").join(F.broadcast(chosen), "path")  # as many rows as the limit allows
    return found.select("file", F.col("path").alias("input_pdf"), "content")


def extract(spark: SparkSession, folder: str, provider: V.PdfProvider, settings: Settings) -> DataFrame:
    """Rendered pages (file, page, png, text, name) of the first PDFs of a folder, a task for each range of pages."""
    ranges = V.in_ranges(documents(spark, folder, settings), provider, settings.range_pages)
    return V.render(ranges, provider, settings.dpi).withColumn("name", S.rendered_name(F.col("page")))


def extracted(spark: SparkSession, folder: str, provider: V.PdfProvider, settings: Settings) -> DataFrame:
    """The files that the extraction writes, (path, payload): by ``settings.extract`` page images or embedded
    images or both, page texts and the combined text if ``settings.write_text``, and a manifest for each input."""
    pages = extract(spark, folder, provider, settings)
    images = embedded_images(spark, folder, provider, settings) if settings.extract in ("images", "both") else None
    stem = T.safe_stem(F.regexp_extract("input_pdf", "([^/]*)$", 1))
    at = lambda *parts: F.concat_ws("/", stem, *parts).alias("path")
    plain = lambda text: F.encode(text, "UTF-8").alias("payload")
    about = V.described(documents(spark, folder, settings).select("input_pdf", "content"), provider)
    made = S.manifests(pages, images, about)
    if settings.extract == "images":
        made = made.drop("rendered_pages")
    texts = S.combined_text(pages)
    out = [(made.join(texts, "input_pdf", "left") if settings.write_text else made)]
    out = [o.select(at(F.lit("manifest.json")), plain(F.to_json(F.struct(*o.columns)))) for o in out]
    if settings.extract in ("render", "both"):
        out.append(pages.select(at(F.lit("pages"), "name"), F.col("png").alias("payload")))
    if images is not None:
        out.append(images.select(at(F.lit("embedded_images"), "name"), "payload"))
    if settings.write_text:
        out.append(pages.select(at(F.lit("text"), F.format_string("page-%03d.txt", "page")), plain(F.col("text"))))
        out.append(texts.select(at(F.lit("text"), F.lit("combined.txt")), plain(F.col("text.combined"))))
    return reduce(DataFrame.unionByName, out)


def embedded_images(spark: SparkSession, folder: str, provider: V.PdfProvider, settings: Settings) -> DataFrame:
    """Embedded images (input_pdf, page, index, ext, width, height, size, payload, name); the mode "both" also renders."""
    rows = V.embedded(V.in_ranges(documents(spark, folder, settings), provider, settings.range_pages), provider)
    return rows.withColumn("name", S.embedded_name(F.col("page"), F.col("index"), F.col("ext")))


def boxes(found: DataFrame, page: list[str]) -> DataFrame:
    """Record boxes of pages from raw line structures, in reading order."""
    return G.reading_order(G.remove_contained(G.dedupe(found.where(G.plausible()), page), page), page)


def crop(metrics: DataFrame, page: list[str], settings: Settings) -> DataFrame:
    """Crops that are written, with their names; metrics come before the costly preprocessing."""
    kept = C.post_filter(C.select_crops(metrics, page, settings.diagram_filter), settings.diagram_filter)
    return C.crop_names(kept)


def cut_crops(pages: DataFrame, settings: Settings) -> DataFrame:
    """Crops with name, box, measures and PNG of pages (file, page, path_pos, png): boxes are found, then cut and judged.

    The boxes of a page are a few dozen, so they travel as an array to the page's image; only
    chosen crops keep their PNG.  A page that cannot be read has no crops.  The number of
    partitions is fixed, as a page of a few kilobytes costs seconds: by bytes, adaptive
    execution would put a thousand of them into one task.
    """
    spark = pages.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    key = ["file", "page", "path_pos"]
    sized = [*key, "width", "height"]
    placed = G.numbered(boxes(V.detect_boxes(pages.select(*key, "png")), sized), sized, F.col("width"), F.col("height"))
    per_page = placed.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("i", "x1", "y1", "x2", "y2"))).alias("boxes"))
    cut = V.cut_boxes(pages.select(*key, "png").repartition(parts, *key).join(per_page, key)).withColumns({"page_base": F.col("page"), "page_id": T.page_id(F.col("page"))})
    return crop(cut, ["file", "page"], settings)


def read(images: DataFrame, provider: V.OcrProvider, settings: Settings) -> DataFrame:
    """Records of (file, page, image, content): filters first, then one recognition call per crop."""
    chosen = P.first_pages(P.first_folders(P.only(images, settings.only_folder, settings.only_page), settings.limit), settings.limit_pages)
    key = ["file", "page", "image"]
    seen = V.recognise(chosen.select(*key, "content"), provider, settings.languages)
    words = seen.select(*key, F.posexplode("ocr").alias("i", "o")).select(*key, "i", "o.*")
    by_image = W.line_arrays(words, key).join(W.word_arrays(words, key, R.INDEX), key, "left")
    return R.assemble(seen.drop("ocr").join(by_image, key, "left"), settings.allow_next_line, settings.strict)


def output_pieces(records: DataFrame, settings: Settings, epoch: int, words: DataFrame | None = None, config: str = "") -> DataFrame:
    """Everything that the reading stage writes, as (path, section, page, item, piece).

    ``<file>/output/<file>.json`` and ``.md``, ``<file>/output/page_wise/<page>.json`` and ``.md``; with
    ``words`` (file, page, image, ..) also ``<file>/output/raw_ocr.md`` and ``<file>/output/raw_ocr/<page>/<image>.md``.
    """
    at = lambda *parts: F.concat(F.col("file"), F.lit("/output/"), *parts)
    pages = O.page_payloads(records, settings.languages, settings.allow_next_line, epoch)
    page = lambda ext: at(F.lit("page_wise/"), F.col("page"), F.lit(ext))
    made = [
        O.page_documents(pages, page(".json")), O.file_documents(pages, at(F.col("file"), F.lit(".json"))),
        O.single(O.page_markdown(records, settings.languages, settings.allow_next_line), page(".md")), O.file_markdown_pieces(pages, at(F.col("file"), F.lit(".md"))),
    ]
    if words is not None:
        key = ["file", "page", "image"]
        made.append(O.raw_text_pieces(O.raw_text_markdown(words, key, settings.languages, config), at(F.lit("raw_ocr.md")), settings.languages, config))
        stem = F.regexp_replace("image", r"\.[^.]*$", "")
        made.append(O.single(O.raw_detail_markdown(words, key, settings.languages, config), at(F.lit("raw_ocr/"), F.col("page"), F.lit("/"), stem, F.lit(".md"))))
    return reduce(DataFrame.unionByName, made)


def read_outputs(records: DataFrame, settings: Settings, epoch: int, folder: str, words: DataFrame | None = None, config: str = "") -> None:
    """Page and file documents as named JSON and Markdown files, by an ordered sink."""
    ordered.write(output_pieces(records, settings, epoch, words, config), folder, O.PIECE_ORDER)


def ask(pages: DataFrame, scores: DataFrame, done: DataFrame, provider: V.VisionProvider, prompt: str, values: dict, settings: Settings) -> DataFrame:
    """Metadata documents of folders without one: file, front, back, document, error, answer.

    ``pages`` has (file, pos, ext, content), ``scores`` (file, pos, readable, ink_ratio,
    table_line_ratio).  A dry run gives the plan: provider, model and endpoint.
    """
    todo = P.unfinished(P.first_folders(scores, settings.limit), done, settings.force)
    plan = P.pick_pages(todo, ["file"])
    name = (values.get("AI_PROVIDER") or "").strip().lower()
    base, model = L.BASE_URLS.get(name, L.BASE_URLS[""])
    base, model = values.get("AI_BASE_URL") or base, values.get("AI_MODEL") or model
    endpoint = T.sdk_base_url(F.lit(base))
    if settings.dry_run:
        return plan.withColumns({"provider": F.lit(name or "(default)"), "model": F.lit(model), "endpoint": endpoint})
    url = lambda side: pages.select("file", F.col("pos").alias(side), T.data_url(F.col("ext"), F.col("content")).alias(f"{side}_url"))
    asked = V.ask(plan.join(url("front"), ["file", "front"]).join(url("back"), ["file", "back"]).select("file", "front", "back", "front_url", "back_url"), provider, prompt)
    fixed = J.repair(asked, "answer")
    meta = J.ai_metadata(name or "openai", base, model, pricing(values), F.col("prompt_tokens"), F.col("completion_tokens"), F.col("total_tokens"))
    error = F.when(~F.col("parsed"), L.NO_JSON)
    return fixed.select("file", "front", "back", F.when(F.col("parsed"), J.merged(F.col("json"), meta)).alias("document"), error.alias("error"), "answer")


def sidecars(asked: DataFrame) -> DataFrame:
    """file and text of the failure file of folders whose answer held no JSON."""
    text = F.concat_ws("\n", F.concat(F.lit("ERROR: "), F.col("error")), F.concat(F.lit("front="), F.col("front").cast("string")), F.concat(F.lit("back="), F.col("back").cast("string")),
                       F.lit(""), F.lit("--- MODEL OUTPUT (raw) ---"), F.col("answer"))
    return asked.where("error is not null").select("file", text.alias("text"))


def answered(asked: DataFrame) -> DataFrame:
    """The files of the answers, (path, payload): a metadata document or a failure's sidecar for each folder."""
    good = asked.where("error is null").select(F.concat("file", F.lit(".json")).alias("path"), F.encode("document", "UTF-8").alias("payload"))
    bad = sidecars(asked).select(F.concat("file", F.lit(".raw.txt")).alias("path"), F.encode("text", "UTF-8").alias("payload"))
    return good.unionByName(bad)


def grid_records(readings: DataFrame) -> DataFrame:
    """Records of the fixed-grid layout from one raw reading per region, with their Markdown."""
    epic = T.clean_epic(F.col("epic"))
    rows = readings.select(
        "image", T.clean_digits(F.col("serial")).alias("serial_no"), epic.alias("epic_no"), "name", "father_name", T.clean_house(F.col("house_no")).alias("house_no"),
        T.clean_digits(F.col("age")).alias("age"), T.map_gender_raw(F.col("gender")).alias("gender"),
    )
    note = F.when(T.epic_valid(F.col("epic_no")) | (F.col("epic_no") == ""), "").otherwise("  *(check EPIC)*")
    text = F.concat(
        F.lit("- Serial No: **"), "serial_no", F.lit("**\n- EPIC No: **"), "epic_no", F.lit("**"), note, F.lit("\n- Name: "), "name", F.lit("\n- Father Name: "), "father_name",
        F.lit("\n- House No: "), "house_no", F.lit("\n- Age: "), "age", F.lit("\n- Gender: "), "gender", F.lit("\n"),
    )
    return rows.withColumn("markdown", text)


def page_text(text, error):
    """A whole crop's text: placeholders for nothing recognised and for failures."""
    return F.when(error.isNotNull(), F.concat(F.lit(L.READ_ERROR), error, F.lit("]"))).when(T.strip(F.coalesce(text, F.lit(""))) == "", L.NO_TEXT).otherwise(T.strip(text))
