"""Registered queries of the record engine, each over whole derived views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.functions import fields, labels as L, metadata, modeljson as J, text as T
from docengine.operators import crops as C, geometry as G, pages as P, words as W
from docengine.plans import fixtures as X, outputs as O, records as R, refresh, stages
from docengine.sources import files as S, scan as N
from docengine.sources.config import Settings


def _lines(spark, d):
    return X.record_lines(spark, d)


def _words(spark, d):
    return X.record_words(spark, d)


def _records(spark, d) -> DataFrame:
    """Records from lines only, with codes from the order of the key."""
    rows = R.with_line_fields(_lines(spark, d), F.col("lines"))
    epic = T.clean_epic(F.concat(F.lit("ab"), F.col("k").cast("string"), F.lit(" O1")))
    rows = rows.withColumn("epic_no", F.when(F.col("k") % 10 == 0, "").otherwise(epic)).withColumn("epic_valid", T.epic_valid(F.col("epic_no")))
    return rows.select(
        "k", "file", "page", "image", F.col("k").cast("string").alias("serial_no"), "epic_no", "epic_valid", "name", F.col("relation.type").alias("relation_type"),
        F.col("relation.name").alias("relation_name"), "house_no", "age", "gender",
    )


def page_report(spark, d):
    return R.page_stats(_records(spark, d), ["file", "page"])


def records(spark, d):
    return _records(spark, d)


def strict_gender(spark, d):
    return _lines(spark, d).select("k", fields.gender_of(F.col("lines"), strict=True).alias("gender"))


def files_safe_stem(spark, d):
    return X.view(spark, d, X.FILES).select("id", T.safe_stem(F.col("folder_name")).alias("safe_stem"))


def files_page_id(spark, d):
    return X.view(spark, d, X.FILES).select("id", T.page_id(F.col("stem")).alias("page_id"))


def _files(spark, d):
    return X.view(spark, d, X.FILES).withColumn("name", F.concat("stem", F.lit("."), "ext")).withColumn("path", F.concat_ws("/", "file", "kind", "name")).withColumn("page", T.page_id(F.col("stem")))


def files_page_images(spark, d):
    return S.page_images(_files(spark, d)).select("id", "path")


def files_crop_images(spark, d):
    return S.crop_images(_files(spark, d)).select("id", "path")


def files_scan_images(spark, d):
    return S.scan_images(_files(spark, d).withColumn("name", F.concat("name", F.lit("#"), F.col("id").cast("string")))).select("id", "file", "pos")


def files_folders(spark, d):
    rows = _files(spark, d)
    return S.folders_with(rows, "images").withColumn("kind", F.lit("images")).unionByName(S.folders_with(rows, "crops").withColumn("kind", F.lit("crops")))


def files_page_folders(spark, d):
    return S.page_folders(_files(spark, d))


def files_resolved(spark, d):
    return S.resolved(_files(spark, d), ["file", "page"]).select("id", "file", "page")


def files_names(spark, d):
    rows = X.view(spark, d, X.FILES)
    page, index = (F.col("id") % 1200).cast("int"), (F.col("id") % 150).cast("int")
    return rows.select("id", S.embedded_name(page, index, F.when(F.col("id") % 7 == 0, "").otherwise(F.lower("ext"))).alias("embedded"), S.rendered_name(page).alias("rendered"))


def files_combined_text(spark, d):
    rows = spark.read.parquet(f"{d}/conversations.parquet").select(F.col("conv_id").cast("string").alias("input_pdf"), F.col("turn").cast("int").alias("page"), F.col("text"))
    return S.combined_text(rows).select("input_pdf", F.length("text.combined").alias("n_combined"), F.md5("text.combined").alias("digest"), F.size("text.pages").alias("pages"), F.aggregate("text.pages", F.lit(0), lambda s, p: s + p["chars"]).alias("chars"))


def files_manifest(spark, d):
    pages = spark.read.parquet(f"{d}/conversations.parquet").select(F.col("conv_id").cast("string").alias("input_pdf"), F.col("turn").cast("int").alias("page")).distinct()
    ext = F.when(F.col("page") % 3 != 0, "png")
    images = pages.select("input_pdf", "page", F.lit(1).alias("index"), ext.alias("ext"), F.lit(8).alias("width"), F.lit(9).alias("height"), (F.col("page") % 4).alias("size"))
    return S.manifests(pages, images).select("input_pdf", "pages", F.array_join("rendered_pages", ",").alias("rendered"), F.array_join("images.path", ",").alias("images"))


def files_data_url(spark, d):
    return X.view(spark, d, X.FILES).select("id", T.data_url(F.concat(F.lit("."), "ext"), F.col("stem").cast("binary")).alias("url"))


def files_crop_names(spark, d):
    rows = _files(spark, d).where("kind <> 'text'")
    crops = rows.select("file", F.col("page").alias("page_id"), F.col("stem").alias("page_base"), F.col("id").alias("path_pos"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("i"))
    return C.crop_names(crops).select("file", "page_id", "path_pos", "i", "crop_name")


def files_chosen(spark, d):
    """What a run reads of a listing: limits of folders and pages, without the pages that are done."""
    rows = _files(spark, d)
    done = rows.where("id % 11 = 0").select("file", "page")
    return N.choose(S.crop_images(rows), Settings(limit=25, limit_pages=6), done).select("id", "file", "page", "path")


def files_crop_names_again(spark, d):
    """Names of crops beside what an earlier run has left."""
    rows = _files(spark, d).where("kind <> 'text'")
    crops = rows.select("file", F.col("page").alias("page_id"), F.col("stem").alias("page_base"), F.col("id").alias("path_pos"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("i"))
    return C.crop_names(crops, C.crop_names(crops.where("path_pos % 3 = 0"))).select("file", "page_id", "path_pos", "i", "crop_name")


def pages_changed(spark, d):
    """Pages that are new, changed or gone since the last runs of a ledger."""
    rows = X.view(spark, d, X.RECORDS).select("file", "page", F.col("image").alias("name"), F.col("k").alias("length"), F.lit(0).alias("modificationTime"), "k")
    before = rows.where("file <> 'file-1'").withColumn("length", F.col("length") + F.when((F.col("k") % 170 == 3), 1).otherwise(0))
    moved = rows.where("k % 37 = 0").withColumn("page", F.concat("page", F.lit("-old")))
    first = refresh.fingerprints(before.unionByName(moved)).withColumn("run", F.lit(1).cast("long"))
    second = first.where("file = 'file-2'").withColumns({"images": F.lit(0), "fingerprint": F.lit(""), "run": F.lit(2).cast("long")})
    return refresh.changes(refresh.fingerprints(rows), first.unionByName(second))


def words_confident(spark, d):
    return X.doc_words(spark, d).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(W.confident(F.col("conf"), F.col("text")) & (T.strip(F.col("text")) != "")).alias("n_usable"))


def words_lines(spark, d):
    return W.lines(X.doc_words(spark, d, gathered=True), ["doc_id"]).select("doc_id", "line_num", F.md5("line").alias("line"))


def words_group_lines(spark, d):
    shuffled = X.doc_words(spark, d, gathered=True).withColumn("x", F.floor(F.col("x") / 50).cast("int"))
    return W.lines(shuffled, ["doc_id"], tie="word_num").groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def words_exploded(spark, d):
    packed = X.doc_word_arrays(spark, d).withColumnRenamed("x", "left")
    weighed = F.sum(F.col("i").cast("long") * F.col("x"))
    return W.explode_words(packed, ["doc_id"], ["text", "conf", "left"]).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("i").alias("last"), weighed.alias("weighed"), F.sum("conf").alias("conf"))


def words_next_line(spark, d):
    rows = _words(spark, d).where("text <> ''")
    packed = W.word_arrays(rows, ["k"])
    below = fields.next_visual_line(F.col("words"), F.get("words", F.lit(0)))
    return packed.select("k", F.array_join(F.transform(below, lambda w: w["text"]), " ").alias("line"))


def words_older_label(spark, d):
    return _word_arrays(spark, d).select("k", fields.find_token(F.col("words"), L.HOUSE_LABELS)["i"].alias("i"))


def _word_arrays(spark, d):
    return W.word_arrays(_words(spark, d), ["k"], R.INDEX)


def words_label_span(spark, d):
    span = fields.find_span(fields.visual_lines(F.col("words")), L.HOUSE_LABELS)
    return _word_arrays(spark, d).select("k", span.alias("s")).select("k", F.col("s.first.i").alias("first"), F.col("s.last.i").alias("last"))


def words_join_value(spark, d):
    return _word_arrays(spark, d).select("k", fields.join_value(F.filter("words", lambda w: w["line_num"] == 3), F.lit(60), 24).alias("value"))


def words_fields(spark, d):
    rows = R.with_word_fields(_word_arrays(spark, d))
    return rows.select("k", "name", "house_no", "age", "gender", F.col("relation.type").alias("relation_type"), F.col("relation.name").alias("relation_name"))


def words_records(spark, d):
    lines = _lines(spark, d).select("k", "file", "page", "image", "lines")
    images = lines.join(_word_arrays(spark, d), "k", "left")
    k = F.col("k").cast("string")
    images = images.withColumns({
        "epic_raw": F.concat(F.lit("xy8 "), k), "serial_raw": F.array(F.lit("0"), F.substring(k, -2, 2)), "serial_fallback": k,
        "house_roi": F.concat(F.lit("12o/"), k), "error": F.when(F.col("k") % 97 == 0, "OCR failed: x"),
    })
    return R.assemble(images).drop("file", "page", "image")


def codes_epic(spark, d):
    epic = T.clean_epic(F.col("raw"))
    return X.view(spark, d, X.CODES).select("k", epic.alias("epic_no"), T.epic_valid(epic).alias("epic_valid"))


def codes_serial(spark, d):
    return X.view(spark, d, X.CODES).select("k", T.clean_serial(F.col("raw")).alias("serial"), T.fold_serial(F.array("r0", "r1", "r2")).alias("folded"))


def codes_numbers(spark, d):
    return X.view(spark, d, X.CODES).select("k", T.safe_int(F.col("number")).alias("number"), T.clean_digits(F.col("raw")).alias("digits"), T.clean_house(F.col("raw")).alias("house"))


def text_normalized(spark, d):
    rows = X.view(spark, d, X.RECORDS)
    return rows.select("k", T.normalize_text(F.col("l0")).alias("n0"), T.norm_for_match(F.col("l2")).alias("m2"), T.normalize_line(F.col("l0")).alias("line"), T.strip_name_label(F.col("l0")).alias("bare"), T.md_escape(F.concat("l0", F.lit("|"), "l2", F.lit("\r\n "))).alias("md"))


def text_markers(spark, d):
    rows = X.view(spark, d, X.RECORDS)
    return rows.select("k", T.has_photo_marker(F.col("l0")).alias("photo"), T.is_stop_token(F.col("l2")).alias("stop"), T.yes_no(F.col("k") % 2 == 0).alias("yn"))


def text_value_after_colon(spark, d):
    rows = X.view(spark, d, X.RECORDS)
    return rows.select("k", T.value_after_colon(F.col("l0"), L.NAME_PATTERN).alias("name"), T.value_after_colon(F.col("l2"), L.HOUSE_PATTERN).alias("house"))


def text_house_value(spark, d):
    rows = X.view(spark, d, X.RECORDS)
    return rows.select("k", T.clean_house_value(F.col("l2")).alias("house"), T.map_gender(F.col("l3")).alias("gender"), T.map_gender_raw(F.col("l3")).alias("gender_raw"))


def text_urls(spark, d):
    url = F.concat(F.when(F.col("id") % 3 == 0, " ").otherwise(""), F.lit("https://h/v1"), F.when(F.col("id") % 2 == 0, "/openai").otherwise(""), F.when(F.col("id") % 5 == 0, "/chat/completions").otherwise(""), F.when(F.col("id") % 7 == 0, "//").otherwise(""))
    rows = X.view(spark, d, X.FILES).withColumn("url", F.when(F.col("id") % 11 == 0, " ").otherwise(url))
    return rows.select("id", T.chat_url(F.col("url")).alias("chat"), T.sdk_base_url(F.col("url")).alias("base"))


def boxes_plausible(spark, d):
    return X.view(spark, d, X.BOXES).where(G.plausible()).groupBy("page").agg(F.count("*").alias("n"), F.sum("x").alias("x"))


def boxes_deduped(spark, d):
    return G.dedupe(X.view(spark, d, X.BOXES), ["page"])


def boxes_contained(spark, d):
    return G.remove_contained(X.view(spark, d, X.BOXES), ["page"])


def boxes_order(spark, d):
    return G.reading_order(X.view(spark, d, X.BOXES).distinct(), ["page"]).select("page", "x", "y", "w", "h", "n_vertices", "row_id", F.min("ord").over(_same_box()).alias("ord"))


def _same_box():
    from pyspark.sql import Window

    return Window.partitionBy("page", "x", "y", "w", "h")


def boxes_numbered(spark, d):
    ordered = X.view(spark, d, X.BOXES).distinct().groupBy("page", "x", "y", "w", "h").agg(F.max("n_vertices").alias("n_vertices"))
    return G.numbered(G.reading_order(ordered, ["page"]), ["page"], F.lit(700), F.lit(900)).select("page", "i", "x1", "y1", "x2", "y2")


def boxes_detected(spark, d):
    """Plausible, then without duplicates, then without nested boxes, then in reading order."""
    found = X.view(spark, d, X.BOXES).where(G.plausible())
    return G.reading_order(G.remove_contained(G.dedupe(found, ["page"]), ["page"]), ["page"])


def boxes_scaled(spark, d):
    return X.view(spark, d, X.BOXES).select("page", *[G.scaled(F.col(c), F.lit(2.5)).alias(c) for c in "xywh"])


def boxes_region(spark, d):
    return X.view(spark, d, X.BOXES).select("page", "w", "h", *[c.alias(n) for n, c in G.region(L.SERIAL_ROIS[0], F.col("w"), F.col("h")).items()])


def crops_cut(spark, d):
    """From page images to crops: lines, boxes, reading order, cut, measures, names."""
    cut = stages.cut_crops(X.forms(spark, d), Settings(diagram_filter="off"))
    return cut.select("file", "page", "path_pos", "i", "crop_name")


def _crop_stats(rows):
    return rows.groupBy("page").agg(F.count("*").alias("n"), F.sum("i").alias("i"))


def crops_strict(spark, d):
    return _crop_stats(C.select_crops(X.view(spark, d, X.METRICS), ["page"], "on"))


def crops_auto(spark, d):
    return _crop_stats(C.select_crops(X.view(spark, d, X.METRICS), ["page"], "auto"))


def crops_post(spark, d):
    return _crop_stats(C.post_filter(C.select_crops(X.view(spark, d, X.METRICS), ["page"], "off")))


def pages_back(spark, d):
    return P.pick_pages(X.view(spark, d, X.SCORES), ["folder"])


def pages_limit(spark, d):
    return P.first_folders(_lines(spark, d), 3).groupBy("file").agg(F.count("*").alias("n"))


def pages_limit_pages(spark, d):
    return P.first_pages(P.only(_lines(spark, d), folder="file-3"), 2).groupBy("file", "page").agg(F.count("*").alias("n"))


def pages_resume(spark, d):
    rows = _lines(spark, d)
    done = rows.where("page = 'page-7' and k % 7 = 0").select("file").distinct()
    return P.unfinished(rows, done).groupBy("file").agg(F.count("*").alias("n"))


def pages_dry_run(spark, d):
    """The plan of the metadata stage without a call: folder, front, back, provider."""
    return P.pick_pages(X.view(spark, d, X.SCORES), ["folder"]).withColumn("provider", F.lit("(default)"))


def model_cost(spark, d):
    rows = X.view(spark, d, X.USAGE)
    price = lambda c: F.col(c).cast("double")
    return rows.select("k", T.cost(F.col("prompt_tokens"), F.col("completion_tokens"), price("input_cost"), price("output_cost"), F.col("has_usage")).alias("cost"))


def model_json(spark, d):
    return J.repair(X.view(spark, d, X.RESPONSES)).select("event_id", "parsed", F.get_json_object("json", "$.k").alias("value"))


def model_documents(spark, d):
    rows = J.repair(X.view(spark, d, X.RESPONSES)).where("parsed")
    meta = J.ai_metadata("p", "https://h/", "m", {"currency": "USD", "input_cost_per_1m_tokens": 0.2, "output_cost_per_1m_tokens": 0.6}, F.lit(5518), F.lit(997), F.lit(6515))
    doc = J.merged(F.col("json"), meta)
    return rows.select("event_id", F.get_json_object(doc, "$.ai_metadata.model").alias("model"), F.get_json_object(doc, "$.ai_metadata.usage.total_tokens").alias("tokens"), F.get_json_object(doc, "$.data[0]").alias("data"))


def model_failures(spark, d):
    """Answers that hold no JSON."""
    return J.repair(X.view(spark, d, X.RESPONSES)).where("not parsed").select("event_id", "content")


def _asked(spark, d):
    rows = J.repair(X.view(spark, d, X.RESPONSES)).withColumn("file", F.col("event_id").cast("string"))
    return rows.select("file", F.lit(1).alias("front"), (F.col("event_id") % 5 + 2).alias("back"), F.col("json").alias("document"), F.when(~F.col("parsed"), L.NO_JSON).alias("error"), F.col("content").alias("answer"))


def model_sidecars(spark, d):
    """The failure files of answers that hold no JSON."""
    return stages.sidecars(_asked(spark, d))


def model_files(spark, d):
    """Names of the files of all answers: a document, or a sidecar."""
    return stages.answered(_asked(spark, d)).select("path")


def grid_records(spark, d):
    """Records and Markdown of the fixed-grid layout."""
    k = F.col("k").cast("string")
    gender = F.when(F.col("k") % 4 == 0, "female").when(F.col("k") % 4 == 1, "ஆண்").when(F.col("k") % 4 == 2, " x ").otherwise("")
    rows = X.view(spark, d, X.CODES).select(
        k.alias("image"), F.col("r0").alias("serial"), F.col("raw").alias("epic"), F.concat(F.lit("N"), k).alias("name"), F.lit("F").alias("father_name"), F.col("raw").alias("house_no"),
        F.col("number").alias("age"), gender.alias("gender"),
    )
    return stages.grid_records(rows)


def page_texts(spark, d):
    """Whole-crop texts with the placeholders for nothing read and for failures."""
    text = F.when(F.col("k") % 3 == 0, " ").otherwise(F.concat("raw", F.lit(" ")))
    error = F.when(F.col("k") % 7 == 0, F.concat(F.lit("boom "), F.col("k").cast("string")))
    return X.view(spark, d, X.CODES).select("k", stages.page_text(text, error).alias("text"))


def output_pages(spark, d):
    p = O.page_payloads(_records(spark, d), "eng+tam", True, 0)
    return p.select("file", "page", "images_count", F.col("epic_roi.x1").alias("x1"), F.array_join(F.transform("records", lambda r: F.concat_ws(",", r["image"], r["epic_no"], r["house_no"])), ";").alias("records"))


def output_files(spark, d):
    f = O.file_payloads(O.page_payloads(_records(spark, d), "eng+tam", True, 0))
    return f.select("folder", "pages_count", "images_count", F.array_join(F.transform("pages", lambda p: F.concat_ws(":", p["page"], F.size(p["records"]).cast("string"))), ";").alias("pages"))


def output_page_markdown(spark, d):
    return O.page_markdown(_records(spark, d), "eng+tam", True)


def output_file_markdown(spark, d):
    return O.file_markdown(O.file_payloads(O.page_payloads(_records(spark, d), "eng+tam", True, 0))).select("folder", "markdown")


def _image_words(spark, d):
    return _words(spark, d).withColumn("file", F.concat(F.lit("f"), F.floor(F.col("k") / 500).cast("string"))).withColumn("page", F.concat(F.lit("p"), (F.col("k") % 50).cast("string"))).withColumn("image", F.col("k").cast("string"))


def output_raw_text(spark, d):
    return O.raw_text_markdown(_image_words(spark, d), ["file", "page", "image"], "eng", "--psm 6")


def output_raw_detail(spark, d):
    return O.raw_detail_markdown(_image_words(spark, d), ["file", "page", "image"], "eng", "--psm 6").select("image", "markdown")


def output_raw_file(spark, d):
    return O.raw_text_file(output_raw_text(spark, d), "eng", "--psm 6").select("file", F.length("markdown").alias("chars"), F.md5("markdown").alias("digest"))


def stats_timing(spark, d):
    rows = X.view(spark, d, X.RECORDS).withColumn("seconds", F.col("k") % 64 / F.lit(8.0))
    return R.timing(rows, ["file", "page"])


def stats_run(spark, d):
    rows = X.view(spark, d, X.RECORDS).withColumn("seconds", F.col("k") % 64 / F.lit(8.0))
    files = R.timing(rows, ["file"])
    return files.agg(F.count("*").alias("files"), F.sum("images_processed").alias("images"), F.round(F.sum("total_seconds") / F.sum("images_processed"), 4).alias("avg_seconds"))


def stats_levels(spark, d):
    """Totals of the run, of its files and of their pages."""
    rows = X.view(spark, d, X.RECORDS).select("file", "page", (F.col("k") % 64 / F.lit(8.0)).alias("seconds"), F.when(F.col("k") % 9 == 0, "failed").alias("error"))
    return R.levels(rows)


def output_raw_index(spark, d):
    """Where each image's dump stands in its file's document, without a row for the file."""
    pieces = O.raw_text_pieces(output_raw_text(spark, d), F.concat("file", F.lit(".md")), "eng", "--psm 6")
    return O.piece_index(pieces).select("path", "page", F.col("item").alias("image"), "start", "bytes")


def model_typed(spark, d):
    """Typed fields of metadata documents of both layouts, and the fields that do not fit."""
    rows = metadata.typed(X.view(spark, d, X.METADATA))
    return rows.select(
        "k", "parsed", F.col("document_metadata.electoral_roll_year").alias("year"), F.col("document_metadata.page_number_current").alias("page"),
        F.col("constituency_details.assembly_constituency_number").alias("assembly"), F.col("authority_verification.signature_present").cast("string").alias("signed"),
        F.col("detailed_elector_summary.net_total.total").alias("electors"), F.array_join(F.transform("misfit", lambda m: F.concat(m["path"], F.lit("="), m["value"])), ";").alias("misfit"),
    )


QUERIES = {
    "page_report": page_report, "records": records, "strict_gender": strict_gender,
    **{f.__name__: f for f in (
        files_safe_stem, files_page_id, files_page_images, files_crop_images, files_scan_images, files_folders, files_page_folders, files_resolved, files_names, files_combined_text, files_manifest,
        files_data_url, files_crop_names, words_confident, words_lines, words_group_lines, words_exploded, words_next_line, words_label_span, words_join_value, words_fields, words_records, words_older_label,
        codes_epic, codes_serial, codes_numbers, text_normalized, text_markers, text_value_after_colon, text_house_value, text_urls, boxes_plausible, boxes_deduped, boxes_contained,
        boxes_order, boxes_numbered, boxes_detected, boxes_scaled, boxes_region, crops_strict, crops_auto, crops_post, crops_cut, pages_back, pages_limit, pages_limit_pages, pages_resume, pages_dry_run,
        model_cost, model_json, model_documents, model_failures, model_sidecars, model_files, grid_records, page_texts, output_pages, output_files, output_page_markdown, output_file_markdown, output_raw_text, output_raw_detail, output_raw_file,
        stats_timing, stats_run, files_chosen, files_crop_names_again, pages_changed, stats_levels, output_raw_index, model_typed,
    )},
}
