"""Scalar functions, word fallbacks and record assembly against plain expectations."""

import random

import pytest
from pyspark.sql import functions as F

from docengine.functions import fields, labels as L, modeljson as J, text as T
from docengine.operators import geometry as G, pages as P, words as W
from docengine.plans import records as R, stages
from docengine.sources import config, pixels, providers


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).head()["x"]


@pytest.mark.parametrize(("raw", "want"), [("a8c 12", "ABC12"), ("01258OIZSB", "OIZ5801258"), ("ab", "AB"), ("", ""), ("x-y-z o", "XYZ0")])
def test_clean_epic(spark, raw, want):
    got = one(spark, T.clean_epic(F.col("v")), v=raw)
    assert got == want
    assert one(spark, T.clean_epic(F.col("v")), v=got) == got


@pytest.mark.parametrize(("readings", "want"), [(["007", "12"], "12"), (["", "0000"], "0000"), (["12345", "9"], "9"), (["1", "22", "3"], "22"), ([], "")])
def test_fold_serial(spark, readings, want):
    rows = spark.createDataFrame([(readings,)], "r array<string>")
    assert rows.select(T.fold_serial(F.col("r")).alias("x")).head()["x"] == want


@pytest.mark.parametrize(("lines", "want"), [(["Krishnan"], ""), (["Name : Krishnan"], "Kr"), (["Father Name : A", "Name - B -"], "B"), (["NAME :"], "")])
def test_name_lines(spark, lines, want):
    rows = spark.createDataFrame([(lines,)], "l array<string>")
    assert rows.select(fields.name_of(F.col("l")).alias("x")).head()["x"] == want


@pytest.mark.parametrize(("value", "compatible", "strict"), [("Female", "Male", "Female"), ("F", "Female", "Female"), ("Unknown", "Other", "Other"), ("ஆண்", "Male", "Male")])
def test_gender_modes(spark, value, compatible, strict):
    rows = spark.createDataFrame([([f"Gender : {value}"],)], "l array<string>")
    got = rows.select(fields.gender_of(F.col("l")).alias("a"), fields.gender_of(F.col("l"), strict=True).alias("b")).head()
    assert tuple(got) == (compatible, strict)


# A small list model of the word fallback, to hold the array expressions against.
def model_value(words, variants, most, next_line=True):
    def by_x(ws):
        return sorted(ws, key=lambda w: w["x"])

    def photo(ws):
        joined = "".join(T.match_py(w["text"]) for w in ws)
        return any(T.match_py(m) in joined for m in L.PHOTO_MARKERS)

    stops = [T.match_py(s) for s in L.STOP_LABELS]

    def stop(t):
        m = T.match_py(t)
        return bool(m) and any(s in m or m in s for s in stops)

    def joined(ws, start):
        out, n = [], 0
        for w in ws:
            t = w["text"]
            if w["x"] < start or t in L.LABEL_SEPARATORS:
                continue
            if stop(t) or t.endswith(":") and stop(t[:-1]) or n + len(t) + 1 > most:
                break
            out.append(t)
            n += len(t) + 1
        return " ".join(out)

    rows = {}
    for w in words:
        rows.setdefault(w["line_num"], []).append(w)
    for line in map(by_x, rows.values()):
        norm = [T.normalize_py(w["text"]) for w in line]
        for tokens in filter(None, map(fields.tokenize_label, variants)):
            for i in range(len(line) - len(tokens) + 1):
                if all(a and (a in b or b in a) for a, b in zip(norm[i:], tokens)):
                    first, last = line[i], line[i + len(tokens) - 1]
                    if photo(line):
                        return ""
                    value = joined(line, max(0, last["x"] + last["w"] - 5))
                    if value or not next_line:
                        return value
                    cut = first["y"] + int(first["h"] * 0.6)
                    below = [w for w in words if cut < w["y"] <= cut + 60]
                    near = by_x([w for w in below if abs(w["y"] - min(b["y"] for b in below)) <= 10]) if below else []
                    return "" if photo(near) else joined(near, 0)
    return ""


def test_word_fallback_matches_model(spark):
    r = random.Random(4)
    bag = ["Name", ":", "House", "No", "Number", "12/A", "Ravi", "Kumar", "Photo", "வீட்டு", "எண்", "-", "Age", "45", "Gender", "Male", "xyzzy", "Father", "பெயர்", "available", "q7"]
    images, rows = [], []
    for k in range(60):
        words = []
        for i in range(r.randrange(1, 14)):
            n = r.randrange(3)
            words.append({"i": i, "text": r.choice(bag), "x": r.randrange(6) * 40, "y": n * 25 + r.randrange(4), "w": 30, "h": 20, "line_num": n})
        images.append(words)
        rows += [(k, w["i"], w["text"], 90, w["x"], w["y"], w["w"], w["h"], 1, 1, w["line_num"]) for w in words]
    table = spark.createDataFrame(rows, "k int, i int, text string, conf int, x int, y int, w int, h int, block_num int, par_num int, line_num int")
    wanted = {"a_name": (L.NAME_LABELS, 80), "a_house": (L.HOUSE_LABELS, 12), "a_age": (L.AGE_LABELS, 6)}
    got = {r["k"]: r for r in fields.with_label_values(W.word_arrays(table, ["k"]), wanted).collect()}
    for k, words in enumerate(images):
        for c, (variants, most) in wanted.items():
            assert got[k][c] == model_value(words, variants, most), (k, c, words)


def test_confidence_keeps_unknown_and_tamil(spark):
    rows = spark.createDataFrame([("-1", "a"), ("19", "b"), ("20", "c"), ("3", "பெ"), ("zz", "d"), ("19.9", "e")], "conf string, text string")
    assert [x["text"] for x in rows.where(W.confident(F.col("conf"), F.col("text"))).collect()] == ["a", "c", "பெ", "d"]


def test_boxes_match_models(spark):
    r = random.Random(9)
    boxes = {(p, r.randrange(0, 60), r.randrange(0, 60), r.randrange(10, 40), r.randrange(10, 40)) for p in range(20) for _ in range(25)}
    table = spark.createDataFrame(sorted(boxes), "page int, x int, y int, w int, h int")
    kept, inner = {}, {}
    for p in range(20):
        own, out = sorted(b[1:] for b in boxes if b[0] == p), []
        for b in own:
            if not any(all(abs(s - t) < 6 for s, t in zip(b, k)) for k in out):
                out.append(b)
        kept[p] = sorted(out)
        big = []
        for x, y, w, h in sorted(own, key=lambda b: -b[2] * b[3]):
            if not any(x >= X + 6 and y >= Y + 6 and x + w <= X + W_ - 6 and y + h <= Y + H - 6 and w * h / (W_ * H) <= 0.7 for X, Y, W_, H in big):
                big.append((x, y, w, h))
        inner[p] = sorted(big)
    got = G.dedupe(table, ["page"]).collect()
    assert {p: sorted(tuple(g[1:]) for g in got if g[0] == p) for p in range(20)} == kept
    got = G.remove_contained(table, ["page"]).collect()
    assert {p: sorted(tuple(g[1:]) for g in got if g[0] == p) for p in range(20)} == inner


def test_pages(spark):
    rows = [("a", 1, True, 0.0, 0.0), ("b", 1, True, 0.01, 0.01), ("b", 2, True, 0.0, 0.0), ("c", 1, False, None, None), ("c", 2, False, None, None)] + [("d", i, True, 0.01, 0.001 * (i == 3)) for i in range(1, 9)]
    scores = spark.createDataFrame(rows, "file string, pos int, readable boolean, ink_ratio double, table_line_ratio double")
    assert sorted(tuple(x) for x in P.pick_pages(scores, ["file"]).collect()) == [("b", 2, 1, 1), ("c", 2, 1, 1), ("d", 8, 1, 3)]


@pytest.mark.parametrize(("text", "want"), [
    ('{"a":1}', {"a": 1}), ('```json\n{"a":"}"}\n```', {"a": "}"}), ('see {bad} then [1,{"x":"]"}] end', [1, {"x": "]"}]), ("12", 12), ('{"cut":', "none"), ("", "none"), ('{"a":"\\""} x', {"a": '"'}),
])
def test_first_json(text, want):
    value, ok = J.first_json(text)
    assert (value if ok else "none") == want


def test_cost_of_example(spark):
    got = one(spark, T.cost(F.lit(5518), F.lit(997), F.lit(0.2), F.lit(0.6), F.lit(True)))
    assert abs(got - 0.0017018) < 1e-12
    assert one(spark, T.cost(F.lit(1), F.lit(1), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(True))) is None


def test_config():
    got = config.parse_env("# x\nA = 'b=c'\n\nbad\nAI_INPUT_COST_PER_1M_USD=0.2\n")
    assert got == {"A": "b=c", "AI_INPUT_COST_PER_1M_USD": "0.2"}
    assert config.merged(got, {"A": "", "B": "1"}) == {"A": "b=c", "B": "1", "AI_INPUT_COST_PER_1M_USD": "0.2"}
    assert config.pricing(got)["input_cost_per_1m_tokens"] == 0.2
    with pytest.raises(ValueError):
        config.price({"x": "abc"}, "x")


def test_read_stage_with_stub(spark, tmp_path):
    from docengine.streaming import ingest

    body = "Name : Ravi\nFather Name : Kumar\nHouse No : 12\nAge : 45 Gender : Male"
    folder = tmp_path / "crops" / "f1" / "crops" / "page-001"
    folder.mkdir(parents=True)
    (folder / "page-001-001.png").write_text(body)
    (folder / "notes.txt").write_text("x")
    settings = config.Settings()
    query = ingest.records(ingest.crops(spark, str(tmp_path / "crops")), providers.StubOcr(), settings, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(x["file"], x["page"], x["image"], x["name"], x["relation_name"], x["house_no"], x["age"], x["gender"]) for x in rows] == [("f1", "page-001", "page-001-001.png", "Ravi", "Kumar", "12", "45", "Male")]


def test_page_score_finds_table():
    import numpy as np

    page = np.full((300, 300), 255, np.uint8)
    page[100, 20:280] = page[200, 20:280] = 0
    page[100:201, 20] = 0
    ink, table = providers.page_score(page)
    assert 0.005 < ink < 0.02 and table > 0.005
    assert pixels.grid_boxes(page)


def test_ask_stage_dry_run_and_answer(spark):
    scores = spark.createDataFrame([("f", 1, True, 0.01, 0.01), ("f", 2, True, 0.01, 0.01), ("g", 1, True, 0.01, 0.01), ("g", 2, True, 0.1, 0.1)], "file string, pos int, readable boolean, ink_ratio double, table_line_ratio double")
    pages = spark.createDataFrame([(f, p, "png", b"x") for f in "fg" for p in (1, 2)], "file string, pos int, ext string, content binary")
    done = spark.createDataFrame([("g",)], "file string")
    values = {"AI_INPUT_COST_PER_1M_USD": "0.2"}
    plan = stages.ask(pages, scores, done, providers.StubVision(), "p", values, config.Settings(dry_run=True)).collect()
    assert [(x["file"], x["front"], x["back"], x["provider"]) for x in plan] == [("f", 1, 2, "(default)")]
    got = stages.ask(pages, scores, done, providers.StubVision(), "p", values, config.Settings()).collect()
    assert len(got) == 1 and '"images":2' in got[0]["document"] and '"ai_metadata"' in got[0]["document"] and got[0]["error"] is None


def test_extract_stage_with_stub(spark, tmp_path):
    from docengine.sources import files

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.pdf").write_bytes(b"one\ftwo lines")
    (tmp_path / "in" / "c.pdf").write_bytes(b"z")
    (tmp_path / "in" / "d.txt").write_bytes(b"x")
    settings = config.Settings(extract="both")
    pages = stages.extract(spark, str(tmp_path / "in"), providers.StubPdf(), settings)
    images = stages.embedded_images(spark, str(tmp_path / "in"), providers.StubPdf(), settings)
    assert sorted((p["file"], p["name"], p["text"]) for p in pages.collect()) == [("a_b", "page-001.png", "one"), ("a_b", "page-002.png", "two lines"), ("c", "page-001.png", "z")]
    assert sorted(i["name"] for i in images.collect()) == ["page-001-img-01.bin", "page-001-img-01.bin", "page-002-img-01.bin"]
    made = {m["input_pdf"].rsplit("/", 1)[1]: m for m in files.manifests(pages, images).collect()}
    assert [made[k]["pages"] for k in sorted(made)] == [2, 1] and len(made[sorted(made)[0]]["images"]) == 2
    text = files.combined_text(pages.where("file = 'a_b'")).head()["text"]
    assert text["combined"] == "one\ntwo lines" and [p["chars"] for p in text["pages"]] == [3, 9]


def test_older_rules(spark):
    rows = [(1, i, t, 90, 60 * i, 0, 5 * len(t), 20, 1, 1, 1) for i, t in enumerate(["House", "No"])] + [(1, 5, "7/B", 90, 0, 300, 9, 20, 1, 1, 2)]
    table = spark.createDataFrame(rows, "k int, i int, text string, conf int, x int, y int, w int, h int, block_num int, par_num int, line_num int")
    images = W.word_arrays(table, ["k"])
    wanted = {"house": (L.HOUSE_LABELS, 80)}
    assert fields.with_label_values(images, wanted).head()["house"] == ""
    assert fields.with_label_values(images, wanted, margin=10, below=fields.following_line).head()["house"] == "7/B"
    assert images.select(fields.find_token(F.col("words"), ["no"])["text"].alias("t")).head()["t"] == "No"
    assert one(spark, T.clean_house_value(F.col("v"), longest=True), v="A7 1 22B") == "22B" and one(spark, T.clean_house_value(F.col("v"), longest=True), v="AB7") == "AB7"


def test_grid_records_and_text(spark):
    table = spark.createDataFrame([("i", "no 12", "ab8 12O", "N", "F", "12 o/a", "4 5", "female"), ("j", "", "", "", "", "", "", "zz")], "image string, serial string, epic string, name string, father_name string, house_no string, age string, gender string")
    got = {g["image"]: g for g in stages.grid_records(table).collect()}
    assert (got["i"]["serial_no"], got["i"]["epic_no"], got["i"]["house_no"], got["i"]["age"], got["i"]["gender"]) == ("12", "ABB120", "120/A", "45", "Male")
    assert "check EPIC" not in got["i"]["markdown"] and "check EPIC" not in got["j"]["markdown"] and got["j"]["gender"] == "zz"
    texts = spark.createDataFrame([(" a ", None), (" ", None), (None, "boom")], "t string, e string").select(stages.page_text(F.col("t"), F.col("e")).alias("x")).collect()
    assert [t["x"] for t in texts] == ["a", "[No text detected]", "[Error processing image: boom]"]
