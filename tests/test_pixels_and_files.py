"""Pixel kernels, PNG files, region-wise recognition, crops end to end and named output files."""

import json
import os

import numpy as np
import pytest

from docengine.functions import labels as L
from docengine.plans import stages
from docengine.plans.fixtures import form
from docengine.sources import adapters, images, pixels, providers
from docengine.sources.config import Settings


@pytest.mark.parametrize("shape", [(5, 7), (4, 6, 3)])
def test_png_round_trip(shape):
    made = np.random.default_rng(1).integers(0, 256, shape).astype(np.uint8)
    assert (images.from_png(images.to_png(made)) == made).all()


def test_png_filters():
    import struct
    import zlib

    r = np.random.default_rng(2)
    want = r.integers(0, 256, (5, 4)).astype(np.int64)
    lines = b""
    for y in range(5):
        above = want[y - 1] if y else np.zeros(4, np.int64)
        left = np.concatenate([[0], want[y, :-1]])
        corner = np.concatenate([[0], above[:-1]])
        guess = [0 * left, left, above, (left + above) // 2, [min((a, b, c), key=lambda v: abs(a + b - c - v)) for a, b, c in zip(left, above, corner)]][y]
        lines += bytes([y]) + bytes(((want[y] - guess) & 255).astype(np.uint8))
    data = b"\x89PNG\r\n\x1a\n" + images._chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 5, 8, 0, 0, 0, 0)) + images._chunk(b"IDAT", zlib.compress(lines)) + images._chunk(b"IEND", b"")
    assert (images.from_png(data) == want).all()
    with pytest.raises(ValueError):
        images.from_png(b"none")


def test_kernels_on_known_images():
    page = form()
    assert pixels.adaptive_ink(page).any() and not pixels.adaptive_ink(np.full((50, 50), 255, np.uint8)).any()
    found = pixels.grid_boxes(page)
    assert sum(abs(w - 500) < 12 and abs(h - 300) < 12 for _, _, w, h, _ in found) == 6
    assert abs(pixels.skew(page[:600, :600])) <= 0.5
    assert pixels.enlarged(page[:20, :30], 2).shape == (40, 60)
    assert pixels.stretched(np.array([[10, 20]], np.uint8)).tolist() == [[0, 255]]
    dense, empty = pixels.crop_metrics(page[60:360, 40:540]), pixels.crop_metrics(np.full((300, 500), 255, np.uint8))
    assert dense["ink_frac"] > empty["ink_frac"] == 0 and dense["line_ratio"] > 0
    colour = np.repeat(page[:, :, None], 3, axis=2)
    drawn = pixels.outlined(colour)
    assert drawn.shape == colour.shape and (drawn != colour).any() and (drawn[-1] == colour[-1]).all()
    assert pixels.for_code(page[:30, :40]).shape == (60, 80) and set(np.unique(pixels.for_serial(page[60:160, 40:200]))) <= {0, 255}
    assert pixels.without_label(page, 0.25).shape[1] == page.shape[1] - int(page.shape[1] * 0.25)


def test_regions_are_read_one_by_one(spark):
    class Fake:
        """Tells what it is shown: the characters asked for and the image's size."""

        def setup(self):
            self.ready = True

        def line(self, gray, characters):
            return f"{len(characters)}:{gray.shape[1]}x{gray.shape[0]}"

        def words(self, gray, languages):
            return [{"text": languages, "conf": 90, "x": 1, "y": 2, "w": gray.shape[1], "h": gray.shape[0], "block_num": 1, "par_num": 1, "line_num": 1, "word_num": 1}]

    crop = form()[60:360, 40:540]
    own = adapters.RegionOcr(Fake(), 0.5)
    own.setup()
    got = own.read(images.to_png(crop), "eng")
    part = pixels.region(crop, L.EPIC_ROI)
    assert got["epic_raw"] == f"36:{2 * part.shape[1]}x{2 * part.shape[0]}"
    want = [pixels.region(crop, roi).shape for roi in L.SERIAL_ROIS]
    assert got["serial_raw"] == [f"10:{3 * w}x{3 * h}" for h, w in want for _ in range(3)]
    assert got["house_roi"].startswith("38:") and got["ocr"][0]["w"] == 500
    rows = spark.createDataFrame([("f", images.to_png(crop)), ("g", b"no image")], "file string, content binary")
    seen = {r["file"]: r for r in providers.recognise(rows, own, "eng").collect()}
    assert len(seen["f"]["serial_raw"]) == 12 and seen["f"]["error"] is None and seen["g"]["error"].startswith("OCR failed")


def test_crops_end_to_end(spark):
    rows = [("f", "page-001", 1, images.to_png(form())), ("f", "page-002", 2, images.to_png(form(rows=1))), ("f", "page-003", 3, b"broken"), ("f", "page-004", 4, None)]
    pages = spark.createDataFrame(rows, "file string, page string, path_pos int, png binary")
    got = stages.cut_crops(pages, Settings(diagram_filter="off")).collect()
    assert sorted(g["crop_name"] for g in got) == [f"page-001-00{i}.png" for i in range(1, 7)] + ["page-002-001.png", "page-002-002.png"]
    for g in got:
        cut = images.from_png(bytes(g["crop"]))
        assert cut.shape == (g["y2"] - g["y1"], g["x2"] - g["x1"]) and cut.min() == 0


def test_extracted_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.pdf").write_bytes(b"one\ftwo")
    for mode, names in (("render", {"pages"}), ("images", {"embedded_images"}), ("both", {"pages", "embedded_images"})):
        out = tmp_path / mode
        rows = stages.extracted(spark, str(tmp_path / "in"), providers.StubPdf(), Settings(extract=mode, write_text=True))
        written = providers.write_files(rows, out.as_uri()).collect()
        (top,) = os.listdir(out)
        assert set(os.listdir(out / top)) == names | {"manifest.json", "text"}
        assert (out / top / "text" / "combined.txt").read_text() == "one\ntwo" and (out / top / "text" / "page-002.txt").read_text() == "two"
        manifest = json.loads((out / top / "manifest.json").read_text())
        assert manifest["pages"] == 2 and manifest["text"]["combined"] == "one\ntwo" and ("rendered_pages" in manifest) == (mode != "images")
        assert sum(r["size"] for r in written) == sum(len(p.read_bytes()) for p in out.rglob("*") if p.is_file())


def test_answers_and_sidecars_are_named(spark, tmp_path):
    asked = spark.createDataFrame([("f1", 1, 5, '{"a":1}', None, '{"a":1}'), ("f2", 1, 4, None, "Could not parse", "no json")], "file string, front int, back int, document string, error string, answer string")
    providers.write_files(stages.answered(asked), tmp_path.as_uri()).collect()
    assert (tmp_path / "f1.json").read_text() == '{"a":1}'
    assert (tmp_path / "f2.raw.txt").read_text() == "ERROR: Could not parse\nfront=1\nback=4\n\n--- MODEL OUTPUT (raw) ---\nno json"


def test_http_vision_speaks_the_protocol():
    sent = []

    class Local(adapters.HttpVision):
        def send(self, body):
            sent.append(json.loads(body))
            return json.dumps({"choices": [{"message": {"content": "hi"}}], "usage": {"prompt_tokens": 3, "completion_tokens": None, "total_tokens": 3}}).encode()

    client = Local("http://localhost/x", "key", "m", as_object=True)
    client.setup()
    assert client.ask("do it", ["data:1", "data:2"]) == ("hi", {"prompt_tokens": 3, "completion_tokens": 0, "total_tokens": 3})
    assert sent[0]["messages"][0] == {"role": "system", "content": "do it"} and [c["type"] for c in sent[0]["messages"][1]["content"]] == ["text", "image_url", "image_url"]
    with pytest.raises(ValueError):
        adapters.HttpVision("u", "", "m").setup()
