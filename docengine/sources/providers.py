"""Leaf operations behind pluggable providers: PDF pages, pixels, recognition, vision models.

A provider's work runs in ``mapInPandas`` on the executors, with ``setup`` once per
partition.  The adapters for optional libraries import them when used and are not
exercised here; the stubs are deterministic, for tests and dry runs.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from docengine.sources.images import from_png, to_png

WORDS = "array<struct<text:string,conf:int,x:int,y:int,w:int,h:int,block_num:int,par_num:int,line_num:int,word_num:int>>"
OCR_SCHEMA = f"epic_raw string, serial_raw array<string>, serial_fallback string, house_roi string, ocr {WORDS}, error string"
PAGE_SCHEMA = "page int, png binary, text string"
IMAGE_SCHEMA = "page int, index int, ext string, width int, height int, size int, payload binary"
SCORE_SCHEMA = "readable boolean, ink_ratio double, table_line_ratio double"
ANSWER_SCHEMA = "answer string, prompt_tokens int, completion_tokens int, total_tokens int"


class PdfProvider(Protocol):
    """``first`` and ``last`` are page numbers from 1, both included."""

    def setup(self) -> None: ...
    def count(self, content: bytes) -> int: ...
    def metadata(self, content: bytes) -> dict[str, str]: ...
    def pages(self, content: bytes, dpi: int, first: int, last: int) -> list[tuple[int, bytes, str]]: ...
    def images(self, content: bytes, first: int, last: int) -> list[tuple[int, int, str, int, int, bytes]]: ...


class OcrProvider(Protocol):
    def setup(self) -> None: ...
    def read(self, content: bytes, languages: str) -> dict: ...


class VisionProvider(Protocol):
    def setup(self) -> None: ...
    def ask(self, prompt: str, images: list[str]) -> tuple[str, dict | None]: ...


class StubPdf:
    """One page per form feed of the content read as text."""

    def setup(self) -> None:
        pass

    def count(self, content: bytes) -> int:
        return content.count(b"\f") + 1

    def metadata(self, content: bytes) -> dict[str, str]:
        """A first page that is one line ``Title: ..`` names the title."""
        head = content.split(b"\f")[0].decode("utf-8", "replace")
        return {"title": head[7:].strip()} if head.startswith("Title: ") else {}

    def _parts(self, content: bytes, first: int, last: int) -> list[tuple[int, bytes]]:
        return list(enumerate(content.split(b"\f"), 1))[first - 1 : last]

    def pages(self, content: bytes, dpi: int, first: int, last: int) -> list[tuple[int, bytes, str]]:
        return [(i, hashlib.sha256(part + bytes([dpi % 256])).digest(), part.decode("utf-8", "replace")) for i, part in self._parts(content, first, last)]

    def images(self, content: bytes, first: int, last: int) -> list[tuple[int, int, str, int, int, bytes]]:
        return [(i, 1, "", len(part), 1, part) for i, part in self._parts(content, first, last)]


class FitzPdf:
    """PyMuPDF."""

    def setup(self) -> None:
        import fitz

        self.fitz = fitz

    def _open(self, content: bytes):
        return self.fitz.open(stream=content, filetype="pdf")

    def count(self, content: bytes) -> int:
        with self._open(content) as doc:
            return doc.page_count

    def metadata(self, content: bytes) -> dict[str, str]:
        with self._open(content) as doc:
            return {k: str(v) for k, v in (doc.metadata or {}).items() if v}

    def pages(self, content: bytes, dpi: int, first: int, last: int) -> list[tuple[int, bytes, str]]:
        zoom = dpi / 72
        with self._open(content) as doc:
            return [(i, doc[i - 1].get_pixmap(matrix=self.fitz.Matrix(zoom, zoom), alpha=False).tobytes("png"), doc[i - 1].get_text()) for i in range(first, last + 1)]

    def images(self, content: bytes, first: int, last: int) -> list[tuple[int, int, str, int, int, bytes]]:
        out = []
        with self._open(content) as doc:
            for i in range(first, last + 1):
                for k, entry in enumerate(doc[i - 1].get_images(full=True), 1):
                    found = doc.extract_image(entry[0]) or {}
                    out.append((i, k, found.get("ext") or "", found.get("width") or 0, found.get("height") or 0, found.get("image") or b""))
        return out


class StubOcr:
    """Recognises the content as UTF-8 text: a line of text is a line, a space a word gap."""

    def setup(self) -> None:
        pass

    def read(self, content: bytes, languages: str) -> dict:
        lines = content.decode("utf-8").split("\n")
        words = [
            {"text": t, "conf": 90, "x": 60 * p, "y": 30 * n, "w": 5 * len(t), "h": 20, "block_num": 1, "par_num": 1, "line_num": n, "word_num": p + 1}
            for n, line in enumerate(lines) for p, t in enumerate(line.split(" "))
        ]
        return {"epic_raw": lines[0] if lines else "", "serial_raw": [], "serial_fallback": "", "house_roi": "", "ocr": words}


class NoProvider:
    """For work that needs none."""

    def setup(self) -> None:
        pass


class StubVision:
    def setup(self) -> None:
        pass

    def ask(self, prompt: str, images: list[str]) -> tuple[str, dict | None]:
        return '```json\n{"images": %d}\n```' % len(images), {"prompt_tokens": len(prompt), "completion_tokens": 10, "total_tokens": len(prompt) + 10}


def _schema(df: DataFrame, drop: set[str], more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in drop] + [more])


def _spread(df: DataFrame, provider, drop: set[str], more: str, work) -> DataFrame:
    """``work(provider, row)`` gives the new columns of each row's results; small batches, as rows are images."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider.setup()
        for frame in frames:
            rows = [{k: v for k, v in row.items() if k not in drop} | made for row in frame.to_dict("records") for made in work(provider, row)]
            if rows:
                yield pd.DataFrame(rows)

    return df.mapInPandas(run, _schema(df, drop, more))


def page_ranges(provider: PdfProvider, size: int):
    """A table function over a document's bytes: a row (pages, first, last) for each range of ``size`` pages."""

    class Ranges:
        def __init__(self) -> None:
            provider.setup()

        def eval(self, content: bytes):
            n = provider.count(bytes(content))
            for first in range(1, n + 1, size):
                yield n, first, min(first + size - 1, n)

    return udtf(Ranges, returnType="pages int, first int, last int")


def in_ranges(pdfs: DataFrame, provider: PdfProvider, size: int, key: str = "input_pdf") -> DataFrame:
    """Documents (.., content) as page ranges, dealt out by document and first page.

    A document of many pages is work for many tasks; its bytes go along with each range, so a
    range has enough pages (``size``) to make rendering, not shuffling, the cost.  A document
    without pages has no range.
    """
    parts = max(int(pdfs.sparkSession.conf.get("spark.sql.shuffle.partitions")), pdfs.sparkSession.sparkContext.defaultParallelism)
    ranged = pdfs.lateralJoin(page_ranges(provider, size)(F.col("content").outer()))
    return ranged.repartition(parts, key, "first")


def render(ranges: DataFrame, provider: PdfProvider, dpi: int = 200) -> DataFrame:
    """Page images and texts of ranges (.., content, pages, first, last)."""

    def work(p: PdfProvider, row: dict) -> list[dict]:
        return [{"page": n, "png": png, "text": text} for n, png, text in p.pages(bytes(row["content"]), dpi, row["first"], row["last"])]

    return _spread(ranges, provider, {"content", "pages", "first", "last"}, PAGE_SCHEMA, work)


def embedded(ranges: DataFrame, provider: PdfProvider) -> DataFrame:
    """Non-empty images embedded in the pages of ranges (.., content, pages, first, last)."""
    names = ["page", "index", "ext", "width", "height"]

    def work(p: PdfProvider, row: dict) -> list[dict]:
        return [dict(zip(names, i)) | {"size": len(i[5]), "payload": i[5]} for i in p.images(bytes(row["content"]), row["first"], row["last"])]

    return _spread(ranges, provider, {"content", "pages", "first", "last"}, IMAGE_SCHEMA, work).where("size > 0")


def described(pdfs: DataFrame, provider: PdfProvider) -> DataFrame:
    """The set entries of the documents' own metadata, map<string,string>, of (.., content)."""
    return _spread(pdfs, provider, {"content"}, "metadata map<string,string>", lambda p, row: [{"metadata": {k: v for k, v in p.metadata(bytes(row["content"])).items() if v}}])


def recognise(crops: DataFrame, provider: OcrProvider, languages: str) -> DataFrame:
    """Everything read from a crop in one call; a failure is a row with its error."""

    def work(p: OcrProvider, row: dict) -> list[dict]:
        try:
            return [p.read(bytes(row["content"]), languages) | {"error": None}]
        except Exception as e:
            return [{"epic_raw": "", "serial_raw": [], "serial_fallback": "", "house_roi": "", "ocr": [], "error": f"OCR failed: {e}"}]

    return _spread(crops, provider, {"content"}, OCR_SCHEMA, work)


def _readable(png: bytes | None) -> np.ndarray | None:
    try:
        return from_png(bytes(png or b""))
    except (ValueError, zlib.error):
        return None


def detect_boxes(pages: DataFrame) -> DataFrame:
    """Connected line structures (x, y, w, h, n_vertices) and the size of each readable page (.., png)."""

    def work(_, row: dict) -> list[dict]:
        from docengine.sources.pixels import grid_boxes, to_gray

        page = _readable(row["png"])
        if page is None:
            return []
        return [dict(zip(("x", "y", "w", "h", "n_vertices"), box)) | {"width": page.shape[1], "height": page.shape[0]} for box in grid_boxes(to_gray(page))]

    return _spread(pages, NoProvider(), {"png"}, "x int, y int, w int, h int, n_vertices int, width int, height int", work)


def cut_boxes(pages: DataFrame) -> DataFrame:
    """A row for each of the boxes array<struct<i, x1, y1, x2, y2>> of a page (.., png, boxes): corners, measures and the crop as PNG."""

    def work(_, row: dict) -> list[dict]:
        from docengine.sources.pixels import crop_metrics, edges, preprocess, share_of

        page, out = _readable(row["png"]), []
        for box in row["boxes"] if page is not None else []:
            box = box if isinstance(box, dict) else box.asDict()
            own = page[box["y1"] : box["y2"], box["x1"] : box["x2"]]
            out.append(box | crop_metrics(own) | {"post_edge_frac": share_of(edges(preprocess(own))), "crop": to_png(own)})
        return out

    more = "i int, x1 int, y1 int, x2 int, y2 int, ink_frac double, line_ratio double, small_components int, largest_cc_ratio double, edge_frac double, post_edge_frac double, crop binary"
    return _spread(pages, NoProvider(), {"png", "boxes"}, more, work)


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """Write (path, payload) below ``folder``, a file a row, from the executors; gives path and size.

    ``folder`` is a path or URI that Arrow's file systems know and that executors share.  A
    repeated task writes the same bytes again, so a lost executor does no harm.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for frame in frames:
            for path, payload in zip(frame["path"], frame["payload"]):
                store.create_dir(f"{root}/{path}".rpartition("/")[0], recursive=True)
                with store.open_output_stream(f"{root}/{path}") as out:
                    out.write(bytes(payload or b""))
            yield pd.DataFrame({"path": frame["path"], "size": [len(p or b"") for p in frame["payload"]]})

    return rows.select("path", "payload").mapInPandas(run, "path string, size long")


def ask(folders: DataFrame, provider: VisionProvider, prompt: str) -> DataFrame:
    """Answers for (.., front_url, back_url)."""

    def work(p: VisionProvider, row: dict) -> list[dict]:
        text, usage = p.ask(prompt, [row["front_url"], row["back_url"]])
        return [{"answer": text} | {k: (usage or {}).get(k) for k in ("prompt_tokens", "completion_tokens", "total_tokens")}]

    return _spread(folders, provider, {"front_url", "back_url"}, ANSWER_SCHEMA, work)


def ask_once(questions: DataFrame, provider: VisionProvider, prompt: str) -> DataFrame:
    """Like ``ask``; a call that fails is a row with its error and no answer."""

    def work(p: VisionProvider, row: dict) -> list[dict]:
        none = dict.fromkeys(("answer", "prompt_tokens", "completion_tokens", "total_tokens"))
        try:
            text, usage = p.ask(prompt, [row["front_url"], row["back_url"]])
        except Exception as e:
            return [none | {"error": f"{type(e).__name__}: {e}"}]
        return [none | {"answer": text, "error": None} | {k: (usage or {}).get(k) for k in ("prompt_tokens", "completion_tokens", "total_tokens")}]

    return _spread(questions, provider, {"front_url", "back_url"}, f"{ANSWER_SCHEMA}, error string", work)


def otsu(gray: np.ndarray) -> int:
    """The threshold with the largest variance between classes."""
    share = np.bincount(gray.ravel(), minlength=256) / gray.size
    weight, mean = np.cumsum(share), np.cumsum(share * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mean[-1] * weight - mean) ** 2 / (weight * (1 - weight))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def opened(mask: np.ndarray, length: int, axis: int) -> np.ndarray:
    """Pixels of straight runs of ``length`` or more along an axis: morphological opening by a line."""
    rows = mask if axis == 0 else mask.T
    if length > len(rows):
        return np.zeros_like(mask, bool)

    def pieces(found: np.ndarray, join) -> np.ndarray:
        """From single pixels to pieces of ``length``, by doubling."""
        size = 1
        while size < length:
            step = min(size, length - size)
            found = join(found, step)
            size += step
        return found

    whole = pieces(rows.astype(bool), lambda m, k: m[:-k] & m[k:])  # a run begins here
    out = np.zeros_like(rows, bool)
    out[: len(whole)] = whole

    def spread(m: np.ndarray, k: int) -> np.ndarray:
        wider = m.copy(order="K")
        wider[k:] |= m[:-k]
        return wider

    out = pieces(out, spread)
    return out if axis == 0 else out.T


def page_score(gray: np.ndarray) -> tuple[float, float]:
    """Share of ink and of straight lines after Otsu's threshold."""
    ink = gray <= otsu(gray)
    h, w = ink.shape
    lines = opened(ink, max(20, w // 30), 1) | opened(ink, max(20, h // 30), 0)
    return float(ink.mean()), float(lines.mean())


def score_pages(images: DataFrame) -> DataFrame:
    """readable, ink_ratio and table_line_ratio of rows with Spark's ``image`` struct."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema if f.name != "image"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                i = row.pop("image")
                try:
                    pixels = np.frombuffer(i["data"], np.uint8).reshape(i["height"], i["width"], i["nChannels"]).astype(np.float64)
                    gray = pixels[:, :, 0] if pixels.shape[2] == 1 else pixels[:, :, :3] @ np.array([0.114, 0.587, 0.299])
                    ink, table = page_score(np.rint(gray).astype(np.uint8))
                    out.append(row | {"readable": True, "ink_ratio": ink, "table_line_ratio": table})
                except (TypeError, ValueError):
                    out.append(row | {"readable": False, "ink_ratio": None, "table_line_ratio": None})
            yield pd.DataFrame(out)

    return images.mapInPandas(run, ", ".join([*kept, SCORE_SCHEMA]))
