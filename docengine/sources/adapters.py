"""Providers for real backends: region-wise recognition, Tesseract, HTTP vision models.

``RegionOcr`` is the whole recognition of a crop over any ``Recogniser``: one reading for the
code, four regions in three binarisations for the serial number, a fallback reading, the house
region without its label, and the words.  Optional libraries are imported in ``setup``.
"""

from __future__ import annotations

import json
import urllib.request
from typing import Protocol

import numpy as np

from docengine.functions import labels as L
from docengine.sources import pixels as X
from docengine.sources.images import from_png
from docengine.sources.providers import otsu

# Characters that a reading of each field may have.
CODE_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
DIGITS = "0123456789"
HOUSE_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789/-"


class Recogniser(Protocol):
    def setup(self) -> None: ...
    def line(self, gray: np.ndarray, characters: str) -> str: ...
    def words(self, gray: np.ndarray, languages: str) -> list[dict]: ...


def serial_images(part: np.ndarray) -> list[np.ndarray]:
    """The three binarised forms in which a serial region is read: by one threshold, by local ones, and turned over."""
    large = X.enlarged(X.to_gray(part), 3)
    soft = X.blurred(large)
    local = np.where(X.adaptive_ink(large, 31, 8), 0, 255)
    turned = 255 - large
    return [x.astype(np.uint8) for x in (np.where(soft > otsu(soft), 255, 0), local, np.where(turned > otsu(turned), 255, 0))]


class RegionOcr:
    """Everything read from a crop (a PNG), region by region."""

    def __init__(self, recogniser: Recogniser, label_share: float = 0.0):
        self.recogniser, self.label_share = recogniser, label_share

    def setup(self) -> None:
        self.recogniser.setup()

    def read(self, content: bytes, languages: str) -> dict:
        pixels, line = from_png(content), self.recogniser.line
        part = lambda roi: X.region(pixels, roi)
        house = X.without_label(part(L.HOUSE_ROI), self.label_share)
        return {
            "epic_raw": line(X.for_code(part(L.EPIC_ROI)), CODE_CHARACTERS),
            "serial_raw": [line(image, DIGITS) for roi in L.SERIAL_ROIS for image in serial_images(part(roi))],
            "serial_fallback": line(X.for_serial(part(L.SERIAL_ROIS[0])), DIGITS),
            "house_roi": line(X.for_code(house), HOUSE_CHARACTERS),
            "ocr": self.recogniser.words(X.to_gray(pixels), languages),
        }


class Tesseract:
    """The Tesseract engine through pytesseract; ``setup`` fails where either is missing."""

    def setup(self) -> None:
        import pytesseract
        from PIL import Image

        pytesseract.get_tesseract_version()
        self.engine, self.image = pytesseract, Image.fromarray

    def line(self, gray: np.ndarray, characters: str) -> str:
        text = self.engine.image_to_string(self.image(gray), lang="eng", config=f"--oem 1 --psm 7 -c tessedit_char_whitelist={characters}")
        return " ".join(text.split())

    def words(self, gray: np.ndarray, languages: str) -> list[dict]:
        data = self.engine.image_to_data(self.image(gray), lang=languages, config="--oem 1 --psm 6", output_type=self.engine.Output.DICT)
        names = {"x": "left", "y": "top", "w": "width", "h": "height"}
        number = lambda v: int(float(v)) if str(v).strip() else -1
        fields = ("conf", "x", "y", "w", "h", "block_num", "par_num", "line_num", "word_num")
        return [{"text": t} | {f: number(data[names.get(f, f)][i]) for f in fields} for i, t in enumerate(data["text"])]


class HttpVision:
    """A chat endpoint that takes images, with the standard library's client."""

    def __init__(self, url: str, key: str, model: str, timeout: float = 120.0, as_object: bool = False):
        self.url, self.key, self.model, self.timeout, self.as_object = url, key, model, timeout, as_object

    def setup(self) -> None:
        if not self.key:
            raise ValueError("the endpoint needs a key")

    def payload(self, prompt: str, images: list[str]) -> dict:
        content = [{"type": "text", "text": "Front page and back page images."}, *[{"type": "image_url", "image_url": {"url": u}} for u in images]]
        made: dict = {"model": self.model, "messages": [{"role": "system", "content": prompt}, {"role": "user", "content": content}]}
        return made | ({"response_format": {"type": "json_object"}} if self.as_object else {})

    def send(self, body: bytes) -> bytes:
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"}
        with urllib.request.urlopen(urllib.request.Request(self.url, body, headers), timeout=self.timeout) as answer:
            return answer.read()

    def ask(self, prompt: str, images: list[str]) -> tuple[str, dict | None]:
        got = json.loads(self.send(json.dumps(self.payload(prompt, images)).encode()))
        try:
            text = str(got["choices"][0]["message"]["content"])
        except (KeyError, IndexError, TypeError) as e:
            raise RuntimeError(f"the answer has another shape: {e}") from e
        usage = got.get("usage")
        return text, {k: int(usage.get(k) or 0) for k in ("prompt_tokens", "completion_tokens", "total_tokens")} if isinstance(usage, dict) else None
