"""The vectorised networks against plain loops, on random models."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docengine.llm import langid, toxicity

TEXTS = ["", "a", "ab cd", "One two three", "  spaced\tout\n", "é è ß 漢字 text", "the cat sat on the mat " * 40, "x" * 700]


@pytest.mark.parametrize("seed", [1, 2])
def test_language_network_by_loops(seed):
    model = langid.Model(["de", "en", "fr"], seed)
    model.bias = np.random.default_rng(seed).normal(0, 0.3, 3).astype(np.float32)
    names, scores = langid._predict(model, pa.array(TEXTS))
    for text, name, score in zip(TEXTS, names, scores, strict=True):
        data = bytes(32 if b in b"\t\n\v\f\r" else b + 32 if 65 <= b < 91 else b for b in text.encode())
        total, size = np.zeros(3), 0
        for at in range(0, len(data), langid.WINDOW):
            tile = data[at : at + langid.WINDOW]
            filled = tile + bytes(langid.WINDOW - len(tile))
            pooled = []
            for taps, width in zip(model.taps, langid.WIDTHS, strict=True):
                best = np.zeros(langid.FILTERS)
                for i in range(langid.WINDOW - width + 1):
                    best = np.maximum(best, sum(taps[k, filled[i + k]].astype(float) for k in range(width)))
                pooled.append(best)
            z = np.concatenate(pooled) @ model.dense + model.bias
            weight = sum(b != 0 for b in tile)
            total += (z - z.max() - np.log(np.exp(z - z.max()).sum())) * weight
            size += len(tile)
        mean = total / max(size, 1)
        p = np.exp(mean - mean.max()) / np.exp(mean - mean.max()).sum()
        if any(c.isalpha() for c in text):
            assert name == model.langs[int(p.argmax())] and abs(score - p.max()) < 1e-4
        else:
            assert name == "und" and score == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_toxicity_network_by_loops(seed):
    r = np.random.default_rng(seed)
    model = toxicity.Model(seed)
    model.out = r.normal(0, 0.3, len(model.out)).astype(np.float32)
    model.cuts = np.array([0.25], np.float32)
    hashes, first = toxicity._texts(TEXTS)
    got = model.scores(hashes, first)
    bucket = toxicity._buckets(hashes)
    for d in range(len(TEXTS)):
        words = [model.embedding[a].astype(float) + model.embedding[b] for a, b in bucket[first[d] : first[d + 1]]]
        features = []
        for taps, width in zip(model.filters, toxicity.WIDTHS, strict=True):
            best = np.zeros(toxicity.FILTERS)
            for i in range(len(words) - width + 1):
                best = np.maximum(best, sum(words[i + k] @ taps[k] for k in range(width)))
            features.append(best)
        z = np.concatenate(features) @ model.out + model.bias - model.cuts[0]
        assert abs(got[d] - 1 / (1 + np.exp(-z))) < 1e-4


def test_language_ignores_clashing_carried_names(spark):
    draw = random.Random(1)
    words = {"en": ["the", "cat", "house", "with"], "de": ["der", "Hund", "Haus", "mit"]}
    rows = [(i, " ".join(draw.choices(words[lang], k=12)), lang, "p", True, 0.5, i) for i, lang in ((i, ["en", "de"][i % 2]) for i in range(60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, held_out boolean, score double, more int")
    got = langid.language(docs, carry=["lang_pred", "held_out", "score", "more", "doc_id"])
    assert got.columns == ["doc_id", "more", "held_out", "lang_pred", "score"] and got.where(F.col("lang_pred").isin("en", "de")).count() == 60
