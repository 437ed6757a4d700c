"""Toxicity: a convolutional text classifier in numpy.

Words are hashed to VOCABULARY embeddings; filters of several widths slide over them, the
maximum over the whole text is pooled, and a logistic layer scores it.  A word of a text
never depends on the text's length: the whole text is scanned, in slices of bounded bytes.

The model is fitted on the driver on at most POSITIVE + NEGATIVE labelled rows outside the
held-out fold (folds.excerpt bounds the bytes of a sampled text).  Its size is fixed (VOCABULARY x SIZE floats and small layers), so the
broadcast is bounded.  The threshold of each language is calibrated on a part of the sample
that training does not see, if that part has ENOUGH toxic rows of it; the others share one.
The language is guessed from the text alone (hashed-word naive Bayes, learned from the same
sample), so lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.llm.folds import held_out, release, sample
from docengine.llm.textkit import LOWER_CODES, buffers, hash_spans, slices, words

VOCABULARY = 1 << 17
SIZE = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
POSITIVE = 2000
NEGATIVE = 4000
EPOCHS = 6
STEM = 4  # bytes of a word that its second hash takes, for inflected words
LANG_VOCABULARY = 1 << 16
ENOUGH = 20  # toxic calibration rows a language needs for a threshold of its own

#: Words are runs of letters, digits and bytes beyond ASCII.
GAPS = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    GAPS[_a:_b] = False


def encode(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of each word and its stem, first word of each text) for bounded slices of a text column."""
    raw, off = buffers(column)
    for i, j in slices(off, 1 << 20):
        part, at = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        starts, ends, first = words(part, at, GAPS)
        whole = hash_spans(part, starts, ends, LOWER_CODES)
        stem = hash_spans(part, starts, np.minimum(ends, starts + STEM), LOWER_CODES) ^ np.uint64(0x5DEECE66D)
        yield np.stack([whole, stem], axis=1), first


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(VOCABULARY - 1)).astype(np.int32)


def _pool(values: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Maximum over each text's windows, at least 0 (which is what texts without a window get)."""
    docs = len(first) - 1
    count = np.maximum(np.diff(first) - width + 1, 0)
    out = np.zeros((docs, values.shape[1]), np.float32)
    full = np.flatnonzero(count)
    if len(full):
        bounds = np.empty(2 * len(full), np.int64)
        bounds[0::2], bounds[1::2] = first[full], first[full] + count[full]
        padded = np.concatenate([values, np.zeros((width, values.shape[1]), np.float32)])
        out[full] = np.maximum(np.maximum.reduceat(padded, bounds)[0::2], 0)
    return out


class Model:
    """Embeddings, filters, output layer, thresholds."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.embedding = r.normal(0, 0.05, (VOCABULARY, SIZE)).astype(np.float32)
        self.filters = [r.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[:, 0, :] += 1.0 / len(f)
        self.out = np.full(FILTERS * len(WIDTHS), 0.15, np.float32)
        self.bias = np.float32(-1.0)
        self.langs: list[str] = []
        self.lang_table = np.zeros((LANG_VOCABULARY, 1), np.float32)
        self.lang_prior = np.zeros(1, np.float32)
        self.cuts = np.zeros(1, np.float32)

    def embed(self, bucket: np.ndarray) -> np.ndarray:
        return self.embedding[bucket[:, 0]] + self.embedding[bucket[:, 1]]

    def convolve(self, hashes: np.ndarray) -> list[np.ndarray]:
        x = self.embed(_buckets(hashes))
        out = []
        for f in self.filters:
            n = max(len(x) - len(f) + 1, 0)
            y = np.zeros((n, FILTERS), np.float32)
            for k in range(len(f)):
                y += x[k : k + n] @ f[k]
            out.append(y)
        return out

    def features(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.concatenate([_pool(y, first, w) for y, w in zip(self.convolve(hashes), WIDTHS)], axis=1)

    def logits(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.features(hashes, first) @ self.out + self.bias

    def language(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Index of the guessed language of each text; 0 where there is no word."""
        if len(self.langs) < 2:
            return np.zeros(len(first) - 1, np.int64)
        rows = self.lang_table[(hashes[:, 0] >> np.uint64(40)).astype(np.int64) & (LANG_VOCABULARY - 1)]
        total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)])
        return np.argmax(total[first[1:]] - total[first[:-1]] + self.lang_prior, axis=1)

    def scores(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        shifted = self.logits(hashes, first) - self.cuts[self.language(hashes, first)]
        return 1 / (1 + np.exp(-np.clip(shifted.astype(np.float64), -30, 30)))


def _texts(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts, firsts, at = [], [np.zeros(1, np.int64)], 0
    for hashes, first in encode(pa.array(values, pa.string())):
        parts.append(hashes)
        firsts.append(first[1:] + at)
        at += len(hashes)
    return (np.concatenate(parts) if parts else np.zeros((0, 2), np.uint64)), np.concatenate(firsts)


def _log_odds(buckets: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Smoothed log odds of each bucket's presence in toxic texts, from counts by text."""
    has = np.zeros((2, VOCABULARY), np.float32)
    for b, label in zip(buckets, y):
        has[int(label), np.unique(b)] += 1
    share = (has.sum(0) + 1e-9) / max(len(y), 1)
    odds = np.log((has[1] + 4 * share + 0.05) / (y.sum() + 4)) - np.log((has[0] + 4 * share + 0.05) / ((1 - y).sum() + 4))
    seen = has.sum(0)
    return (odds * seen / (seen + 8)).clip(-1, 4)


def fit(texts: list[str], labels: list[int], langs: list[str | None], seed: int = 5) -> Model:
    """Train on four fifths of the rows and calibrate on the rest."""
    model = Model(seed)
    if not texts:
        return model
    r = np.random.default_rng(seed)
    hashes, first = _texts(texts)
    bucket = _buckets(hashes)
    y = np.array(labels, np.float32)
    order = r.permutation(len(y))
    check, train = order[: len(y) // 5], order[len(y) // 5 :]
    _fit_language(model, hashes, first, langs, y, check)
    train = np.array([d for d in train if first[d + 1] > first[d]], np.int64)
    if not len(train) or y[train].min() == y[train].max():
        model.bias = np.float32(-3 if not y.sum() else 3)
        model.out[:] = 0
        return model
    model.embedding[:, 0] = _log_odds([bucket[first[d] : first[d + 1]] for d in train], y[train])
    weight = np.where(y == 1, 0.5 / y[train].mean(), 0.5 / (1 - y[train].mean())).astype(np.float32)
    store = {"out": np.full_like(model.out, 1e-3), "bias": 1e-3, "e": np.full((VOCABULARY, 1), 1e-3, np.float32), "f": [np.full_like(f, 1e-3) for f in model.filters]}
    for _ in range(EPOCHS):
        train = r.permutation(train)
        for i in range(0, len(train), 32):
            _step(model, store, [bucket[first[d] : first[d + 1]] for d in train[i : i + 32]], y[train[i : i + 32]], weight[train[i : i + 32]])
    _calibrate(model, hashes, first, y, check if len(check) > 50 else order)
    return model


def _step(model: Model, store: dict, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float = 0.05) -> None:
    """One Adagrad step; the gradient of a maximum flows to the window that has it."""
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    flat = np.concatenate(docs)
    x = model.embed(flat)
    pooled, where = [], []
    for f, w in zip(model.filters, WIDTHS):
        n = max(len(x) - w + 1, 0)
        z = np.zeros((n, FILTERS), np.float32)
        for k in range(w):
            z += x[k : k + n] @ f[k]
        best = np.zeros((len(docs), FILTERS), np.float32)
        at = np.full((len(docs), FILTERS), -1, np.int64)
        for d in range(len(docs)):
            a, b = first[d], first[d + 1] - w + 1
            if b > a:
                j = z[a:b].argmax(axis=0)
                best[d], at[d] = z[a:b][j, np.arange(FILTERS)], a + j
        at[best <= 0] = -1
        pooled.append(np.maximum(best, 0))
        where.append(at)
    h = np.concatenate(pooled, axis=1)
    p = 1 / (1 + np.exp(-np.clip(h @ model.out + model.bias, -30, 30)))
    g = (p - y) * weight / len(y)
    to_h = g[:, None] * model.out[None, :]
    grad = h.T @ g + 1e-4 * model.out
    store["out"] += grad**2
    model.out -= rate * grad / np.sqrt(store["out"])
    store["bias"] += g.sum() ** 2
    model.bias -= np.float32(rate * g.sum() / np.sqrt(store["bias"]))
    rows, grads = [], []
    for q, (f, at) in enumerate(zip(model.filters, where)):
        d, c = np.nonzero(at >= 0)
        j, e = at[d, c], to_h[d, q * FILTERS + c]
        change = np.zeros_like(f)
        for k in range(len(f)):
            np.add.at(change[k].T, c, e[:, None] * x[j + k])
            rows += [flat[j + k, 0], flat[j + k, 1]]
            grads += [e[:, None] * f[k].T[c]] * 2
        store["f"][q] += change**2
        model.filters[q] = f - rate * change / np.sqrt(store["f"][q])
    if rows:
        ids, back = np.unique(np.concatenate(rows), return_inverse=True)
        total = np.zeros((len(ids), SIZE), np.float32)
        np.add.at(total, back, np.concatenate(grads))
        store["e"][ids] += (total**2).mean(axis=1, keepdims=True)
        model.embedding[ids] -= rate * total / np.sqrt(store["e"][ids])


def _fit_language(model: Model, hashes: np.ndarray, first: np.ndarray, langs: list[str | None], y: np.ndarray, check: np.ndarray) -> None:
    """Naive Bayes over the languages with a threshold of their own; all other rows are the last class."""
    toxic, clean = ([langs[d] for d in check if y[d] == k] for k in (1, 0))
    model.langs = [*sorted(x for x in set(toxic) if x and toxic.count(x) >= ENOUGH and x in clean), ""]
    model.cuts = np.zeros(len(model.langs), np.float32)
    if len(model.langs) < 2:
        return
    table = np.zeros((LANG_VOCABULARY, len(model.langs)), np.float64)
    n = np.full(len(model.langs), 0.5)
    at = (hashes[:, 0] >> np.uint64(40)).astype(np.int64) & (LANG_VOCABULARY - 1)
    for d, x in enumerate(langs):
        k = model.langs.index(x) if x in model.langs else len(model.langs) - 1
        table[:, k] += np.bincount(at[first[d] : first[d + 1]], minlength=LANG_VOCABULARY)
        n[k] += 1
    model.lang_table = np.log((table + 0.1) / (table.sum(0) + 0.1 * LANG_VOCABULARY)).astype(np.float32)
    model.lang_prior = np.log(n / n.sum()).astype(np.float32)


def _cut(logits: np.ndarray, y: np.ndarray, prior: float) -> float:
    """The logit cut with the best F1 on the calibration rows, halfway to the next lower logit; ties go to the one nearest ``prior``."""
    order = np.argsort(-logits, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + max(y.sum(), 1))
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    z = logits[order]
    cuts = (z[best] + np.append(z, z[-1] - 1)[best + 1]) / 2
    return float(cuts[np.argmin(np.abs(cuts - prior))])


def _judged(model: Model, hashes: np.ndarray, first: np.ndarray, rows: np.ndarray, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Logits and guessed languages of some texts, a few at a time, so that memory does not follow the sample."""
    logits, langs = [], []
    for i in range(0, len(rows), step):
        own = [hashes[first[d] : first[d + 1]] for d in rows[i : i + step]]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        flat = np.concatenate(own)
        logits.append(model.logits(flat, bounds))
        langs.append(model.language(flat, bounds))
    return np.concatenate(logits), np.concatenate(langs)


def _calibrate(model: Model, hashes: np.ndarray, first: np.ndarray, y: np.ndarray, rows: np.ndarray) -> None:
    logits, lang = _judged(model, hashes, first, rows)
    pooled = _cut(logits, y[rows], 0.0)
    model.cuts = np.full(max(len(model.langs), 1), pooled, np.float32)
    for k in range(len(model.langs)):
        own = lang == k
        if ENOUGH <= y[rows][own].sum() < own.sum():
            model.cuts[k] = _cut(logits[own], y[rows][own], pooled)


def train(docs: DataFrame, labels: DataFrame, positive: int = POSITIVE, negative: int = NEGATIVE) -> Model:
    """A model from a bounded sample of the labelled rows outside the held-out fold."""
    rows = labels.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    pos = sample(rows.where("toxic = 1"), docs, positive, "lang")
    neg = sample(rows.where("toxic = 0"), docs, negative, "lang")
    rows = pos + neg
    model = fit([r["text"] for r in rows], [1] * len(pos) + [0] * len(neg), [r["lang"] for r in rows])
    del pos, neg, rows
    release()
    return model


def scorer(spark: SparkSession, model: Model):
    """A vectorised function of a text column: each text's score; a null text is scored like an empty one."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        parts = [shared.value.scores(h, f) for h, f in encode(text)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score


def toxicity(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of every row of ``docs``.

    Null and empty texts have the score of a text without words; very long texts are scored
    whole.  Repeated rows get the same score.  Extra columns are ignored unless carried.
    Without labels of both kinds the score is constant; empty tables give an empty result.
    """
    carry = ["doc_id", *[c for c in carry or [] if c not in ("doc_id", "held_out", "score", "predicted")]]
    score = scorer(docs.sparkSession, train(docs, labels))
    scored = docs.select(*carry, score("text").alias("score"))
    return scored.select(*carry, held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
