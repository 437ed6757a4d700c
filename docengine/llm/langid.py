"""Language identification: a byte convolutional network in numpy.

A text is cut into windows of WINDOW bytes that cover all of it.  Filters of several widths
slide over the bytes of a window, their maxima are pooled and a softmax layer gives the
window's log probabilities; a text's are their mean, weighted by the windows' bytes.

The model is fitted on the driver on at most SAMPLE rows outside the held-out fold, drawn
evenly over the languages (folds.excerpt bounds the bytes of a sampled text; every language of
the sample can be predicted).  At prediction, the taps of a filter are added up from tables by byte pair, so
a window costs a few table reads a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.folds import held_out, release, stratified
from docengine.llm.textkit import buffers, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE = 3000
EPOCHS = 6
CROPS = 4
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


class Model:
    def __init__(self, langs: list[str], seed: int = 3):
        r = np.random.default_rng(seed)
        self.langs = langs
        self.taps = [r.normal(0, 0.4, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        for t in self.taps:
            t[:, 0, :] = -1  # padding never wins
        self.dense = r.normal(0, 0.1, (FILTERS * len(WIDTHS), max(len(langs), 1))).astype(np.float32)
        self.bias = np.zeros(max(len(langs), 1), np.float32)
        self._pairs = None

    def __getstate__(self):
        return self.__dict__ | {"_pairs": None}

    def pairs(self) -> list[list[np.ndarray]]:
        """For each width the tables of its tap pairs (and of a last single tap)."""
        if self._pairs is None:
            self._pairs = [
                [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, FILTERS) if k + 1 < len(t) else t[k] for k in range(0, len(t), 2)] for t in self.taps
            ]
        return self._pairs

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Pooled features of windows (n, WINDOW) of bytes."""
        two = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
        out = []
        for tables, w in zip(self.pairs(), WIDTHS):
            n = WINDOW - w + 1
            z = None
            for q, t in enumerate(tables):
                at = (two if len(t) == 65536 else rows)[:, 2 * q : 2 * q + n]
                z = t.take(at, axis=0) if z is None else z + t.take(at, axis=0)
            out.append(np.maximum(z.max(axis=1), 0))
        return np.concatenate(out, axis=1)

    def log_probs(self, rows: np.ndarray) -> np.ndarray:
        parts = []
        for i in range(0, len(rows), 128):
            z = self.pooled(rows[i : i + 128]) @ self.dense + self.bias
            z -= z.max(axis=1, keepdims=True)
            parts.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.bias)), np.float32)


def tiles(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, first window of each text): every byte is in exactly one window."""
    size = np.diff(off)
    count = -(-size // WINDOW)
    first = np.concatenate([[0], np.cumsum(count)])
    flat = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    flat[np.arange(len(raw)) + np.repeat(first[:-1] * WINDOW - off[:-1], size)] = _LOWER[raw]
    return flat.reshape(-1, WINDOW), first


def fit(texts: list[str], langs: list[str], seed: int = 3) -> Model:
    """Train on random crops of the texts, of 16 to WINDOW bytes, drawn evenly over the languages."""
    known = sorted(set(langs))
    model = Model(known, seed)
    if len(known) < 2:
        return model
    r = np.random.default_rng(seed)
    data = [t.encode() for t in texts]
    by = [np.array([d for d, x in enumerate(langs) if x == k and data[d]], np.int64) for k in known]
    by_size = min(max(len(b) for b in by), 4 * max(min(len(b) for b in by), 50))
    store = [np.full_like(t, 1e-3) for t in model.taps], np.full_like(model.dense, 1e-3), np.full_like(model.bias, 1e-3)
    for _ in range(EPOCHS):
        rows, y = [], []
        for k, own in enumerate(by):
            if not len(own):
                continue
            for d in r.choice(own, by_size * CROPS):
                n = WINDOW if r.random() < 0.5 else int(r.integers(16, WINDOW))
                a = int(r.integers(0, max(len(data[d]) - n, 0) + 1))
                row = np.zeros(WINDOW, np.uint8)
                piece = _LOWER[np.frombuffer(data[d][a : a + n], np.uint8)]
                row[: len(piece)] = piece
                rows.append(row)
                y.append(k)
        rows, y = np.array(rows), np.array(y)
        order = r.permutation(len(y))
        for i in range(0, len(order), 64):
            _step(model, store, rows[order[i : i + 64]], y[order[i : i + 64]])
    model._pairs = None
    return model


def _step(model: Model, store: tuple, rows: np.ndarray, y: np.ndarray, rate: float = 0.05) -> None:
    n = len(rows)
    pooled, where = [], []
    for t, w in zip(model.taps, WIDTHS):
        m = WINDOW - w + 1
        z = t[0].take(rows[:, :m], axis=0)
        for k in range(1, w):
            z = z + t[k].take(rows[:, k : k + m], axis=0)
        at = z.argmax(axis=1)
        best = np.take_along_axis(z, at[:, None, :], 1)[:, 0]
        pooled.append(np.maximum(best, 0))
        where.append(np.where(best > 0, at, -1))
    h = np.concatenate(pooled, axis=1)
    z = h @ model.dense + model.bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), y] -= 1
    p /= n
    to_h = p @ model.dense.T
    grad = h.T @ p + 1e-4 * model.dense
    store[1][...] += grad**2
    model.dense -= rate * grad / np.sqrt(store[1])
    store[2][...] += p.sum(0) ** 2
    model.bias -= rate * p.sum(0) / np.sqrt(store[2])
    for q, (t, at) in enumerate(zip(model.taps, where)):
        d, c = np.nonzero(at >= 0)
        j, e = at[d, c], to_h[d, q * FILTERS + c]
        for k in range(len(t)):
            change = np.zeros_like(t[k])
            np.add.at(change, (rows[d, j + k], c), e)
            store[0][q][k] += change**2
            t[k] -= rate * change / np.sqrt(store[0][q][k])


def train(docs: DataFrame, most: int = SAMPLE) -> Model:
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = stratified(known, known, most, "lang")
    model = fit([r["text"] for r in rows], [r["lang"] for r in rows])
    del rows
    release()
    return model


def _predict(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    raw, off = buffers(column)
    names, scores = [], []
    for i, j in slices(off, 1 << 20):
        part, at = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        rows, first = tiles(part, at)
        logs = model.log_probs(rows) * (rows != 0).sum(axis=1, keepdims=True)
        total = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=np.float64)])
        size = np.maximum(np.diff(at), 1)[:, None]
        mean = (total[first[1:]] - total[first[:-1]]) / size
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[part])])
        plain = letters[at[1:]] > letters[at[:-1]]
        for d in range(j - i):
            has = plain[d] or any(map(str.isalpha, bytes(part[at[d] : at[d + 1]]).decode()))
            names.append(model.langs[int(p[d].argmax())] if has and model.langs else UNKNOWN)
            scores.append(float(p[d].max()) if names[-1] != UNKNOWN else 0.0)
    return names, np.array(scores)


def language(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``.

    A null text and a text without a letter are ``und`` with score 0.  Without any language
    to learn from, every row is ``und``.  Very long texts are read whole, window by window.
    Repeated rows get the same prediction, extra columns are ignored unless carried, empty
    tables give an empty result.
    """
    carry = ["doc_id", *[c for c in carry or [] if c not in ("doc_id", "text", "held_out", "lang_pred", "score")]]
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _predict(shared.value, batch.column(len(carry)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*carry, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    found = docs.select(*carry, "text").mapInArrow(run, f"{schema}, lang_pred string, score double")
    return found.select(*carry, held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
