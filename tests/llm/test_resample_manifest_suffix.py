"""Importance resampling, the Merkle manifest and suffix deduplication, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docengine.llm import importance, merkle, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank string, hex string, did int, pos int, spans string, root string"
A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"


def rows():
    """Nulls everywhere, empty and long texts, ties, repeated rows, repeated ids, clashing columns."""
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(40000))
    texts = ["", None, " \t\n", A, A + " ", A.upper(), "x" + A, A + A, long, long[:5000] + "é" + long[5000:9000], "short", "É è ñ ü ß " * 20, "ab" * 400, "ab" * 300 + A, "日本語のテキスト" * 30, "日本語のテキスト" * 20]
    texts += [f"{A} tail {i} {'z' * i}" for i in range(30)]
    out = [(i, t, [None, "en", "de"][i % 3], [None, "s1"][i % 2], [None, i][i % 5 > 0], 0.5, "r", "h", 1, 2, "s", "t") for i, t in enumerate(texts)]
    more = [out[3], out[3], (4, "another text with the id of four " + A, "en", None, 1), (None, A, None, None, None), (None, A + " and more", "fr", None, 7), (None, None, None, None, None)]
    return [(*r, *[None] * (12 - len(r))) for r in out + more]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- importance resampling


def features(text, width=2):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in range(1, width + 1) for i in range(len(w) - n + 1)]


def resampled(docs, targets, least=20, share=25, width=2):
    found = [(d, *features(t, width)) for d, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in targets for b in features(x, width)[1])
    big, small = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big + 10000) / ((s[b] + 1) * (small + 10000)))) for b in s}
    out = []
    for d, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(able[: share * len(able) // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize(("most", "chunk", "run", "share", "width"), [(1 << 20, 2048, 1 << 18, 25, 2), (3, 2, 4, 60, 2), (1, 1, 3, 100, 3), (1 << 20, 2048, 1 << 18, 0, 1)])
def test_resample(spark, docs, monkeypatch, most, chunk, run, share, width):
    monkeypatch.setattr(importance, "CHUNK", chunk)
    monkeypatch.setattr(importance, "RUN", run)
    targets = [A, "nine ten eleven", None, ""]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id int, text string")
    got = importance.resample(docs, bench, most=most, share=share, width=width)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == resampled([r[:2] for r in rows()], targets, share=share, width=width)


def test_resample_ties_on_one_score(spark, monkeypatch):
    """All rows share weight and noise: the draw goes by doc_id, through shards that split the score."""
    monkeypatch.setattr(importance, "noise", lambda doc_id, seed: 5)
    table = spark.createDataFrame([(i if i % 9 else None, A) for i in range(200)], "doc_id long, text string").repartition(7)
    got = importance.resample(table, table, most=10).where("rank is not null").collect()
    ids = sorted((i for i in range(200) if i % 9))
    assert {(r["rank"], r["doc_id"]) for r in got} == {(i + 1, ids[i]) for i in range(50)}


def test_resample_empty(spark, docs, empty):
    bench = spark.createDataFrame([(1, A)], "item_id int, text string")
    assert importance.resample(empty, bench).collect() == []
    assert importance.resample(docs, bench.limit(0)).count() == len(rows())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=12), max_size=12))
def test_tournament_merges_runs(runs):
    chunks = sorted(sorted((x, i) for x in run) for i, run in enumerate(runs))
    assert list(importance.merged(iter(chunks))) == sorted(x for c in chunks for x in c)


def test_checksums_of_long_words():
    text = ("a" * 200 + " b " + "cd" * 40 + " " + "é" * 60).encode()
    raw, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    got = sorted(int(b) for bucket, _ in importance.features(raw, off, 2, 10000) for b in bucket)
    assert got == sorted(features(text.decode())[1])


# --- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def proofs(table, fanout):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def up(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
        return out

    def beside(levels, i):
        out = []
        for nodes in levels[:-1]:
            b = i // fanout * fanout
            out.append((nodes[b:i], nodes[i + 1 : b + fanout]))
            i //= fanout
        return out

    def leaf(doc_id, text, lang, source, n_chars):
        return h(*map(field, (doc_id, source, lang, n_chars, text)))

    groups = {}
    for r in table:
        groups.setdefault(r[2], []).append(r[:5])
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in names:
        own = sorted(groups[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[k] = own, up([leaf(*r) for r in own])
    top = up([trees[k][1][-1][0] for k in names])
    out = Counter()
    for j, k in enumerate(names):
        own, levels = trees[k]
        for i, r in enumerate(own):
            path = beside(levels, i) + beside(top, j)
            at = leaf(*r)
            if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                at = leaf(*r[:4], r[4] + 1)
            for a, b in path:
                at = h(*a, at, *b)
            out[(r[0], leaf(*r), levels[-1][0], top[-1][0], h(*[x for a, b in path for x in (*a, *b)]), at, at == top[-1][0])] += 1
    return out


@pytest.mark.parametrize(("fanout", "levels"), [(2, 10), (2, 1), (3, 2)])
def test_manifest(docs, fanout, levels):
    got = Counter(map(tuple, merkle.manifest(docs, fanout, levels).collect()))
    assert got == proofs(rows(), fanout)
    assert {k[6] for k in got} == {True, False}


def test_manifest_of_few_rows(spark, empty):
    assert merkle.manifest(empty).collect() == []
    one = [(5, "t", "en", None, 3)]
    frame = spark.createDataFrame(one, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.manifest(frame).head()
    assert got["leaf"] == got["subroot"] == got["root"] and got["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    # An own language for every row: the tree of the groups is as deep as the table is long.
    many = [(i, "t", f"l{i}", None, i) for i in range(40)]
    assert Counter(map(tuple, merkle.manifest(spark.createDataFrame(many, frame.schema), 2, 2).collect())) == proofs(many, 2)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 70), st.integers(2, 5))
def test_siblings_by_index(m, fanout):
    leaves = np.frombuffer(b"".join(h(str(i)).encode() for i in range(m)), np.uint8).reshape(-1, 64)
    up = merkle.height(m, fanout)
    levels = merkle.tree(leaves, up, fanout)
    index, left, right = merkle.siblings(m, up, fanout)
    assert len(levels[-1]) == 1
    ends = merkle.folded(leaves, np.concatenate(levels), index, left, right, fanout)
    assert (ends == levels[-1][0]).all()


# --- suffix deduplication


def left(table, length=50):
    last = 2**63 - 1
    first = {}
    for d, text in table:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            first[w] = min(first.get(w, last), last if d is None else d)
    out = Counter()
    for d, text in table:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < (last if d is None else d):
                gone[i : i + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(b"\1+", gone)]
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[(d, len(data), sum(gone), len(spans), hashlib.sha256(kept).hexdigest(), tuple(x for s in spans for x in s))] += 1
    return out


def found(frame):
    return Counter((*r[:5], tuple(r[5])) for r in frame.collect())


@pytest.mark.parametrize(("hot", "bucket", "flush", "piece"), [(50_000, 1 << 20, 16 << 20, 1 << 19), (1, 2000, 3000, 700), (3, 1 << 14, 1, 4096)])
def test_suffix_dedup(docs, monkeypatch, hot, bucket, flush, piece):
    for name, value in {"BUCKET": bucket, "PAIRS": bucket, "FLUSH": flush, "HELD": flush, "PIECE": piece}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    assert found(suffix_dedup.suffix_dedup(docs, hot=hot)) == left([r[:2] for r in rows()])


def test_suffix_dedup_many_edits(spark):
    """Copies with edits, passages in different surroundings, and matches that end anywhere."""
    draw = random.Random(4)
    words = [f"{draw.choice('bcdfg')}{draw.choice('aeiou')}{draw.randrange(40)}" for _ in range(60)]
    base = [" ".join(draw.choices(words, k=120)) for _ in range(4)]
    table = []
    for i in range(60):
        text = draw.choice(base)
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(text))
            text = text[:at] + draw.choice(["", "Q", " new part "]) + text[at + draw.randrange(30) :]
        at = draw.randrange(len(text))
        table.append((i * 7 % 60, text[:at] + draw.choice(base)[at : at + draw.randrange(200)]))
    frame = spark.createDataFrame(table, "doc_id long, text string").repartition(6)
    assert found(suffix_dedup.suffix_dedup(frame)) == left(table)
    assert found(suffix_dedup.suffix_dedup(frame, hot=2)) == left(table)


def test_suffix_dedup_empty(spark, empty):
    assert suffix_dedup.suffix_dedup(empty).collect() == []
    short = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert sorted(r["n_bytes"] for r in suffix_dedup.suffix_dedup(short).collect()) == [0, 1]


@settings(max_examples=80, deadline=None)
@given(st.text("ab", min_size=1, max_size=300), st.sampled_from([9, 20, 50]))
def test_suffix_order(text, depth):
    data = text.encode()
    order = suffix_dedup.suffix_order(np.frombuffer(data, np.uint8), depth)
    assert sorted(order.tolist()) == list(range(len(order)))
    padded = data + bytes(2 * depth)
    prefixes = [padded[i : i + depth] for i in order.tolist() if i < len(data)]
    assert prefixes == sorted(prefixes)


@settings(max_examples=40, deadline=None)
@given(st.text("abé", min_size=60, max_size=200))
def test_classes_are_equal_strings(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    starts = np.arange(len(raw) - 50 + 1)
    number = suffix_dedup.classes(raw, starts, 50)
    strings = [raw[i : i + 50].tobytes() for i in starts]
    assert len(set(zip(number.tolist(), strings, strict=True))) == len(set(strings)) == len(set(number.tolist()))
