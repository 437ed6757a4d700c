"""Removal of byte strings that an earlier document holds, by difference-cover suffix sorting.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with a
smaller id.  All suffixes of a corpus would be some ten bytes of records for each byte of text,
so the suffix array is dealt out by content first, and no comparison is lost by it:

1. Every window of ``LENGTH`` bytes has an anchor, its least k-mer by hash.  Equal windows have
   equal anchors, so windows are grouped by anchor.  Anchors that two documents share are
   found from (anchor, document) pairs alone, and only their windows go on: about a quarter of
   the text in the data at hand, in strings that span all neighbouring windows of an anchor.
2. The strings of a bucket of anchors are one text, sorted by the difference-cover algorithm:
   triples of the suffixes at 1 and 2 modulo 3 are sorted and named, the sort recurses on the
   names, and the remaining suffixes are merged in by their first symbol and the rank behind it.
   The recursion ends once names cover ``LENGTH`` bytes.  Equal strings are one, with several
   holders; a string that is alone with its anchor has no equal window elsewhere and is left out.
3. Adjacent windows of the suffix array are compared over their ``LENGTH`` bytes; a run of equal
   ones is a class, and its smallest document keeps it.

Equal strings and anchors of one task's slice of text are merged before the shuffle, so a
passage that every document holds is one row for each 32 MB of text.  The most frequent anchors
(at most ``HOT_ANCHORS``, held by more than ``HOT`` documents) are dealt by window instead of by
anchor: strings around a common passage differ, but their windows inside the passage don't.
The joins of texts hash the small side, so texts are shuffled once and never sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm import textkit as T
from docengine.llm.common import materialise

LENGTH = 50
#: Bytes of an anchor; a window holds LENGTH - K + 1 of them.
K = 24
HOT, HOT_ANCHORS = 50_000, 4096
#: Text bytes whose pairs are merged before a shuffle, and whose strings are.
FLUSH, HELD = 16 << 20, 32 << 20
#: Text bytes whose pairs meet in a bucket, and bytes of strings that are sorted at once, on average.
PAIRS, BUCKET = 32 << 20, 1 << 20
#: Bytes hashed at once; windows of a string.
PIECE, WINDOWS = 1 << 19, 1024

_U = np.uint64
_LOW = _U((1 << 40) - 1)
_LAST = (1 << 63) - 1


# --- anchors


def _pieces(off: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first document, end, first byte, end) of spans of about ``PIECE`` bytes; spans of a longer document share length - 1 bytes."""
    for i, j in T.slices(off, PIECE):
        if off[j] - off[i] <= 2 * PIECE:
            yield i, j, int(off[i]), int(off[j])
        else:
            for a in range(int(off[i]), int(off[j]) - length + 1, PIECE):
                yield i, j, a, min(a + PIECE + length - 1, int(off[j]))


def runs(raw: np.ndarray, off: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, code, document) of all maximal runs of windows with one anchor; ``code`` is the anchor's 64-bit hash."""
    n = len(raw)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
    power, inverse = T._powers(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(T.CODES[raw] * power[:n], out=total[1:])
    least = T.mix((total[k:] - total[:-k]) * inverse[: n - k + 1])
    wide, width = 1, length - k + 1
    while 2 * wide <= width:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if width > wide:
        least = np.minimum(least[: wide - width], least[width - wide :])
    inside = np.zeros(n - length + 1, bool)
    new = np.ones(n - length + 1, bool)
    new[1:] = least[1:] != least[:-1]
    for a, b in zip(off[:-1], off[1:], strict=True):
        if b - a >= length:
            inside[a : b - length + 1] = True
            new[a] = True
    start = np.flatnonzero(inside & new)
    after = np.ones(n - length + 1, bool)
    after[:-1] = ~inside[1:] | new[1:]
    end = np.flatnonzero(inside & after) + 1
    return start, end - start, T.mix(least[start] ^ _U(0xA5A5)), np.searchsorted(off, start, "right") - 1


def _bucket(code: np.ndarray, n: int) -> np.ndarray:
    return ((code >> _U(40)) * _U(n) >> _U(24)).astype(np.int64)


def _five(x: np.ndarray) -> np.ndarray:
    """The low 40 bits of each value as rows of five bytes."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _from_five(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :5] = rows
    return out.view("<u8").reshape(-1)


def _edges(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, np.int64)


_PAIRS = "bucket int, local boolean, lows binary, held binary"


def _packed(columns: list[np.ndarray]) -> bytes:
    """Integer columns of one length; as differences, since most of them ascend or repeat."""
    return zstandard.compress(b"".join(np.diff(c.astype(np.int64), prepend=0).tobytes() for c in columns), 1)


def _unpacked(data: bytes, width: int) -> np.ndarray:
    """Columns of a pack as rows."""
    return np.cumsum(np.frombuffer(zstandard.decompress(data), np.int64).reshape(width, -1), axis=1).T


def _pairs(n_buckets: int, length: int, k: int):
    """Anchors of documents, a row for each bucket and 16 MB: the first document that holds an anchor and how many do.

    Where several do, all are told at once that it is shared (``local``).
    """

    def flush(codes: list, dids: list, turn: int) -> pa.RecordBatch:
        code, did = np.concatenate(codes), np.concatenate(dids)
        order = np.lexsort((did, code))
        code, did = code[order], did[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (did[1:] != did[:-1])
        code, did = code[new], did[new]
        first = _edges(code)
        count = np.diff(first)
        rows = []
        several = np.repeat(count > 1, count)
        if several.any():
            order = np.argsort(did[several], kind="stable")
            rows.append((int(turn % n_buckets), True, _five(code[several][order]).tobytes(), _packed([did[several][order], np.ones(len(order))])))
        code, did = code[first[:-1]], did[first[:-1]]
        bucket = _bucket(code, n_buckets)
        order = np.lexsort((did, bucket))
        bucket, low, did, count = bucket[order], _five(code[order]), did[order], count[order]
        edge = _edges(bucket)
        rows += [(int(bucket[a]), False, low[a:b].tobytes(), _packed([did[a:b], count[a:b]])) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        types = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["bucket", "local", "lows", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, dids, size, turn = [], [], 0, 0
        for batch in batches:
            ids = np.asarray(batch.column(0))
            raw, off = T.buffers(batch.column(1))
            for i, j, lo, hi in _pieces(off, length):
                own = np.clip(off[i : j + 1], lo, hi) - lo
                _, _, code, doc = runs(raw[lo:hi], own, length, k)
                turn += int(ids[i] % 65_537)
                if len(code):
                    codes.append(code)
                    dids.append(ids[i:j][doc])
                size += hi - lo
                if size >= FLUSH and codes:
                    yield flush(codes, dids, turn)
                    codes, dids, size = [], [], 0
        if codes:
            yield flush(codes, dids, turn)

    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows that share the key, in batches that are sorted by it."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != at:
                yield rows
                rows = []
            at = row[key]
            rows.append(row)
    if rows:
        yield rows


def _dealt(did: np.ndarray, n_groups: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of rows by group of documents, then document, and (group, first, end) of each group.

    What a bucket has to tell goes out as a pack for each group, not as a row for each document,
    so rows do not multiply with the number of buckets.
    """
    group = (T.mix(did.astype(_U)) % _U(n_groups)).astype(np.int64)
    order = np.lexsort((did, group))
    edge = _edges(group[order])
    return order, [(int(group[order[a]]), int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True)]


_SHARED = "grp int, lows binary, held binary, holders long"


def _shared(hot: int, n_groups: int):
    """Packs of (did, anchor) whose anchor another document holds; rows without group name anchors of more than ``hot`` holders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "bucket"):
            low = [_from_five(r["lows"]) for r in rows if r["local"]]
            did = [_unpacked(r["held"], 2)[:, 0] for r in rows if r["local"]]
            parts = [r for r in rows if not r["local"]]
            often: list[tuple[None, bytes, int]] = []
            if parts:
                a = np.concatenate([_from_five(r["lows"]) for r in parts])
                d, c = np.concatenate([_unpacked(r["held"], 2) for r in parts]).T
                order = np.lexsort((d, a))
                a, d, c = a[order], d[order], c[order]
                edge = _edges(a)
                several = np.repeat(d[edge[:-1]] != d[edge[1:] - 1], np.diff(edge))
                low.append(a[several])
                did.append(d[several])
                holders = np.add.reduceat(c, edge[:-1])
                often = [(None, _five(a[edge[x] : edge[x] + 1]).tobytes(), None, int(holders[x])) for x in np.flatnonzero(holders > hot)]
            low, did = np.concatenate(low), np.concatenate(did)
            order, groups = _dealt(did, n_groups)
            low, did = _five(low[order]), did[order]
            out = [(g, low[x:y].tobytes(), _packed([did[x:y]]), None) for g, x, y in groups] + often
            if out:
                types = (pa.int32(), pa.binary(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["grp", "lows", "held", "holders"])

    return run


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(did, lows): a row for each document with shared anchors."""
    for rows in _grouped(batches, "grp"):
        low = np.concatenate([_from_five(r["lows"]) for r in rows])
        did = np.concatenate([_unpacked(r["held"], 1)[:, 0] for r in rows])
        order = np.lexsort((low, did))
        low, did = _five(low[order]), did[order]
        edge = _edges(did)
        yield pa.RecordBatch.from_arrays([pa.array(did[edge[:-1]]), pa.array([low[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], names=["did", "lows"])


# --- strings of shared anchors


_STRINGS = "bucket int, local boolean, n int, held binary, owners binary"
_OWNER = 4
"""Columns of an owner: string, did, tag, start.  A tag tells apart texts under one did; it is 0 where no doc_id repeats."""


def _tag(data: bytes) -> int:
    return xxhash.xxh32_intdigest(data)


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all bytes of the spans, one span after another."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _spans_hashed(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of one array, which may overlap."""
    power, inverse = T._powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum(T.CODES[raw] * power[: len(raw)], out=total[1:])
    return T.mix((total[starts + lengths] - total[starts]) * inverse[starts] ^ lengths.astype(_U))


def _firsts(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each span the first span with the same bytes: equal hashes propose, the bytes decide."""
    order = np.lexsort((np.arange(len(hashes)), hashes))
    edge = _edges(hashes[order])
    first = np.empty(len(hashes), np.int64)
    first[order] = np.repeat(order[edge[:-1]], np.diff(edge))
    copy = np.flatnonzero(first != np.arange(len(first)))
    same = lengths[copy] == lengths[first[copy]]
    odd, copy = copy[~same], copy[same]
    for i in range(0, len(copy), 1 << 13):
        some = copy[i : i + (1 << 13)]
        equal = raw[_flat(starts[some], lengths[some])] == raw[_flat(starts[first[some]], lengths[some])]
        whole = np.logical_and.reduceat(equal, np.cumsum(lengths[some]) - lengths[some])
        odd = np.concatenate([odd, some[~whole]])
    first[odd] = odd
    return first


def _strings(n_buckets: int, hot: np.ndarray, length: int, k: int, tagged: bool):
    """Strings around shared anchors, each once for 32 MB of text, with the places in its first document.

    Later documents of the same slice lose the string's windows at once (``local``: did, tag, start, end).
    """

    def flush(texts: list, parts: list, turn: int) -> pa.RecordBatch:
        raw = np.concatenate(texts)
        start, size, code, did, tag, place, hashes = (np.concatenate(c) for c in zip(*parts, strict=True))
        first = _firsts(raw, start, size, hashes)
        least = np.full(len(first), _LAST, np.int64)
        np.minimum.at(least, first, did)
        lost = np.flatnonzero(did != least[first])
        rows = []
        if len(lost):
            rows.append((turn % n_buckets, True, 0, b"", _packed([did[lost], tag[lost], place[lost], place[lost] + size[lost]])))
        own = np.flatnonzero(did == least[first])
        own = own[np.lexsort((did[own], first[own], code[first[own]] & _LOW, _bucket(code[first[own]], n_buckets)))]
        bucket = _bucket(code[first[own]], n_buckets)
        new = np.ones(len(own), bool)  # where the next string begins
        new[1:] = first[own[1:]] != first[own[:-1]]
        for a, b in zip(edge := _edges(bucket), edge[1:], strict=False):
            mine = own[a:b]
            heads = first[mine[new[a:b]]]
            sizes = size[heads]
            held = b"".join([sizes.astype(np.int32).tobytes(), _five(code[heads]).tobytes(), raw[_flat(start[heads], sizes)].tobytes()])
            rows.append((int(bucket[a]), False, len(heads), zstandard.compress(held, 3), _packed([np.cumsum(new[a:b]) - 1, did[mine], tag[mine], place[mine]])))
        types = (pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["bucket", "local", "n", "held", "owners"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, parts, held, turn = [], [], 0, 0
        for batch in batches:
            ids = np.asarray(batch.column("did"))
            raw, off = T.buffers(batch.column("text"))
            flags = [np.unique(_from_five(x.as_py())) for x in batch.column("lows")]
            tags = np.array([_tag(raw[off[d] : off[d + 1]].tobytes()) if tagged else 0 for d in range(len(ids))], np.int64)
            for i, j, lo, hi in _pieces(off, length):
                own = np.clip(off[i : j + 1], lo, hi) - lo
                start, count, code, doc = runs(raw[lo:hi], own, length, k)
                wanted = np.concatenate([flags[d] | _U(d - i) << _U(40) for d in range(i, j)])
                at = np.isin((code & _LOW) | doc.astype(_U) << _U(40), wanted)
                start, count, code, doc = start[at], count[at], code[at], doc[at] + i
                if not len(start):
                    continue
                # A string of windows per anchor; of the most frequent ones, and of very long runs, more.
                step = np.where(np.isin(code & _LOW, hot), 1, WINDOWS)
                n = -(-count // step)
                which = np.repeat(np.arange(len(n)), n)
                shift = (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)) * step[which]
                size = np.minimum(step[which], count[which] - shift) + length - 1
                start, code, doc, common = start[which] + shift, code[which], doc[which], step[which] == 1
                hashes = _spans_hashed(raw[lo:hi], start, size)
                parts.append((start + held, size, np.where(common, hashes, code), ids[doc], tags[doc], start + lo - off[doc], hashes))
                texts.append(raw[lo:hi])
                held += hi - lo
                turn += len(start)
                if held >= HELD:
                    yield flush(texts, parts, turn)
                    texts, parts, held = [], [], 0
        if parts:
            yield flush(texts, parts, turn)

    return run


# --- the suffix array of a bucket


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(order, names, how many): names are the ranks of the distinct keys."""
    order = np.argsort(keys)
    ranked = keys[order]
    fresh = np.zeros(len(keys), np.int64)
    np.cumsum(ranked[1:] != ranked[:-1], out=fresh[1:])
    names = np.empty(len(keys), np.int64)
    names[order] = fresh
    return order, names, int(fresh[-1]) + 1 if len(keys) else 0


def _triples(t: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One sortable key for the three symbols from each place; pairs are named first where three symbols don't fit into 63 bits."""
    bits = int(t.max()).bit_length()
    if 3 * bits <= 63:
        return (t[at] << (2 * bits)) | (t[at + 1] << bits) | t[at + 2]
    _, pair, n = _names((t[at] << bits) | t[at + 1])
    return pair * (1 << bits) + t[at + 2] if n.bit_length() + bits <= 63 else _names_of_columns(t[at], t[at + 1], t[at + 2])


def _names_of_columns(*columns: np.ndarray) -> np.ndarray:
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _ordered(t: np.ndarray, n: int, names: np.ndarray | None, deeper: int) -> np.ndarray:
    """Ranks of the suffixes of ``t[:n]`` (padded with zeros behind), by at least the symbols that the names of ``deeper`` levels cover.

    ``names``: of the sampled suffixes, where they are known.
    """
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    keys = _triples(t, sample) if names is None else names
    order, name, distinct = _names(keys)
    rank = np.zeros(n + 3, np.int64)  # of sampled suffixes; 0 behind the end
    if distinct == len(sample) or deeper == 0:
        rank[sample[order]] = np.arange(1, len(sample) + 1)
    else:
        rank[sample] = _ordered(np.concatenate([name + 1, np.zeros(3, np.int64)]), len(sample), None, deeper - 1) + 1
    sampled = np.empty(len(sample), np.int64)
    sampled[rank[sample] - 1] = sample
    by_one, by_two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    # The remaining suffixes: by their symbol and the rank behind it, then merged.
    bits, wide = int(t.max()).bit_length(), n + 3
    rest = by_one - 1
    if n % 3 == 1:  # the last one stands before the end, the least suffix
        rest = np.concatenate([[n - 1], rest])
    rest = rest[np.argsort(t[rest].astype(np.uint16) if bits <= 16 else t[rest], kind="stable")]
    before = np.searchsorted(t[by_one] * wide + rank[by_one + 1], t[rest] * wide + rank[rest + 1])
    two_first, rest_first = ((t[x] << bits) | t[x + 1] for x in (by_two, rest))
    if 2 * bits + wide.bit_length() > 63:
        _, pair, _ = _names(np.concatenate([two_first, rest_first]))
        two_first, rest_first = pair[: len(by_two)], pair[len(by_two) :]
    before += np.searchsorted(np.maximum.accumulate(two_first * wide + rank[by_two + 2]), rest_first * wide + rank[rest + 2])
    place = np.arange(len(rest)) + np.maximum.accumulate(before)
    out = np.empty(n, np.int64)
    out[rest] = place
    free = np.ones(n, bool)
    free[place] = False
    out[sampled] = np.flatnonzero(free)
    return out


def suffix_order(raw: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of the bytes in an order that agrees with their first ``depth`` bytes; padding counts as zero bytes.

    The first names are of eight bytes, those of the level above of three names: 14, 32, 86 ... bytes.
    """
    n = len(raw) + 2 * depth + 8
    t = np.zeros(n + 8, np.int64)
    t[: len(raw)] = raw
    packed = np.zeros(n, _U)
    for k in range(8):
        packed = packed << _U(8) | t[k : k + n].astype(_U)
    sample = np.concatenate([np.arange(1, n, 3), np.arange(2, n, 3)])
    deeper, covered, stride = 0, 8, 3
    while covered < depth:
        deeper, covered, stride = deeper + 1, covered + 2 * stride, 3 * stride
    rank = _ordered(t[: n + 3], n, packed[sample], deeper)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def classes(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A number for the ``length`` bytes from each start: equal exactly where the bytes are."""
    if not len(starts):
        return np.zeros(0, np.int64)
    order = suffix_order(raw, length)
    index = np.full(len(order), -1, np.int64)
    index[starts] = np.arange(len(starts))
    mine = index[order]
    mine = mine[mine >= 0]
    same = np.ones(len(mine) - 1, bool)
    a, b = starts[mine[:-1]], starts[mine[1:]]
    packed = np.zeros(len(raw) - 7, _U)
    for k in range(8):
        packed = packed << _U(8) | raw[k : k + len(packed)].astype(_U)
    for k in [*range(0, length - 8, 8), length - 8]:  # adjacent prefixes, eight bytes at a time
        same &= packed[a + k] == packed[b + k]
    out = np.empty(len(starts), np.int64)
    out[mine[0]] = 0
    out[mine[1:]] = np.cumsum(~same)
    return out


_SPANS = "grp int, held binary"


def _verdicts(length: int, n_groups: int):
    """Packs of (did, tag, start, end) of the bytes that go."""

    def one(rows: list[dict]) -> np.ndarray:
        ids: dict[bytes, int] = {}
        owners, anchors = [], []
        for r in rows:
            n, held = r["n"], zstandard.decompress(r["held"])
            ends = (9 * n + np.cumsum(np.frombuffer(held, np.int32, n))).tolist()
            own = _unpacked(r["owners"], _OWNER).copy()
            number = np.array([ids.setdefault(held[a:b], len(ids)) for a, b in zip([9 * n, *ends[:-1]], ends, strict=True)], np.int64)
            own[:, 0] = number[own[:, 0]]
            owners.append(own)
            anchors.append((number, _from_five(held[4 * n : 9 * n])))
        owners = np.concatenate(owners)
        anchor = np.zeros(len(ids), _U)
        for number, low in anchors:
            anchor[number] = low
        least = np.full(len(ids), _LAST, np.int64)
        np.minimum.at(least, owners[:, 0], owners[:, 1])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        windows = sizes - length + 1
        first = np.cumsum(windows) - windows
        by_window = np.repeat(least, windows)  # the first document that has the window
        # A string that is alone with its anchor shares no window with another string.
        _, number, alike = np.unique(anchor, return_inverse=True, return_counts=True)
        rivals = alike[number] > 1
        if rivals.any():
            texts = list(ids)
            raw = np.frombuffer(b"".join(texts[x] for x in np.flatnonzero(rivals)), np.uint8)
            n = windows[rivals]
            starts = _flat(np.cumsum(sizes[rivals]) - sizes[rivals], n)
            found = classes(raw, starts, length)
            order = np.argsort(found, kind="stable")
            mine = np.repeat(least[rivals], n)
            by_window[np.repeat(rivals, windows)] = np.minimum.reduceat(mine[order], _edges(found[order])[:-1])[found]
        # Windows of every place of every string that go.
        n = windows[owners[:, 0]]
        place = np.repeat(np.arange(len(owners)), n)
        shift = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        gone = by_window[first[owners[place, 0]] + shift] < owners[place, 1]
        begins = gone & np.concatenate([[True], ~gone[:-1] | (place[1:] != place[:-1])])
        stops = gone & np.concatenate([~gone[1:] | (place[1:] != place[:-1]), [True]])
        a, b = np.flatnonzero(begins), np.flatnonzero(stops)
        own = owners[place[a]]
        return np.stack([own[:, 1], own[:, 2], own[:, 3] + shift[a], own[:, 3] + shift[b] + length], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "bucket"):
            spans = [_unpacked(r["owners"], 4) for r in rows if r["local"]]
            if parts := [r for r in rows if not r["local"]]:
                spans.append(one(parts))
            spans = np.concatenate(spans)
            spans = spans[np.lexsort((spans[:, 2], spans[:, 1]))]
            order, groups = _dealt(spans[:, 0], n_groups)
            if groups:
                grp, held = zip(*[(g, _packed(list(spans[order[a:b]].T))) for g, a, b in groups], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(grp, pa.int32()), pa.array(held, pa.binary())], names=["grp", "held"])

    return run


def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(did, spans): the maximal removed runs of each document and tag, a row a document."""
    for rows in _grouped(batches, "grp"):
        spans = np.concatenate([_unpacked(r["held"], 4) for r in rows])
        spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
        edge = np.flatnonzero(np.concatenate([[True], (np.diff(spans[:, :2], axis=0) != 0).any(axis=1), [True]]))
        out: dict[int, list] = {}
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            gone = merged(spans[a:b, 2:])
            out.setdefault(int(spans[a, 0]), []).append(np.column_stack([np.full(len(gone), spans[a, 1]), gone]))
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array([np.concatenate(x).tobytes() for x in out.values()], pa.binary())], names=["did", "spans"])


# --- what is left


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, end) rows; touching ones are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], np.maximum.reduceat(spans[:, 1], at)], axis=1)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>"


def _left(tagged: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = T.buffers(batch.column("text"))
            rows = []
            for d, spans in enumerate(batch.column("spans")):
                data = raw[off[d] : off[d + 1]]
                spans = spans.as_py()
                if spans:
                    spans = np.frombuffer(spans, np.int64).reshape(-1, 3)
                    gone = spans[spans[:, 0] == (_tag(data.tobytes()) if tagged else 0)][:, 1:]
                else:
                    gone = np.zeros((0, 2), np.int64)
                digest, at = hashlib.sha256(), 0
                for a, b in gone.tolist():
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                rows.append((len(data), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), digest.hexdigest(), gone.reshape(-1).tolist()))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[x.split()[0] for x in _RESULT.split(", ")])

    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, k: int = K, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and removed (start, end, start ...) of every row of ``docs``.

    A null or empty text has no bytes, one shorter than ``length`` loses none.  Rows without
    doc_id come after all others and lose nothing to each other, nor do rows that repeat a
    doc_id; each is told apart by its text.  Repetition inside one document is no match.  Very
    long texts are read in pieces whose windows overlap.  Columns besides doc_id and text are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(F.coalesce(doc_id, F.lit(_LAST)).alias("did"), doc_id.alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    tagged = bool(texts.groupBy("did").count().where("count > 1").limit(1).count())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = texts.select("did", "text").mapInArrow(_pairs(max(parts, size // PAIRS), length, k), _PAIRS)
    shared = materialise(pairs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared(hot, parts), _SHARED))
    n_shared = shared.where("grp is not null").agg(F.sum(F.octet_length("lows"))).head()[0] or 0
    often = shared.where("grp is null").orderBy(F.desc("holders"), "lows").limit(HOT_ANCHORS).collect()
    common = np.unique(_from_five(b"".join(r["lows"] for r in often)))

    by_group = shared.where("grp is not null").select("grp", "lows", "held").repartition("grp").sortWithinPartitions("grp")
    flags = by_group.mapInArrow(_flags, "did long, lows binary").hint("shuffle_hash")
    n_buckets = max(parts, n_shared // 5 * (length + (length - k) // 2) // BUCKET)
    strings = texts.join(flags, "did").select("did", "doc_id", "text", "lows").mapInArrow(_strings(n_buckets, common, length, k, tagged), _STRINGS)
    spans = strings.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_verdicts(length, parts), _SPANS)
    removals = spans.repartition("grp").sortWithinPartitions("grp").mapInArrow(_removals, "did long, spans binary").hint("shuffle_hash")
    # The texts' exchange is the one of the join above.
    return texts.join(removals, "did", "left").select("did", "doc_id", "text", "spans").mapInArrow(_left(tagged), _RESULT)
