"""Target-distribution importance resampling with Gumbel noise.

Features are hashed runs of one and two words.  One pass counts the buckets of the corpus and
of the target texts, a second one looks every feature's gain up in an array and keeps a narrow
row per document.  The draw is an external sort:

* eligible rows that can be drawn become sorted runs inside each partition, cut at shard
  boundaries into chunks of bounded size;
* the chunks of a shard meet in one task in the order of their first keys, and a k-way
  tournament tree merges them: a chunk is opened only when its first key is due, so a task
  holds no more than one chunk of each run;
* ranks start at the rows of the shards before; the tree stops at the exact draw count.

Shards are ranges of (score, doc_id).  Their boundaries come from the exact histogram of the
scores, whose values are integers within +-130,000, so it has a fixed bound; a score that more
than ``most`` rows share is split by doc_id.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import materialise
from docengine.llm.textkit import buffers, slices, words

BUCKETS = 10_000
WIDTH = 2
LEAST_WORDS = 20
SHARE = 25
SEED = 7
#: Rows of one chunk, of one sorted run, and of one shard at most.
CHUNK, RUN, MOST = 2048, 1 << 18, 1 << 20

#: Bytes that are part of a word once A-Z are lower-cased: digits, a-z and all of non-ASCII text.
_GAPS = np.ones(256, bool)
_GAPS[0x30:0x3A] = _GAPS[0x61:0x7B] = _GAPS[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LONG = 48


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def crc_states(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the bytes of each span, from the registers in ``state``; all spans advance together."""
    order = np.argsort(starts - ends, kind="stable")
    s, length, reg = starts[order], (ends - starts)[order], state[order]
    for j in range(min(int(length[0]) if len(length) else 0, _LONG)):
        m = int(np.searchsorted(-length, -j, "left"))
        reg[:m] = _CRC[(reg[:m] ^ raw[s[:m] + j]) & 255] ^ (reg[:m] >> np.uint32(8))
    for i in range(int(np.searchsorted(-length, -_LONG, "left"))):  # long spans end in zlib
        rest = raw[s[i] + _LONG : s[i] + length[i]].tobytes()
        reg[i] = zlib.crc32(rest, int(reg[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(reg)
    out[order] = reg
    return out


def features(raw: np.ndarray, off: np.ndarray, width: int, n_buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each run length: the bucket of every run, and each document's first run's index (n+1 values)."""
    starts, ends, first = words(raw, off, _GAPS)
    state = crc_states(raw, starts, ends, np.full(len(starts), 0xFFFFFFFF, np.uint32))
    yield (state ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % n_buckets, first
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin = np.arange(len(starts))
    for k in range(1, width):
        whole = (begin + k < len(starts)) & (doc[np.minimum(begin + k, max(len(doc) - 1, 0))] == doc[begin])
        begin, state = begin[whole], state[whole]
        state = _CRC[(state ^ np.uint32(32)) & 255] ^ (state >> np.uint32(8))
        state = crc_states(raw, starts[begin + k], ends[begin + k], state)
        yield (state ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % n_buckets, np.searchsorted(doc[begin], np.arange(len(first)))


def _pieces(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Lower-cased bytes and offsets of consecutive documents, about 1 MB at a time."""
    raw, off = buffers(column)
    for i, j in slices(off, 1 << 20):
        yield i, j, _LOWER[raw[off[i] : off[j]]], off[i : j + 1] - off[i]


def _counts(width: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for _, _, raw, off in _pieces(batch.column(0)):
                for bucket, _ in features(raw, off, width, n_buckets):
                    total += np.bincount(bucket, minlength=n_buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, width: int = WIDTH, n_buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all ``texts``: one row a task and bucket is shuffled, ``n_buckets`` numbers come back."""
    parts = texts.select("text").mapInArrow(_counts(width, n_buckets), "bucket long, n long")
    total = np.zeros(n_buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of the add-one shares of target and corpus) for each bucket."""
    k, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + k)) / float((s + 1) * (t_all + k)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from the seed and the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def _scores(gain: np.ndarray, width: int, seed: int):
    names = [x.split()[0] for x in _SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            n_words, n, total = (np.zeros(len(ids), np.int64) for _ in range(3))
            for i, j, raw, off in _pieces(batch.column(1)):
                for k, (bucket, first) in enumerate(features(raw, off, width, len(gain))):
                    sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                    n[i:j] += np.diff(first)
                    total[i:j] += sums[first[1:]] - sums[first[:-1]]
                    if not k:
                        n_words[i:j] = np.diff(first)
            weight = total // np.maximum(n, 1)
            score = weight + np.fromiter((noise(d, seed) for d in ids), np.int64, len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, (n_words, n, weight, score))], names=names)

    return run


class Tournament:
    """A winner tree over the heads of sorted runs; leaves are reused, and their number doubles when all are taken."""

    def __init__(self) -> None:
        self.leaves, self.runs, self.at, self.free = 1, [None], [0], [0]
        self.heads: list[tuple | None] = [None]
        self.win = [0, 0]

    def _play(self, a: int, b: int) -> int:
        x, y = self.heads[a], self.heads[b]
        return a if y is None or (x is not None and x <= y) else b

    def _replay(self, leaf: int) -> None:
        node = (self.leaves + leaf) >> 1
        while node:
            self.win[node] = self._play(self.win[2 * node], self.win[2 * node + 1])
            node >>= 1

    def _grow(self) -> None:
        n = self.leaves
        self.runs += [None] * n
        self.at += [0] * n
        self.heads += [None] * n
        self.free += range(2 * n - 1, n - 1, -1)
        self.leaves = 2 * n
        self.win = [0] * (2 * n) + list(range(2 * n))
        for node in range(2 * n - 1, 0, -1):
            self.win[node] = self._play(self.win[2 * node], self.win[2 * node + 1])

    @property
    def head(self) -> tuple | None:
        """The least key of all runs, None if all have ended."""
        return self.heads[self.win[1]]

    def add(self, rows: list[tuple]) -> None:
        if not self.free:
            self._grow()
        leaf = self.free.pop()
        self.runs[leaf], self.at[leaf], self.heads[leaf] = rows, 0, rows[0]
        self._replay(leaf)

    def pop(self) -> tuple:
        leaf = self.win[1]
        out, rows = self.heads[leaf], self.runs[leaf]
        self.at[leaf] += 1
        if self.at[leaf] < len(rows):
            self.heads[leaf] = rows[self.at[leaf]]
        else:
            self.heads[leaf] = self.runs[leaf] = None
            self.free.append(leaf)
        self._replay(leaf)
        return out


def merged(chunks: Iterator[list[tuple]]) -> Iterator[tuple]:
    """All rows in order; ``chunks`` are sorted, and come in the order of their first rows."""
    tree, due = Tournament(), next(chunks, None)
    while True:
        while due is not None and (tree.head is None or due[0] <= tree.head):
            tree.add(due)
            due = next(chunks, None)
        if tree.head is None:
            return
        yield tree.pop()


#: A key row: negated score, whether doc_id is null, doc_id (0 for null), n_features, weight.
_KEYS = 5


def _runs(starts: np.ndarray, splits: dict[int, tuple[int, list[int]]], chunk: int, most: int):
    """Sorted runs of at most ``most`` rows, cut into chunks by shard.

    ``starts`` are the ascending negated scores at which shards begin; a score in ``splits`` has
    its first shard and the ids at which its later ones begin.
    """

    def cut(rows: np.ndarray) -> Iterator[tuple]:
        rows = rows[np.lexsort(rows.T[::-1])]
        shard = np.searchsorted(starts, rows[:, 0], "right") - 1
        for score, (base, ids) in splits.items():
            own = rows[:, 0] == score
            shard[own] = base + np.where(rows[own, 1] > 0, len(ids), np.searchsorted(ids, rows[own, 2], "right"))
        edge = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(edge, [*edge[1:], len(rows)], strict=True):
            for i in range(a, b, chunk):
                part = rows[i : min(i + chunk, b)]
                yield int(shard[a]), *(int(x) for x in part[0]), len(part), np.ascontiguousarray(part).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids = batch.column(0)
            unset = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), np.int64)
            own = [np.asarray(batch.column(c)) for c in (1, 2, 3)]
            held.append(np.stack([-own[2], unset, np.asarray(ids.fill_null(0)), own[0], own[1]], axis=1))
            n += len(ids)
            if n >= most:
                yield _chunks(cut(np.concatenate(held)))
                held, n = [], 0
        if n:
            yield _chunks(cut(np.concatenate(held)))

    return run


_CHUNKS = "shard long, k0 long, k1 long, k2 long, k3 long, k4 long, n long, rows binary"


def _chunks(rows: Iterator[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.binary())], names=[x.split()[0] for x in _CHUNKS.split(", ")])


_DRAWN = "doc_id long, n_features long, weight long, score long, rank long"


def _draw(before: dict[int, int], draw: int):
    """Merge the chunks of each shard; ``before`` are the rows of the shards ahead of it."""
    names = [x.split()[0] for x in _DRAWN.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((s.as_py(), r.as_py()) for batch in batches for s, r in zip(batch.column("shard"), batch.column("rows"), strict=True))
        ahead = next(rows, None)
        while ahead is not None:
            shard, ended = ahead[0], []

            def own(shard=shard, ended=ended) -> Iterator[list[tuple]]:
                nonlocal ahead
                while ahead is not None and ahead[0] == shard:
                    yield list(map(tuple, np.frombuffer(ahead[1], np.int64).reshape(-1, _KEYS).tolist()))
                    ahead = next(rows, None)

            rank, held = before[shard], []
            for negated, unset, doc, n, weight in merged(own()):
                rank += 1
                held.append((None if unset else doc, n, weight, -negated, rank if rank <= draw else None))
                if len(held) == 4000:
                    yield out(held)
                    held = []
            if held:
                yield out(held)

    return run


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, width: int = WIDTH, n_buckets: int = BUCKETS, seed: int = SEED, most: int = MOST) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``; undrawn rows have no rank.

    Of the rows with ``least_words`` words, the highest ``share`` percent of scores are drawn;
    ties go to the smaller doc_id (null last), then to fewer features and the smaller weight.
    A null or empty text has no feature and weight 0; a null doc_id draws its noise from the
    empty string.  Rows that repeat a doc_id share their noise and are drawn one by one.  Very
    long texts are scored whole.  Other columns are ignored; an empty table gives an empty result,
    an empty target leaves the corpus' own frequencies to decide.
    """
    gain = gains(bucket_counts(docs, width, n_buckets), bucket_counts(target, width, n_buckets))
    scored = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scores(gain, width, seed), _SCORED))
    eligible = scored.where(F.col("n_words") >= least_words)
    histogram = sorted(((-r["score"], r["n"]) for r in eligible.groupBy("score").agg(F.count("*").alias("n")).collect()))
    draw = share * sum(n for _, n in histogram) // 100
    columns = [F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    if not draw:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))

    per_shard = min(most, max(1, -(-draw // int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    starts, splits, shards, seen, filled = [], {}, 0, 0, per_shard
    heavy = {}
    for negated, n in histogram:
        if seen >= draw:
            break
        cutoff = -negated
        if n > most:
            heavy[negated] = -(-n // most)
        seen += n
    if heavy:  # ids that cut a common score; they need not be exact, as the shards are counted
        fractions = {s: [i / k for i in range(1, k)] for s, k in heavy.items()}
        common = eligible.where(F.col("score").isin([-s for s in heavy]))
        finest = sorted({f for fs in fractions.values() for f in fs})
        found = {-r["score"]: dict(zip(finest, r["cuts"] or [], strict=False)) for r in common.groupBy("score").agg(F.percentile_approx("doc_id", finest, 10_000).alias("cuts")).collect()}
    for negated, n in histogram:
        if -negated < cutoff:
            break
        if negated in heavy:
            cuts = sorted({found[negated][f] for f in fractions[negated] if f in found[negated]})
            starts.append(negated)
            splits[negated] = (shards, cuts)
            starts += [negated] * len(cuts)
            shards += 1 + len(cuts)
            filled = per_shard
        elif filled >= per_shard:
            starts.append(negated)
            shards += 1
            filled = n
        else:
            filled += n

    chunks = eligible.where(F.col("score") >= cutoff).select("doc_id", "n_features", "weight", "score").mapInArrow(_runs(np.array(starts, np.int64), splits, CHUNK, RUN), _CHUNKS)
    chunks = materialise(chunks)
    before, total = {}, 0
    for row in sorted(chunks.groupBy("shard").agg(F.sum("n").alias("n")).collect()):
        before[row["shard"]] = total
        total += row["n"]
    drawn = chunks.repartition(shards, "shard").sortWithinPartitions("shard", *[f"k{i}" for i in range(_KEYS)]).mapInArrow(_draw(before, draw), _DRAWN)
    rest = scored.where((F.col("n_words") < least_words) | (F.col("score") < cutoff)).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)
