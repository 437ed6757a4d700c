"""Substring deduplication by hashing lines, and the sentences of lines.

A unit is a sentence of a line; a line without an inner sentence end is one unit.  Short
sentences in a row are joined until they have LEAST words; what is still shorter counts as a
repeat only together with the unit after it (before it, at a line's end), and may then be
removed without it.  Units are normalised (lower-case ASCII, white space runs as one space) and
their 128-bit digests are grouped globally.  The occurrence ranked first by (doc_id, row key,
position) keeps its place, any other is a repeat.

A line that is nothing but repeats goes from LINE words on, wherever it stands.  Inside lines
that differ, repeats that are neighbours form a run, which may go over several lines and over
blank lines between them, and is removed if it has RUN words or more: a stock phrase in an otherwise
different line is no passage.  RUN = 1 removes every repeated unit.  Nothing but repeats and blank
lines between them is ever removed, and spans keep their offsets in the original text, in code
points.  Long words count by their length, so text without spaces has words as well.

Scale: a digest costs one row per map task before the shuffle (partial minimum and maximum);
only digests that occur twice come back, by an inner join whose unit side adaptive
execution splits.  Spans are collected per document, bounded by its own length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.textkit import LOWER_CODES, buffers, hash_spans, mix, slices, words

LEAST = 4
LINE = 8
RUN = 20
WIDE = 12  # bytes for which a longer word counts as one more word
_END = re.compile(rb"[.!?]+(?=[\x20\x09-\x0d])|(?:\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f)+|\n")


def _ends(data: bytes) -> list[int]:
    """Ends of the sentences of a text in bytes, the last one included."""
    ends = [m.end() for m in _END.finditer(data)]
    if data and (not ends or ends[-1] < len(data)):
        ends.append(len(data))
    return ends


class Units:
    """The units of some texts: ends in bytes, text, words, whether a line begins, and the words' bounds."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        data = raw.tobytes()
        own = [_ends(data[a:b]) for a, b in zip(off[:-1], off[1:])]
        count = np.array([len(e) for e in own], np.int64)
        ends = np.array([e for row in own for e in row], np.int64) + np.repeat(off[:-1], count)
        text = np.repeat(np.arange(len(own)), count)
        self.word_starts, self.word_ends, _ = words(raw, off)
        weight = np.concatenate([[0], np.cumsum(np.maximum((self.word_ends - self.word_starts) // WIDE, 1))])
        bound = weight[np.searchsorted(self.word_starts, np.concatenate([[0], ends]))]
        size = np.diff(bound)
        line = np.ones(len(ends), bool)
        line[1:] = (raw[ends[:-1] - 1] == 10) | (text[1:] != text[:-1])
        short = size < LEAST
        fresh = line | ~short
        fresh[1:] |= ~short[:-1]
        start = np.flatnonzero(fresh)
        # Of a row of short sentences, those that begin within the same LEAST words are one unit.
        piece = (bound[:-1] - np.repeat(bound[start], np.diff(np.append(start, len(ends))))) // LEAST
        first = fresh.copy()
        first[1:] |= piece[1:] != piece[:-1]
        head = np.flatnonzero(first)
        last = np.append(head[1:], len(ends)) - 1 if len(head) else head
        self.ends, self.text, self.line = ends[last], text[head], line[head]
        self.size = bound[last + 1] - bound[head]
        self.position = np.arange(len(head)) - np.searchsorted(self.text, self.text)

    def digests(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Two digests of each unit, from the hashes of the words; a short unit's take in its neighbour."""
        first = np.searchsorted(self.word_starts, np.concatenate([[0], self.ends]))
        n = np.diff(first)
        place = np.arange(len(hashes)) - np.repeat(first[:-1], n)
        after = np.append(~self.line[1:], False)
        short = (self.size < LEAST) & (self.size > 0)
        out = []
        # Positional sums of two mixes: equal word lists, and (but for 2**-128) only those, agree.
        for seed in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ mix(place.astype(np.uint64) + seed)), dtype=np.uint64)])
            own = mix(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64))
            done = own.copy()
            with_next, with_last = np.flatnonzero(short & after), np.flatnonzero(short & ~after & ~self.line)
            done[with_next] = mix(own[with_next] ^ mix(own[with_next + 1] + np.uint64(1)))
            done[with_last] = mix(own[with_last] ^ mix(own[with_last - 1] + np.uint64(2)))
            out.append(done.view(np.int64))
        return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        raw, off = buffers(batch.column(2))
        for i, j in slices(off):
            part, at = raw[off[i] : off[j]], off[i : j + 1] - off[i]
            units = Units(part, at)
            a, b = units.digests(hash_spans(part, units.word_starts, units.word_ends, LOWER_CODES))
            good = units.size > 0
            rows = pa.array(units.text[good] + i)
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), keys.take(rows), pa.array(units.position[good].astype(np.int32)), pa.array(a[good]), pa.array(b[good])],
                names=["doc_id", "key", "pos", "h1", "h2"],
            )


def spans(text: str, repeats: list[int], least: int = RUN, line: int = LINE) -> list[tuple[int, int]]:
    """Code point spans of the lines and runs to remove, given the repeated units' positions."""
    data, bad = text.encode(), set(repeats)
    units = Units(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    ends, size = units.ends.tolist(), units.size.tolist()
    starts, begins = [0, *ends[:-1]], [*units.line.tolist(), True]
    out, run = [], []

    def close() -> None:
        while run and run[-1] not in bad:
            run.pop()
        if run and sum(size[k] for k in run) >= least:
            out.append((starts[run[0]], ends[run[-1]]))
        elif run:
            heads = [*[k for k in run if begins[k]], run[-1] + 1]
            for a, b in zip(heads[:-1], heads[1:], strict=True):
                if begins[b] and sum(size[k] for k in range(a, b)) >= line:  # a whole line
                    if out and out[-1][1] == starts[a]:
                        out[-1] = (out[-1][0], ends[b - 1])
                    else:
                        out.append((starts[a], ends[b - 1]))
        run.clear()

    for k in range(len(ends)):
        if k in bad or run and not size[k]:
            run.append(k)
        else:
            close()
    close()
    points, last, at = [], 0, 0
    for s, e in out:
        at += len(data[last:s].decode())
        width = len(data[s:e].decode())
        points.append((at, at + width))
        at, last = at + width, e
    return points


def _cut(carried: int, least: int, line: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, removed = [], []
            for text, repeats in zip(batch.column(carried), batch.column(carried + 1)):
                text, repeats = text.as_py(), repeats.as_py()
                found = spans(text or "", repeats, least, line) if repeats else []
                if found:
                    parts, last = [], 0
                    for s, e in found:
                        parts.append(text[last:s])
                        last = e
                    text = "".join([*parts, text[last:]])
                texts.append(text)
                removed.append([{"start": s, "end": e} for s, e in found])
            yield pa.RecordBatch.from_arrays([*batch.columns[:carried], pa.array(texts, pa.string()), pa.array(removed, kind)], names=[*batch.schema.names[:carried], "text", "removed"])

    return run


def substring_dedup(docs: DataFrame, carry: list[str] | None = None, run: int = RUN, line: int = LINE) -> DataFrame:
    """doc_id, the text without repeats, removed (spans in the original), n_removed and removed_chars of every row.

    A null text stays null with nothing removed, and so does an empty one.  Null doc_ids rank last.  Rows that repeat
    both doc_id and text are one document: they rank alike and get equal results.  Very long
    texts are cut into units whole.  Extra columns are ignored unless carried; an empty table
    gives an empty result.
    """
    carry = ["doc_id", *[c for c in carry or [] if c not in ("doc_id", "text", "removed", "n_removed", "removed_chars")]]
    key = F.xxhash64("doc_id", "text").alias("key")
    units = docs.where("text is not null").select("doc_id", key, "text").mapInArrow(_units, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, pos int, h1 long, h2 long")
    rank = F.struct(F.col("doc_id").isNull().alias("unset"), "doc_id", "key", "pos")
    seen = units.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).where("first <> last").select("h1", "h2", "first")
    # AQE splits the unit side of this join where a digest is very common.
    repeats = units.join(seen, ["h1", "h2"]).where(rank != F.col("first"))
    per_doc = repeats.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("repeats")).select(F.col("doc_id").alias("of"), F.col("key").alias("of_key"), "repeats")
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    met = docs.withColumn("_key", F.xxhash64("doc_id", "text")).join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("_key") == F.col("of_key")), "left")
    done = met.select(*carry, "text", "repeats").mapInArrow(_cut(len(carry), run, line), f"{schema}, text string, removed array<struct<start:int,end:int>>")
    return done.withColumn("n_removed", F.size("removed")).withColumn("removed_chars", F.aggregate("removed", F.lit(0), lambda s, x: s + x["end"] - x["start"]))
