"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

Tokens are code points: ASCII letters in lower case, digits as one digit, white space as a
blank, and every other code point hashed to one of 2 ** BITS classes, so all scripts are
modelled.  ORDER classes make one 60-bit integer; its low bits are the shorter n-grams that
end alike, its high bits the context, so counts, contexts and suffixes are plain arithmetic.

All text is read in blocks (whole splits of the input files, dealt out by a hash so that a block
has about BLOCK bytes).  A task emits each distinct n-gram of a block once, with its count in
trusted text: the table of n-grams grows with the corpus and is written to the shared folder.  Counts, discounts and probabilities of every order are
aggregates and joins of that table on n-gram, context and suffix.  Each n-gram of the corpus,
in trusted text or not, gets its probability by the same joins, and a join back on the block
brings every block exactly the n-grams it holds; there the perplexity of each whole text is
added up.  Nothing of the model is collected or broadcast.

A text stays if its perplexity is at most the KEEP quantile of the trusted texts of its language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import fresh, materialise, remove, shared_folder
from docengine.llm.textkit import buffers, mix, slices

BITS = 12
ORDER = 5
KEEP = 0.998
SLACK = 1.05
SHORT = 12.0  # the threshold of a text of n characters grows by the share SHORT / n, as short texts vary more
ENOUGH = 50  # trusted texts a language needs for a threshold of its own
MOST_IDS = 4_000_000  # trusted ids (32 MB) up to which they are broadcast; beyond, texts and ids meet by a merge join
SLICE = 1 << 20  # bytes of text that are turned into n-grams at once; each takes about 80 bytes of memory meanwhile
BLOCK = 32 << 20  # bytes of text a block has about: what meets in one task to be scored

_ASCII = np.arange(128, dtype=np.int64)
_ASCII[65:91] += 32
_ASCII[48:58] = 48
_ASCII[[9, 10, 11, 12, 13]] = 32
_ASCII[0] = 1  # 0 is the edge before a text


def grams(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each code point, and each text's first one (n+1 values); before a text stand edges."""
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    first = heads[off]
    own = _ASCII[np.minimum(points, 127)]
    far = points > 127
    own[far] = 128 + (mix(points[far].astype(np.uint64)) % np.uint64((1 << BITS) - 128)).astype(np.int64)
    place = np.arange(len(own)) - np.repeat(first[:-1], np.diff(first))
    out = own.copy()
    for k in range(1, min(ORDER, len(own))):
        before = np.zeros(len(own), np.int64)
        before[k:] = own[:-k]
        before[place < k] = 0
        out |= before << (BITS * k)
    return out, first


def _blocked(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and text, with the block of each row: chosen by the split it comes from, or by doc_id if it comes from no file."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    source = F.when(F.input_file_name() != "", F.xxhash64(F.input_file_name(), F.input_file_block_start())).otherwise(F.xxhash64("doc_id"))
    return docs.select(*columns, "text", F.pmod(source, F.lit(-(-size // BLOCK) or 1)).alias("block"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, gram, c) of (block, trusted, text): the distinct n-grams of each block, with their trusted counts."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        codes, ids = pd.factorize(np.concatenate([g for g, _ in parts]))
        return ids, np.bincount(codes, np.concatenate([c for _, c in parts]), minlength=len(ids)).astype(np.int64)

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        trusted = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for block in np.unique(blocks):
            rows = np.flatnonzero(blocks == block)
            raw, off = buffers(batch.column(2).take(pa.array(rows)))
            for i, j in slices(off, SLICE):
                keys, first = grams(raw[off[i] : off[j]], off[i : j + 1] - off[i])
                parts = held.setdefault(int(block), [])
                parts.append(merged([(keys, np.repeat(trusted[rows[i:j]], np.diff(first)))]))
                if len(parts) > 32:
                    held[int(block)] = [merged(parts)]
    for block, parts in held.items():
        ids, c = merged(parts)
        order = np.argsort(ids)
        for i in range(0, len(ids), 200_000):
            at = order[i : i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(ids[at]), pa.array(c[at])], names=["block", "gram", "c"])


def _low(k: int) -> Column:
    """The last ``k`` tokens of an n-gram."""
    return F.col("gram").bitwiseAND(F.lit((1 << (BITS * k)) - 1))


def counts(seen: DataFrame) -> list[DataFrame]:
    """(gram, c) for each order from 1 up: raw counts at the top, numbers of distinct left neighbours below."""
    out = [materialise(seen.where("c > 0").groupBy("gram").agg(F.sum("c").alias("c")))]
    for k in range(ORDER - 1, 0, -1):
        out.append(materialise(out[-1].groupBy(_low(k).alias("gram")).agg(F.count("*").alias("c"))))
    return out[::-1]


def _discounts(level: DataFrame) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more."""
    n = level.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).head()
    if not n["n1"] or not n["n2"]:
        return [0.5, 0.5, 0.5]
    y = n["n1"] / (n["n1"] + 2 * n["n2"])
    made = [k - (k + 1) * y * n[f"n{k + 1}"] / n[f"n{k}"] if n[f"n{k}"] else 0.5 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), made)]


def probabilities(levels: list[DataFrame], needed: DataFrame) -> DataFrame:
    """(gram, p) of every n-gram in ``needed`` (gram), by joins on n-gram, context and suffix, from the lowest order up.

    An n-gram with a known context has max(c - D, 0) / total + freed / total * q, where q is its
    suffix's probability; after an unknown context it has q.  Below order 1 all classes are alike.
    """
    asked = [materialise(needed.select("gram").distinct())]
    for k in range(ORDER - 1, 0, -1):
        asked.append(materialise(asked[-1].select(_low(k).alias("gram")).distinct()))
    below = None
    for k, (level, rows) in enumerate(zip(levels, asked[::-1]), 1):
        d1, d2, d3 = _discounts(level)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        kept = level.select("gram", F.greatest(F.col("c") - cut, F.lit(0.0)).alias("kept"))
        stats = level.select(F.shiftright("gram", BITS).alias("context"), "c", cut.alias("d")).groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("freed"))
        rows = rows.join(kept, "gram", "left").withColumn("context", F.shiftright("gram", BITS)).join(stats, "context", "left")
        if below is None:
            rows = rows.withColumn("q", F.lit(1.0 / (1 << BITS)))
        else:
            rows = rows.withColumn("suffix", _low(k - 1)).join(below, "suffix")
        known = (F.coalesce("kept", F.lit(0.0)) + F.col("freed") * F.col("q")) / F.col("total")
        made = materialise(rows.select("gram", F.coalesce(known, F.col("q")).alias("p")))
        below = made.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
    return made


def _pack():
    """Rows of a block as compressed Arrow streams, one for each batch and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            blocks = batch.column(batch.num_columns - 1).to_numpy()
            names, blobs = np.unique(blocks), []
            for block in names:
                sink = pa.BufferOutputStream()
                part = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).take(pa.array(np.flatnonzero(blocks == block)))
                with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                    out.write_batch(part)
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(blobs, pa.binary())], names=["block", "rows"])

    return run


def _scored(names: list[str]):
    """Perplexities of a block's packed rows, given the probabilities of its n-grams."""

    def run(packed: pa.Table, table: pa.Table) -> pa.Table:
        keys = table.column("gram").to_numpy()
        order = np.argsort(keys)
        keys, logs = keys[order], np.log(table.column("p").to_numpy()[order])
        done = []
        for blob in packed.column("rows"):
            for batch in pa.ipc.open_stream(blob.as_py()):
                raw, off = buffers(batch.column(batch.num_columns - 1))
                size, mean = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
                for i, j in slices(off, SLICE):
                    own, first = grams(raw[off[i] : off[j]], off[i : j + 1] - off[i])
                    codes, ids = pd.factorize(own)
                    total = np.concatenate([[0.0], np.cumsum(logs[np.searchsorted(keys, ids)][codes])])
                    size[i:j] = np.diff(first)
                    mean[i:j] = (total[first[1:]] - total[first[:-1]]) / np.maximum(size[i:j], 1)
                done.append(pa.Table.from_arrays([*batch.columns[:-1], pa.array(size), pa.array(np.exp(-mean), pa.float64(), mask=size == 0)], names=names))
        return pa.concat_tables(done)

    return run


def perplexity(docs: DataFrame, trusted: DataFrame, carry: list[str], folder: str) -> DataFrame:
    """``carry`` columns, trusted, n_grams and the perplexity of every row; null for texts without a character.

    ``trusted`` (doc_id) names the texts that the model counts; ``folder`` receives the table of n-grams.
    """
    ids = trusted.select("doc_id").where("doc_id is not null").distinct()
    few = ids.count() <= MOST_IDS
    mark, block = fresh(docs, "trusted", "block")
    ids = ids.withColumn(mark, F.lit(True))
    rows = _blocked(docs, carry).withColumnRenamed("block", block)
    rows = rows.join(F.broadcast(ids) if few else ids.hint("merge"), "doc_id", "left").withColumn(mark, F.coalesce(mark, F.lit(False)))
    rows.where("text is not null").select(block, mark, "text").mapInArrow(_count, "block long, gram long, c long").write.parquet(folder)
    seen = docs.sparkSession.read.schema("block long, gram long, c long").parquet(folder)
    found = probabilities(counts(seen), seen)
    # One row for each n-gram and block; both steps use one shuffle.
    tables = seen.select("block", "gram").repartition("gram").distinct().join(found, "gram")
    inner = rows.select(*carry, mark, "text", block)
    packed = inner.mapInArrow(_pack(), "block long, rows binary")
    kinds = {f.name: f.dataType.simpleString() for f in inner.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*carry, mark])
    scored = packed.groupBy("block").cogroup(tables.groupBy("block")).applyInArrow(_scored([*carry, mark, "n_grams", "perplexity"]), f"{schema}, n_grams long, perplexity double")
    return scored.withColumnRenamed(mark, "trusted")


def quality(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, perplexity, threshold and kept of every row of ``docs``.

    Trusted texts are those that ``labels`` gives quality 1.  A text without a character has
    no perplexity and is not kept.  Languages (null is one) with fewer than ENOUGH trusted texts
    take the threshold over all; without trusted texts there is none and all texts with a
    character stay.  Very long texts are scored whole, repeated rows get equal results, extra
    columns are ignored unless carried, and an empty table gives an empty result.
    """
    carry = ["doc_id", *[c for c in carry or [] if c not in ("doc_id", "lang", "perplexity", "threshold", "kept")]]
    folder = f"{shared_folder(docs.sparkSession)}/kneser_ney-{uuid.uuid4().hex}"
    rows = materialise(perplexity(docs, labels.where("quality = 1"), [*carry, "lang"], folder))
    remove(docs.sparkSession, folder)
    trusted = rows.where("trusted and perplexity is not null")
    limit = F.percentile_approx("perplexity", KEEP, 10_000) * SLACK
    by_lang = trusted.groupBy("lang").agg(F.count("*").alias("n"), limit.alias("own")).where(F.col("n") >= ENOUGH).select(F.col("lang").alias("of"), "own")
    pooled = trusted.agg(limit.alias("pooled"))  # one row
    joined = rows.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left").join(F.broadcast(pooled), F.lit(True), "left")
    threshold = F.coalesce("own", "pooled") * (1 + F.lit(SHORT) / F.greatest(F.col("n_grams"), F.lit(1)))
    return joined.select(*carry, "perplexity", threshold.alias("threshold"), (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("kept"))
