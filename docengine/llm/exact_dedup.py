"""Exact deduplication by deterministic block naming.

The normalised text (white space deleted) is cut into blocks of ``BLOCK`` bytes.  The
distinct blocks are sorted and numbered, then adjacent names are paired and the distinct
pairs numbered again, level by level, until one name is left.  Texts are equal exactly if
they have the same number of levels and the same last name.

* Names are collision-free: a name belongs to one block *content*.  A 64-bit hash only
  addresses the distinct blocks; documents that hold a block whose hash is shared by two
  contents are named through the contents themselves.
* Block contents are deduplicated before the shuffle (partial aggregation), so a block
  that a third of all rows share is one row per map task.  Joins of names are inner sort
  merge joins, which adaptive execution splits on the side of the references.
* Upper levels carry integers only, and each level is checkpointed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import materialise
from docengine.llm.textkit import WHITE_BYTES

BLOCK = 4096
_META = "n_points long, text_sha256 string, blocks array<long>"


def _normal(text: str | None) -> bytes:
    return (text or "").encode().translate(None, WHITE_BYTES)


def _cut(data: bytes, size: int) -> list[bytes]:
    """At least one block, so that the empty text has an identity as well."""
    return [data[i : i + size] for i in range(0, len(data), size)] or [b""]


def _address(block: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(block) >> (64 - bits) if bits < 63 else xxhash.xxh64_intdigest(block) >> 1


def _references(size: int, bits: int, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, digests, blocks = [], [], []
            for value in batch.column(text):
                value = value.as_py() or ""
                data = _normal(value)
                points.append(len(value))
                digests.append(hashlib.sha256(data).hexdigest())
                blocks.append([_address(b, bits) for b in _cut(data, size)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:text], pa.array(points, pa.int64()), pa.array(digests, pa.string()), pa.array(blocks, pa.list_(pa.int64()))],
                names=[*batch.schema.names[:text], "n_points", "text_sha256", "blocks"],
            )

    return run


def _contents(size: int, bits: int):
    """Distinct blocks of each Arrow batch: what one task sends of a common block is one row a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, held = set(), 0
            for value in batch.column(0):
                for b in _cut(_normal(value.as_py()), size):
                    if b not in seen:
                        seen.add(b)
                        held += len(b)
                if held > 32 << 20:
                    yield _block_batch(seen, bits)
                    seen, held = set(), 0
            if seen:
                yield _block_batch(seen, bits)

    return run


def _block_batch(seen: set[bytes], bits: int) -> pa.RecordBatch:
    seen = sorted(seen)
    return pa.RecordBatch.from_arrays([pa.array([_address(b, bits) for b in seen], pa.int64()), pa.array(seen, pa.binary())], names=["address", "block"])


def _numbered(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys, sorted in each partition and numbered; checkpointed, so a lost executor cannot renumber them."""
    return materialise(df.select(*keys).distinct().sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()))


def _contested(docs: DataFrame, names: DataFrame, refs: DataFrame, size: int, bits: int) -> DataFrame:
    """Names by content for the positions whose address two contents share."""
    twice = names.groupBy("address").count().where("count > 1").select("address")
    digests = refs.join(twice, "address", "left_semi").select("rid", "pos", "address", "text_sha256", "n_points")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(0):
                data = _normal(value.as_py())
                own = hashlib.sha256(data).hexdigest()
                rows += [(own, i, _address(b, bits), b) for i, b in enumerate(_cut(data, size))]
            sha, pos, address, block = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(sha, pa.string()), pa.array(pos, pa.int32()), pa.array(address, pa.int64()), pa.array(block, pa.binary())], names=["text_sha256", "pos", "address", "block"])

    blocks = docs.select("text").mapInArrow(cut, "text_sha256 string, pos int, address long, block binary").join(twice, "address", "left_semi").distinct()
    named = blocks.join(names, ["address", "block"]).select("text_sha256", "pos", "name")
    return digests.join(named, ["text_sha256", "pos"]).select("rid", "pos", "name")


def identities(docs: DataFrame, carry: list[str], size: int = BLOCK, bits: int = 63) -> DataFrame:
    """``carry`` columns, rid, n_points, text_sha256 and the identity (levels, name) of every row."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    chosen = docs.select(*carry, "text")
    meta = chosen.mapInArrow(_references(size, bits, len(carry)), f"{schema}{', ' if carry else ''}{_META}")
    meta = materialise(meta.withColumn("rid", F.monotonically_increasing_id()))
    distinct = docs.select("text").mapInArrow(_contents(size, bits), "address long, block binary")
    names = materialise(distinct.distinct().sortWithinPartitions("block").withColumn("name", F.monotonically_increasing_id()))
    clash = names.groupBy("address").count().where("count > 1").limit(1).count()
    refs = meta.select("rid", "text_sha256", "n_points", F.posexplode("blocks").alias("pos", "address"))
    unique = names.select("address", "name")
    if clash:
        twice = names.groupBy("address").count().where("count > 1").select("address")
        by_address = refs.join(twice, "address", "left_anti").join(unique, "address").select("rid", "pos", "name")
        level = by_address.unionByName(_contested(docs, names, refs, size, bits))
    else:
        level = refs.join(unique, "address").select("rid", "pos", "name")
    # A document whose blocks all bear one name already is left out of the upper levels.
    longest = meta.agg(F.max(F.size("blocks"))).head()[0] or 1
    counts = meta.select("rid", F.size("blocks").alias("left"))
    done = None
    if longest > 1:
        level = materialise(level.join(counts, "rid"))
    else:
        level = level.join(counts, "rid")
    depth = 0
    while True:
        ready = level.where("left = 1").select("rid", F.lit(depth).alias("levels"), "name")
        done = ready if done is None else done.unionByName(ready)
        if longest <= 1:
            break
        half = F.expr("pos div 2").cast("int").alias("pos")
        pairs = level.where("left > 1").groupBy("rid", half).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
            F.expr("cast((max(left) + 1) div 2 as int)").alias("left"),
        )
        pairs = materialise(pairs)
        level = materialise(pairs.join(_numbered(pairs, "a", "b"), ["a", "b"]).select("rid", "pos", "name", "left"))
        longest = (longest + 1) // 2
        depth += 1
    return meta.drop("blocks").join(done, "rid")


def exact_dedup(docs: DataFrame, carry: list[str] | None = None, size: int = BLOCK, bits: int = 63) -> DataFrame:
    """One row per row of ``docs`` with keep_id, group_size, kept and text_sha256.

    A null text counts as empty and the empty texts form one group.  Of equal texts the row
    with the most code points stays, then the smallest doc_id (null last).  Rows that repeat
    the kept row's doc_id and length are told apart by the carried columns and then by their row
    number, so exactly one row of a group has kept = true.  Very long texts are many blocks.  Extra columns are ignored unless named in ``carry``; an
    empty table gives an empty result.  doc_id is null in keep_id only if all are null.
    """
    carry = ["doc_id", *[c for c in carry or [] if c != "doc_id"]]
    rows = materialise(identities(docs, carry, size, bits))
    best = rows.groupBy("levels", "name").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("unset"), F.col("doc_id").alias("id"), F.xxhash64(*carry).alias("tie"), F.col("rid").alias("row"))).alias("best"),
    )
    return rows.join(best, ["levels", "name"]).select(
        *carry, F.col("best.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.row")).alias("kept"), "text_sha256"
    )
