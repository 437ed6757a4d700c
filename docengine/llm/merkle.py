"""Merkle manifest of a table: leaves per row, a tree per language, one root, and a proof for every row.

Rows are hashed where they are read, so only ids and digests are shuffled.  A range exchange by
(group, doc_id) orders them; their position in the group is the row number in the partition
plus the rows of the partitions before.  Positions cut the group into aligned blocks of
``fanout ** LEVELS`` digests, and each block is one contiguous numpy matrix of 64-byte hex
rows: a level is reshaped to (parents, fanout * 64) and hashed row by row, and the siblings of
all leaves on all levels are found by index arithmetic.  Block roots are the digests of the
next round, until a group has one; the group roots are one more group.  On the way down a
block takes over the siblings above it, so a proof needs no more than its block's row.

A group of any size is many blocks, and no task holds more than a block of it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docengine.llm.common import materialise

FANOUT = 2
#: Levels of a block: 1,024 digests at fanout 2.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: str | int | None) -> bytes:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    if value is None:
        return b"-"
    data = str(value).encode()
    return b"%d:%s" % (len(data), data)


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def tampered(doc_id: int | None, by: int = 7) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % by == 0


def _leaves(fields: list[str]):
    """Leaf of every row, and the leaf that it would have with n_chars one higher where the row is chosen for tampering."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = fields.index("n_chars")
        for batch in batches:
            leaf, other = [], []
            for row in zip(*(batch.column(c) for c in fields), strict=True):
                values = [v.as_py() for v in row]
                leaf.append(digest(*map(encoded, values)))
                if tampered(values[fields.index("doc_id")]) and values[at] is not None:
                    values[at] += 1
                    other.append(digest(*map(encoded, values)))
                else:
                    other.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id"), pa.array(leaf, pa.binary()), pa.array(other, pa.binary())], names=["grp", "doc_id", "leaf", "other"])

    return run


def positions(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``pos``, their place in the group by ``order``, and ``n``, the group's size.

    The ranged rows are checkpointed, so a lost executor cannot deal them anew.  What is joined
    back is one row for each partition and group in it.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order).withColumn("at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    sizes = ranged.groupBy("part", group).agg(F.min("at").alias("low"), F.count("*").alias("k"))
    whole = Window.partitionBy(group)
    sizes = sizes.withColumns({"n": F.sum("k").over(whole), "before": F.coalesce(F.sum("k").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    sizes = sizes.select(F.col("part").alias("p_"), F.col(group).alias("g_"), "low", "n", "before")
    same = (ranged["part"] == sizes["p_"]) & ranged[group].eqNullSafe(sizes["g_"])
    return ranged.join(sizes, same).withColumn("pos", F.col("at") - F.col("low") + F.col("before")).drop("at", "part", "p_", "g_", "low", "before")


def _blocks(nodes: DataFrame, size: int, *more: str) -> DataFrame:
    """One row for each aligned block of ``size`` nodes (grp, pos, n, hex, more): arrays in the order of pos."""
    held = F.sort_array(F.collect_list(F.struct("pos", "hex", *more)))
    rows = nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block")).agg(F.first("n").alias("n"), held.alias("held"))
    # Digests of a block, side by side: the rows of a matrix.
    joined = F.concat_ws("", F.transform("held", lambda x: F.decode(x["hex"], "UTF-8"))).cast("binary")
    return rows.select("grp", "block", "n", joined.alias("hexes"), *[F.col(f"held.{c}").alias(c) for c in more])


def height(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def tree(nodes: np.ndarray, levels: int, fanout: int) -> list[np.ndarray]:
    """All levels over a (m, 64) matrix of hex digests; whole runs are reshaped, the last one may be short."""
    out = [nodes]
    for _ in range(levels):
        m = len(nodes)
        whole = m // fanout
        runs = [r.tobytes() for r in nodes[: whole * fanout].reshape(whole, fanout * 64)]
        if m % fanout:
            runs.append(nodes[whole * fanout :].tobytes())
        nodes = np.frombuffer(b"".join(hashlib.sha256(r).hexdigest().encode() for r in runs), np.uint8).reshape(-1, 64)
        out.append(nodes)
    return out


def siblings(m: int, levels: int, fanout: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the siblings of ``m`` leaves stand among all nodes of the tree, level below level.

    (index, left, right): index is (m, levels * (fanout - 1)) with -1 where a run is short, left
    counts the siblings before the node on each level, right those after it.
    """
    leaf = np.arange(m)
    index = np.full((m, levels * (fanout - 1)), -1, np.int64)
    left, right = np.zeros((m, levels), np.int64), np.zeros((m, levels), np.int64)
    base = 0
    for level in range(levels):
        run = leaf // fanout * fanout
        left[:, level] = leaf - run
        right[:, level] = np.minimum(run + fanout, m) - 1 - leaf
        for k in range(fanout - 1):
            other = run + k + (k >= leaf - run)
            index[:, level * (fanout - 1) + k] = np.where(other < m, base + other, -1)
        base += m
        leaf, m = leaf // fanout, -(-m // fanout)
    return index, left, right


#: A path upwards: for each level a byte for the siblings on the left, one for those on the right, and their digests.
def pack_path(left: list[bytes], right: list[bytes]) -> bytes:
    return bytes([len(left), len(right)]) + b"".join(left) + b"".join(right)


def unpack_path(path: bytes) -> list[tuple[bytes, bytes]]:
    out, i = [], 0
    while i < len(path):
        a, b = path[i] * 64, path[i + 1] * 64
        out.append((path[i + 2 : i + 2 + a], path[i + 2 + a : i + 2 + a + b]))
        i += 2 + a + b
    return out


def _matrix(hexes: bytes) -> np.ndarray:
    return np.frombuffer(hexes, np.uint8).reshape(-1, 64)


def _levels(n: int, levels: int, fanout: int) -> int:
    return min(levels, height(n, fanout))


def _roots(levels: int, fanout: int):
    """Root of every block, as a node of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, roots = batch.column("n").to_pylist(), []
            for n, hexes in zip(ns, batch.column("hexes"), strict=True):
                roots.append(tree(_matrix(hexes.as_py()), _levels(n, levels, fanout), fanout)[-1].tobytes())
            size = fanout**levels
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("block"), pa.array([-(-n // size) for n in ns], pa.int64()), pa.array(roots, pa.binary())], names=["grp", "pos", "n", "hex"])

    return run


def _down(levels: int, fanout: int):
    """The path of every node of a block: its siblings inside the block, then those of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, block = batch.column("n")[i].as_py(), batch.column("block")[i].as_py()
                nodes, above = _matrix(batch.column("hexes")[i].as_py()), batch.column("path")[i].as_py()
                up = _levels(n, levels, fanout)
                every = np.concatenate(tree(nodes, up, fanout))
                index, left, right = siblings(len(nodes), up, fanout)
                paths = []
                for j in range(len(nodes)):
                    path = b""
                    for level in range(up):
                        own = [every[x].tobytes() for x in index[j, level * (fanout - 1) : (level + 1) * (fanout - 1)] if x >= 0]
                        path += pack_path(own[: left[j, level]], own[left[j, level] :])
                    paths.append(path + above)
                k = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("grp")[i].as_py()] * k, batch.schema.field("grp").type), pa.array(range(block * fanout**levels, block * fanout**levels + k), pa.int64()), pa.array([nodes[j].tobytes() for j in range(k)], pa.binary()), pa.array(paths, pa.binary()), pa.array([batch.column("subroot")[i].as_py()] * k, pa.string())],
                    names=["grp", "pos", "hex", "path", "subroot"],
                )

    return run


def folded(nodes: np.ndarray, every: np.ndarray, index: np.ndarray, left: np.ndarray, right: np.ndarray, fanout: int) -> np.ndarray:
    """The block root that each leaf in ``nodes`` leads to with the original siblings."""
    at = nodes
    for level in range(left.shape[1]):
        near = index[:, level * (fanout - 1) : (level + 1) * (fanout - 1)]
        run = np.zeros((len(at), fanout, 64), np.uint8)
        rows = np.arange(len(at))
        run[rows, left[:, level]] = at
        for k in range(fanout - 1):
            run[rows, k + (k >= left[:, level])] = every[near[:, k]]
        length = 64 * (1 + left[:, level] + right[:, level])
        flat = run.reshape(len(at), -1)
        whole = [flat[i, : length[i]].tobytes() for i in range(len(at))]
        at = np.frombuffer(b"".join(hashlib.sha256(x).hexdigest().encode() for x in whole), np.uint8).reshape(-1, 64)
    return at


_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(levels: int, fanout: int, root: str):
    names = [x.split()[0] for x in _PROOFS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                nodes = _matrix(batch.column("hexes")[i].as_py())
                others, above = batch.column("other")[i].as_py(), unpack_path(batch.column("path")[i].as_py())
                up = _levels(batch.column("n")[i].as_py(), levels, fanout)
                every = np.concatenate(tree(nodes, up, fanout))
                index, left, right = siblings(len(nodes), up, fanout)
                tail = b"".join(a + b for a, b in above)
                gathered, known = every[index], index >= 0
                proofs = [hashlib.sha256((g if k.all() else g[k]).tobytes() + tail).hexdigest() for g, k in zip(gathered, known, strict=True)]
                began = np.stack([nodes[j] if x is None else np.frombuffer(x, np.uint8) for j, x in enumerate(others)])
                ends = []
                for at in folded(began, every, index, left, right, fanout):
                    at = at.tobytes()
                    for a, b in above:
                        at = digest(a, at, b)
                    ends.append(at.decode())
                k = len(nodes)
                leaves = [nodes[j].tobytes().decode() for j in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("doc_id")[i].as_py(), pa.int64()), pa.array(leaves), pa.array([batch.column("subroot")[i].as_py()] * k), pa.array([root] * k), pa.array(proofs), pa.array(ends), pa.array([e == root for e in ends])],
                    names=names,
                )

    return run


def manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text.  Groups are the values of lang, null a
    group of its own.  Rows of a group ascend by doc_id, null first; rows that repeat a doc_id
    by their leaf, and equal rows are leaves each.  A null field is hashed as ``-``, an empty text
    as ``0:``; very long texts are hashed whole, in one task each.  A row's tampered copy has
    n_chars one higher where 7 divides the checksum of its doc_id (null: of no digits) and
    n_chars is set.  A table of one row has an empty proof.  Other columns are ignored; an
    empty table gives an empty result.
    """
    size = fanout**levels
    lang = docs.schema["lang"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    # Settled before they are ranged, which looks at its input twice: texts are read and hashed once.
    rows = materialise(rows.mapInArrow(_leaves(list(FIELDS)), f"grp {lang}, doc_id long, leaf binary, other binary"))
    placed = positions(rows, "grp", "doc_id", "leaf").withColumnRenamed("leaf", "hex")

    rounds = [materialise(_blocks(placed, size, "doc_id", "other"))]

    def reduce(blocks: DataFrame, kind: str) -> tuple[list[DataFrame], DataFrame]:
        """Blocks of all rounds above ``blocks``, and the nodes that have no siblings left."""
        out = []
        while True:
            nodes = materialise(blocks.select("grp", "block", "n", "hexes").mapInArrow(_roots(levels, fanout), f"grp {kind}, pos long, n long, hex binary"))
            if (nodes.agg(F.max("n")).head()[0] or 1) <= 1:
                return out, nodes
            blocks = materialise(_blocks(nodes, size))
            out.append(blocks)

    upper, tops = reduce(rounds[0], lang)
    rounds += upper
    # Groups whose last round was an earlier one stay single nodes without siblings.
    over = positions(tops.select(F.lit(0).alias("all"), F.col("grp").alias("g"), "hex"), "all", "g")
    heads = materialise(_blocks(over.select(F.col("all").alias("grp"), "pos", "n", "hex", "g"), size, "g"))
    more, root = reduce(heads, "int")
    root = root.select(F.decode("hex", "UTF-8").alias("root")).head()
    root = root["root"] if root else ""
    paths = docs.sparkSession.createDataFrame([(0, 0, b"", "")], "grp int, pos long, path binary, subroot string")
    for blocks in reversed([heads, *more]):
        paths = _handed_down(blocks, paths, levels, fanout, "int")
    # The place of a group among the groups gives way to the group itself.
    at = heads.select((F.col("block") * size).alias("base"), F.posexplode("g").alias("k", "group")).select((F.col("base") + F.col("k")).alias("place"), "group")
    sub = paths.join(at, paths["pos"] == at["place"]).select(F.col("group").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.decode("hex", "UTF-8").alias("subroot"))
    paths = materialise(sub)
    for blocks in reversed(rounds[1:]):
        paths = _handed_down(blocks, paths, levels, fanout, lang)
    return _with_path(rounds[0], paths).mapInArrow(_proofs(levels, fanout, root), _PROOFS)


def _with_path(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the siblings above them: the path of the node that is their root."""
    up = paths.select(F.col("grp").alias("g_"), F.col("pos").alias("p_"), "path", "subroot")
    return blocks.join(up, blocks["grp"].eqNullSafe(up["g_"]) & (blocks["block"] == up["p_"])).drop("g_", "p_")


def _handed_down(blocks: DataFrame, paths: DataFrame, levels: int, fanout: int, kind: str) -> DataFrame:
    return _with_path(blocks, paths).mapInArrow(_down(levels, fanout), f"grp {kind}, pos long, hex binary, path binary, subroot string")
