"""MinHash near-deduplication by a chosen-path set similarity join.

Every text is reduced to its distinct 5-word shingles and K minwise tokens.  Texts with the
same shingle set form one class, and only classes are compared.  A tree node branches on one
of the K coordinates, chosen by a hash of the node's path: classes go on together as long as
they have the same minwise token there.  Small nodes (LEAF classes and WEIGHT shingles) are
compared exhaustively, larger ones branch on, in TREES independent trees.  Every pair with an
estimate of EST or more is tested on the full shingle sets, unless links confirmed before
already connect it.

Large nodes.  Copies of one text agree nearly everywhere, so branching alone would not part
them.  Each large node is first dealt into groups of the small size that share the node's
leader and are compared exhaustively.  Only confirmed links then prune: a node that is one
confirmed component is dropped, and of the others only pairs with a class outside the node's
largest component are left.  If LEAF such classes or fewer are left, or at the last level, the
node is compared whole, in blocks: every pair of a left class with any class of the node meets
in a block, so nothing is capped.

Scale: classes are a partial aggregation, so thousands of copies are one row per map task.
Nodes are counted by partial aggregates and joined back (a skewed left side of an inner join).
Nodes meet as tokens (256 bytes a class); only classes with a pair to confirm fetch their sets,
in groups that several trees share, and a group gives fewer links than it has classes.

Recall: a pair of similarity s misses the first branch of all trees with (1 - s) ** TREES,
1.5e-5 at 0.75; below, BRANCHES independent branches a level keep it with 0.89 a tree
(1.5e-4 are missed over all trees).  The estimate falls below EST with about 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import materialise
from docengine.llm.components import components
from docengine.llm.textkit import LOWER_CODES, buffers, hash_spans, mix, shingle_sets, slices, words

WIDTH = 5
PERCENT = 75
K = 64
TREES = 8
LEAF = 2048
WEIGHT = 2_000_000
BRANCHES = 2
DEPTH = 6
EST = 0.5

_A = mix(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def column_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The shingle set of every text of an Arrow column, in bounded slices."""
    raw, off = buffers(column)
    for i, j in slices(off):
        part, at = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        starts, ends, first = words(part, at)
        yield from shingle_sets(hash_spans(part, starts, ends, LOWER_CODES), first, width)


def minwise(own: np.ndarray) -> np.ndarray:
    """K minwise tokens of a set, 31 bits each."""
    best = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(own), 2048):
        np.minimum(best, (own[None, i : i + 2048] * _A[:, None]).min(axis=1), out=best)
    return (best >> np.uint64(33)).astype(np.int32)


def set_key(own: np.ndarray) -> tuple[int, int]:
    """128 order-free bits that name a set."""
    if not len(own):
        return 0, 0
    a, b = mix(own + np.uint64(0x1234567)).sum(dtype=np.uint64), mix(own ^ np.uint64(0xABCDEF0123456789)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _describe(carried: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k1, k2, tokens = [], [], [], []
            for own in column_sets(batch.column(carried), width):
                a, b = set_key(own)
                n.append(len(own))
                k1.append(a)
                k2.append(b)
                tokens.append(minwise(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:carried], *batch.columns[carried + 1 :], pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(tokens, pa.binary())],
                names=[*batch.schema.names[:carried], *batch.schema.names[carried + 1 :], "n_shingles", "k1", "k2", "tokens"],
            )

    return run


def _text_key() -> list:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), F.reverse("text")).alias("t2")]


def _token(at: Column) -> Column:
    """The token at coordinate ``at`` as its four bytes."""
    return F.substring(F.col("tokens"), at * 4 + 1, 4)


def _node_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list]:
    """Lists of column arrays, one for each run of equal (key, part), from sorted batches.  Runs are small by construction."""
    held: list[pa.RecordBatch] = []

    def runs(table: pa.Table, last: bool):
        key = table.column("key").to_numpy()
        part = table.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1), len(key)]
        stop = len(cuts) - 1 if last else len(cuts) - 2
        columns = [table.column(c).to_numpy() for c in names]
        for a, b in zip(cuts[:stop], cuts[1 : stop + 1]):
            if b - a > 1:
                yield [c[a:b] for c in columns]
        return cuts[stop]

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None and rest.num_rows else table
        at = yield from runs(table, False)
        rest = table.slice(at)
    if rest is not None and rest.num_rows:
        yield from runs(rest.combine_chunks(), True)


def _near(tokens: np.ndarray, rest: np.ndarray, comp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (rows, matrix) of the pairs that count: estimate EST or more, a side in ``rest``, different components."""
    turned = np.ascontiguousarray(tokens.T)
    step = max(1, (1 << 20) // len(tokens))
    for i in range(0, len(tokens), step):
        rows = np.arange(i, min(i + step, len(tokens)))
        rows = rows[rest[rows]]
        if len(rows):
            same = np.zeros((len(rows), len(tokens)), np.uint8)
            for own in turned:
                same += own[rows, None] == own
            yield rows, (same >= EST * K) & (comp[rows, None] != comp)


def _joined(cluster: np.ndarray, i: int, hit: np.ndarray) -> np.ndarray:
    """``cluster`` with the clusters of ``hit`` merged into that of ``i``."""
    return np.where(np.isin(cluster, cluster[hit]), cluster[i], cluster)


def _active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of a node that have a pair to confirm, as one group for each set of classes that such pairs connect.

    A group is named by its members, so trees that find the same one share it.
    """
    out: list[np.ndarray] = []

    def flush():
        a = np.concatenate(out, axis=1)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(a[0]), pa.array(a[1]), pa.array(a[2]), pa.array(a[3].astype(bool))], names=["grp", "cid", "comp", "rest"])

    for cid, comp, rest, raw in _node_groups(batches, ["cid", "comp", "rest", "tokens"]):
        tokens = np.frombuffer(b"".join(raw), np.int32).reshape(len(cid), K)
        cluster = np.arange(len(cid))
        for rows, near in _near(tokens, rest, comp):
            for i, hits in zip(rows, near):
                hit = np.flatnonzero(hits)
                if len(hit) and (cluster[hit] != cluster[i]).any():
                    cluster = _joined(cluster, i, hit)
        names, of, size = np.unique(cluster, return_inverse=True, return_counts=True)
        marks = mix(cid.astype(np.uint64) * np.uint64(2) + rest.astype(np.uint64))
        name = np.zeros(len(names), np.uint64)
        np.add.at(name, of, marks)
        good = size[of] > 1
        if good.any():
            out.append(np.stack([mix(name)[of][good].view(np.int64), cid[good].astype(np.int64), comp[good].astype(np.int64), rest[good].astype(np.int64)]))
        if len(out) > 5000:
            yield flush()
    if out:
        yield flush()


def confirm(cid: np.ndarray, comp: np.ndarray, rest: np.ndarray, tokens: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what the true pairs among those that count (see _near) connect; fewer than there are classes.

    Shingles are numbered within the group, so one class is tested against all its open
    partners by one pass over theirs.
    """
    size = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(size)])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    mark = np.zeros(int(ids.max()) + 1, bool)
    _, cluster = np.unique(comp, return_inverse=True)
    links = []
    for rows, near in _near(tokens, rest, comp):
        for i, hits in zip(rows, near):
            hit = np.flatnonzero(hits & (cluster != cluster[i]) & (100 * np.minimum(size, size[i]) >= PERCENT * np.maximum(size, size[i])))
            if not len(hit):
                continue
            mark[ids[at[i] : at[i + 1]]] = True
            common = np.add.reduceat(mark[np.concatenate([ids[at[j] : at[j + 1]] for j in hit])], np.concatenate([[0], np.cumsum(size[hit])[:-1]]), dtype=np.int64)
            mark[ids[at[i] : at[i + 1]]] = False
            for j in hit[100 * common >= PERCENT * (size[i] + size[hit] - common)]:
                if cluster[j] != cluster[i]:
                    links.append((min(cid[i], cid[j]), max(cid[i], cid[j])))
                    cluster = _joined(cluster, i, np.array([j]))
    return links


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed links of the groups."""
    found: list[tuple[int, int]] = []

    def flush():
        a = np.array(found, np.int64)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["c1", "c2"])

    for cid, comp, rest, raw, packed in _node_groups(batches, ["cid", "comp", "rest", "tokens", "set"]):
        tokens = np.frombuffer(b"".join(raw), np.int32).reshape(len(cid), K)
        found += confirm(cid, comp, rest, tokens, [np.frombuffer(p, np.uint64) for p in packed])
        if len(found) > 50_000:
            yield flush()
    if found:
        yield flush()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [own.tobytes() for own in column_sets(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=["cid", "tokens", "set"])


def root_coordinates() -> list[int]:
    """The coordinates that the trees' first nodes branch on, drawn without replacement."""
    return [int(x) for x in np.argsort(mix(np.arange(1, K + 1, dtype=np.uint64)))[:TREES]]


def _parts(n: Column, weight: Column) -> Column:
    """Into how many parts of LEAF classes and WEIGHT shingles something is dealt."""
    return F.greatest(F.ceil(n / LEAF), F.ceil(weight / WEIGHT), F.lit(1)).cast("int")


def _dealt(salt: int, count: Column) -> Column:
    return F.pmod(F.xxhash64("cid", F.lit(salt)), count).cast("int")


def _nodes(rows: DataFrame) -> DataFrame:
    """Rows (cid, key, size) of nodes with two classes or more, with the node's count, parts and leader."""
    stat = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("weight"), F.min("cid").alias("leader")).where("n > 1")
    return materialise(rows.join(stat.withColumn("parts", _parts(F.col("n"), F.col("weight"))), "key"))


def _groups(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Groups to confirm of rows (cid, key, part, comp, rest): nodes meet in one sorted partition."""
    met = rows.join(classes.select("cid", "tokens"), "cid").repartition("key", "part").sortWithinPartitions("key", "part")
    return met.select("key", "part", "cid", "comp", "rest", "tokens").mapInArrow(_active, "grp long, cid long, comp long, rest boolean").distinct()


def _confirmed(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links (c1, c2) of groups (grp, cid, comp, rest)."""
    met = groups.join(sets, "cid").withColumnRenamed("grp", "key").withColumn("part", F.lit(0)).repartition("key").sortWithinPartitions("key")
    return materialise(met.select("key", "part", "cid", "comp", "rest", "tokens", "set").mapInArrow(_verify, "c1 long, c2 long"))


def _whole(rows: DataFrame) -> DataFrame:
    """Rows (cid, key, part, comp, rest) of small nodes, in which every pair counts."""
    return rows.select("cid", "key", F.lit(0).alias("part"), F.col("cid").alias("comp"), F.lit(True).alias("rest"))


def _led(large: DataFrame) -> DataFrame:
    """Large nodes dealt into small groups, each with the node's leader; nodes with the same leader are one."""
    led = large.select("leader", "cid", "size").distinct()
    count = F.col("count")
    spread = F.when(F.col("cid") == F.col("leader"), F.sequence(F.lit(0), count - 1)).otherwise(F.array(_dealt(1, count)))
    stat = led.groupBy("leader").agg(_parts(F.count("*"), F.sum("size")).alias("count"))
    parts = led.join(stat, "leader").select("leader", "cid", F.explode(spread).alias("part"))
    return parts.select("cid", F.col("leader").alias("key"), "part", F.col("cid").alias("comp"), F.lit(True).alias("rest"))


def _blocks(owned: DataFrame) -> DataFrame:
    """Blocks in which every row of ``rest`` meets every row of its node.

    The node is dealt into parts by one hash and its rest into parts by another; a block holds a
    part of each.  With LEAF rows of rest or fewer that is one copy of the rest for each part.
    """
    down, over = F.col("own_parts"), F.col("rest_parts")
    mine = F.transform(F.sequence(F.lit(0), down - 1), lambda b: F.struct(b.alias("b"), _dealt(2, over).alias("a"), F.lit(True).alias("left")))
    met = F.transform(F.sequence(F.lit(0), over - 1), lambda a: F.struct(_dealt(1, down).alias("b"), a.alias("a"), F.lit(False).alias("left")))
    spread = F.when(F.col("rest"), F.concat(mine, met)).otherwise(met)
    rows = owned.select("cid", "key", "comp", F.explode(spread).alias("s"))
    part = F.hash("s.a", "s.b")
    return rows.groupBy("cid", F.xxhash64("key", "s.a", "s.b").alias("key"), part.alias("part"), "comp").agg(F.max("s.left").alias("rest"))


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirmed links between classes that connect every component that the trees find."""
    roots = root_coordinates()
    first = F.explode(F.array(*[F.xxhash64(F.lit(t), F.lit(c), _token(F.lit(c))) for t, c in enumerate(roots)]))
    rows = _nodes(classes.select("cid", F.col("n_shingles").alias("size"), first.alias("key")))
    large = rows.where("parts > 1")
    small = _whole(rows.where("parts = 1"))
    # Deeper nodes only hold classes of the large nodes, so these sets serve all levels.
    more = large.limit(1).count() > 0
    groups = materialise(_groups(small.unionByName(_led(large)) if more else small, classes))
    need = (groups.select("cid").union(large.select("cid")) if more else groups.select("cid")).distinct().join(classes.select("cid", "t1", "t2", "tokens"), "cid")
    texts = docs.where("text is not null").select(*_text_key(), "text").groupBy("t1", "t2").agg(F.first("text").alias("text"))
    sets = materialise(need.join(texts, ["t1", "t2"]).select("cid", "tokens", "text").mapInArrow(_sets, "cid long, tokens binary, set binary"))
    found = [_confirmed(groups, sets)]
    depth = 0
    while more:
        label = components(reduce(DataFrame.unionByName, found).distinct()).withColumnRenamed("id", "cid")
        owned = large.join(label, "cid", "left").select("cid", "key", "size", "n", "weight", F.coalesce("comp", "cid").alias("comp"))
        # The component with the most classes of a node counts as its dense part; any choice is right, this one leaves the least.
        sums = owned.groupBy("key", "comp").agg(F.count("*").alias("own"), F.sum("size").alias("heavy"))
        main = sums.groupBy("key").agg(F.max(F.struct("own", "heavy", "comp")).alias("main"))
        owned = materialise(
            owned.join(main, "key").where("main.own < n").select(
                "cid", "key", "size", "comp", (F.col("comp") != F.col("main.comp")).alias("rest"), _parts(F.col("n"), F.col("weight")).alias("own_parts"),
                _parts(F.col("n") - F.col("main.own"), F.col("weight") - F.col("main.heavy")).alias("rest_parts"),
            )
        )
        depth += 1
        last = depth == DEPTH
        small = _blocks(owned if last else owned.where("rest_parts = 1"))
        if not last:
            branch = F.explode(F.sequence(F.lit(1), F.lit(BRANCHES)))
            below = owned.where("rest_parts > 1").select("cid", "key", "size", branch.alias("b")).join(classes.select("cid", "tokens"), "cid")
            at = F.pmod(F.xxhash64("key", "b"), F.lit(K)).cast("int")
            rows = _nodes(below.withColumn("at", at).select("cid", "size", F.xxhash64("key", "at", F.expr("substring(tokens, at * 4 + 1, 4)")).alias("key")).distinct())
            large = rows.where("parts > 1")
            more = large.limit(1).count() > 0
            small = small.unionByName(_whole(rows.where("parts = 1")))
            small = small.unionByName(_led(large)) if more else small
        found.append(_confirmed(_groups(small.join(label.withColumnRenamed("comp", "known"), "cid", "left").withColumn("comp", F.coalesce("known", "comp")).drop("known"), classes), sets))
        more = more and not last
    return reduce(DataFrame.unionByName, found).distinct()


def near_dedup(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept.

    component_id is the smallest doc_id reachable over links of 75 percent or more.  Null and
    empty texts have no shingles, are linked with nothing and stay (component_id is their own
    doc_id).  Rows with equal sets form a component; of rows that repeat the component's
    smallest doc_id just one has kept = true.  Null doc_ids come last; a component without a
    doc_id keeps one row.  Very long texts count whole (their sets are built in slices); a text
    of fewer words than a shingle is one shingle.  Extra columns are ignored unless carried; an
    empty table gives an empty result.
    """
    carry = ["doc_id", *[c for c in carry or [] if c != "doc_id"]]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    described = docs.select(*carry, "text", *_text_key()).mapInArrow(
        _describe(len(carry), WIDTH), f"{schema}, t1 long, t2 long, n_shingles long, k1 long, k2 long, tokens binary"
    )
    rows = materialise(described.withColumn("rid", F.monotonically_increasing_id()))
    key = ["n_shingles", "k1", "k2"]
    grouped = rows.where("n_shingles > 0").groupBy(*key).agg(
        F.min("rid").alias("cid"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unset"), F.col("doc_id").alias("id"), F.xxhash64(*carry).alias("tie"), F.col("rid").alias("row"))).alias("head"),
        F.first("tokens").alias("tokens"), F.min(F.struct("t1", "t2")).alias("t"),
    )
    classes = materialise(grouped.select(*key, "cid", "head", "tokens", F.col("t.t1").alias("t1"), F.col("t.t2").alias("t2")))
    label = components(links(docs, classes)).withColumnRenamed("id", "cid")
    member = classes.select(*key, "cid", "head").join(label, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    member = materialise(member)
    heads = member.groupBy("comp").agg(F.min("head").alias("first"))
    member = member.join(heads, "comp").select(*key, "first")
    return rows.join(member, key, "left").select(
        *carry, "n_shingles", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.id")).alias("component_id"),
        F.when(F.col("first").isNull(), F.lit(True)).otherwise(F.col("rid") == F.col("first.row")).alias("kept"),
    )
