"""Files written from ordered pieces: a file of any length, no row or task that holds it whole.

``write`` ranges rows (path, .., piece) by path, and those of large files by their order too, sorts
them inside the partitions and hands them to a Spark data source writer.  A task streams pieces into a
temporary file and keeps none.  Files that begin and end inside a task get their name when
the task ends; what a task has of the first and the last path, which its neighbours may share,
is told to the driver by commit message (at most two entries a task).  The commit gives a file that one task
has its name, and one that several tasks share a name for each part, ``<stem>.00001<ext>`` and so
on, with an index ``<path>.parts.json`` of their order and sizes.  An aborted job or a failed task
leaves nothing but temporary files, which the driver deletes.

Folders are paths or URIs of any file system that Arrow knows, shared by driver and executors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

NAME = "ordered_files"
#: Files up to this size are written by one task.
SPLIT_BYTES = 256 << 20


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def part_name(path: str, number: int) -> str:
    head, slash, name = path.rpartition("/")
    stem, dot, ext = name.rpartition(".")
    return f"{head}{slash}{stem or ext}.{number:05d}{dot and stem and dot + ext}"


@dataclass
class Part:
    """What one task has of a path."""

    path: str
    temporary: str
    first: str
    pieces: int
    size: int


@dataclass
class Written(WriterCommitMessage):
    edges: list[Part] = field(default_factory=list)
    files: int = 0
    size: int = 0


class OrderedWriter(DataSourceWriter):
    def __init__(self, folder: str, fail_after: int | None = None) -> None:
        self.folder, self.fail_after = folder, fail_after
        self.job = f"_temporary/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        store, root = _store(self.folder)
        attempt = f"{root}/{self.job}/{uuid.uuid4().hex}"
        store.create_dir(attempt, recursive=True)
        done: list[Part] = []
        part, out, seen = None, None, 0
        try:
            for row in iterator:
                if part is None or row["path"] != part.path:
                    if out:
                        out.close()
                        if len(done) > 1:  # neither the task's first path nor its last
                            self._name(store, root, done.pop())
                    part = Part(row["path"], f"{attempt}/{seen}", str(row["ord"]), 0, 0)
                    done.append(part)
                    out = store.open_output_stream(part.temporary)
                data = bytes(row["piece"])
                out.write(data)
                part.pieces += 1
                part.size += len(data)
                seen += 1
                if self.fail_after is not None and seen > self.fail_after:
                    raise OSError("the store is full")
        finally:
            if out:
                out.close()
        return Written(done, 0, sum(p.size for p in done))

    def _name(self, store, root: str, part: Part) -> None:
        """Only whole files come here, so a second attempt of the task names the same bytes."""
        _forget(store, root, part.path)
        _move(store, part.temporary, f"{root}/{part.path}")

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.folder)
        edges: dict[str, list[Part]] = {}
        for message in messages:
            for part in message.edges if message else []:
                edges.setdefault(part.path, []).append(part)
        for path, parts in edges.items():
            _forget(store, root, path)
            if len(parts) == 1:
                _move(store, parts[0].temporary, f"{root}/{path}")
                continue
            listed = []
            for number, part in enumerate(parts, 1):  # messages come in the order of the ranges
                _move(store, part.temporary, f"{root}/{part_name(path, number)}")
                listed.append({"part": part_name(path, number).rpartition("/")[2], "first": part.first, "pieces": part.pieces, "bytes": part.size})
            with store.open_output_stream(f"{root}/{path}.parts.json") as out:
                out.write(json.dumps(listed).encode())
        self._clear(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_store(self.folder))

    def _clear(self, store, root: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{root}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.job}")
        above = f"{root}/_temporary"
        if store.get_file_info(above).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(above)):
            store.delete_dir(above)


def _forget(store, root: str, path: str) -> None:
    """Remove what an earlier write left under this path, parts included."""
    from pyarrow import fs

    index = f"{root}/{path}.parts.json"
    old = [path]
    if store.get_file_info(index).type == fs.FileType.File:
        with store.open_input_stream(index) as listed:
            old += [f"{path.rpartition('/')[0]}/{p['part']}" for p in json.loads(listed.read())] + [f"{path}.parts.json"]
    for name in old:
        if store.get_file_info(f"{root}/{name}").type == fs.FileType.File:
            store.delete_file(f"{root}/{name}")


def _move(store, a: str, b: str) -> None:
    store.create_dir(b.rpartition("/")[0], recursive=True)
    store.move(a, b)


class OrderedFiles(DataSource):
    """Options: ``path``, the folder; ``failAfter``, for tests, rows after which a task fails."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "path string, ord string, piece binary"

    def writer(self, schema: StructType, overwrite: bool) -> OrderedWriter:
        after = self.options.get("failAfter")
        return OrderedWriter(self.options["path"], None if after is None else int(after))


def write(pieces: DataFrame, folder: str, order: list[str], parts: int | None = None, split_bytes: int = SPLIT_BYTES, fail_after: int | None = None) -> None:
    """Write (path, .. order columns, piece) below ``folder``; a path's pieces follow ``order``.

    Pieces are strings or bytes; null is an empty piece.  A path of up to ``split_bytes`` is one
    file by one task; a larger one is ranged by its order as well and may become parts.  The
    larger ones are at most the total over ``split_bytes`` names, which bounds their broadcast.
    Rows that are equal in path and order stay together, in any order.  A path that exists already is
    replaced.  The pieces are evaluated twice, for their sizes and to be written.
    """
    spark = pieces.sparkSession
    spark.dataSource.register(OrderedFiles)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.withColumn("piece", F.coalesce(F.col("piece").cast("binary"), F.lit(b"")))
    large = rows.groupBy("path").agg(F.sum(F.octet_length("piece")).alias("bytes")).where(F.col("bytes") > split_bytes).select("path", F.lit(True).alias("_large"))
    rows = rows.join(F.broadcast(large), "path", "left")
    keys = [f"_k{i}" for i in range(len(order))]
    rows = rows.withColumns({k: F.when(F.col("_large"), F.col(c)) for k, c in zip(keys, order, strict=True)})
    rows = rows.repartitionByRange(n, "path", *keys).sortWithinPartitions("path", *order)
    rows = rows.select("path", F.to_json(F.struct(*order)).alias("ord"), "piece")
    writer = rows.write.format(NAME).mode("append").option("path", folder)
    (writer if fail_after is None else writer.option("failAfter", fail_after)).save()
