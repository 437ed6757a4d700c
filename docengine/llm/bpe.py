"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by a UTF-8 state machine.

A token sequence is the BPE encoding of its bytes exactly if each token follows its
predecessor in the encoding of the two alone.  So the encoding of every prefix ends in one
token that only depends on the encodings of shorter prefixes, and a finite state suffices:
the last token that is certain, and the bytes after it.  Reading a byte finds the last token
of the longer prefix; as soon as every token that could still cover the end starts at or
after a boundary, the tokens before the boundary are certain and are emitted.  The pending
bytes, the lookahead, never exceed a few token lengths.  States and transitions are built
when first met and kept in tables of bounded size, which a worker keeps from task to task.
A state knows where tokens may still begin and how far each is in a tree of the vocabulary,
so a new byte only looks there; the last byte of a piece needs no state.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

STATES = 60_000
PIECES = 450_000
CHUNK = 50_000  # pieces or tokens that are handled at once


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """The merges in compiled form: which tokens are their own encoding, and the join each ends with."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=-1) + 1
        self.token = [b""] * size
        self.halves = [(k, k) for k in range(size)]
        self.good: dict[bytes, int] = {}
        for token, rank in ranks.items():
            self.token[rank] = token
            parts = self.joined(token)
            if len(parts) <= 2:
                self.good[token] = rank
            if len(token) > 1 and len(parts) == 2:
                self.halves[rank] = ranks[parts[0]], ranks[parts[1]]

    def joined(self, data: bytes, least: int = 2) -> list[bytes]:
        """Join the adjacent pair of least rank until none has one or ``least`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self.ranks.get
        while len(parts) > least:
            rank, i = min((get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def encode(self, data: bytes) -> list[int]:
        """The encoding by its definition, for tests and tables."""
        return [self.ranks[p] for p in self.joined(data, 1)]

    def follows(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' bytes together gives just these tokens.

        Joins are undone from the latest to the earliest on either side of the seam.  A join
        across the seam happens if at some point it comes before all joins undone so far
        (on equal ranks, before those on its right).
        """
        token, halves, get = self.token, self.halves, self.ranks.get
        a, b, bound = left, right, 1 << 60
        open_left, open_right = len(token[a]) > 1, len(token[b]) > 1
        while True:
            across = get(token[a] + token[b])
            if across is not None and across < bound:
                return False
            if open_left and (a > b or not open_right):
                bound, a = a, halves[a][1]
                open_left = len(token[a]) > 1
            elif open_right:
                bound, b = b + 1, halves[b][0]
                open_right = len(token[b]) > 1
            else:
                return True


class Transducer:
    """Bytes of one piece in, token ids out."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.size = [len(t) for t in merges.token]
        self.child: dict[int, int] = {}  # tree of the tokens' bytes: node and byte -> node
        self.word, self.grows = [-1], [True]  # per node: the token that ends there; whether longer ones go on
        for token, rank in merges.good.items():
            node = 0
            for byte in token:
                self.grows[node] = True
                node = self.child.setdefault(node << 8 | byte, len(self.word))
                if node == len(self.word):
                    self.word.append(-1)
                    self.grows.append(False)
            self.word[node] = rank
        self.pair: dict[int, bool] = {}
        self.names: dict[tuple[int, bytes], int] = {}
        self.keys: list[tuple[int, bytes]] = []
        self.ends: list[tuple[int, ...]] = []  # per state: last token of each prefix of its pending bytes
        self.open: list[tuple[tuple[int, int], ...]] = []  # per state: where tokens may still begin, and how far they are in the tree
        self.next: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self._state((-1, b""), (-1,), ())

    def _state(self, key: tuple[int, bytes], ends: tuple[int, ...], begun: tuple[tuple[int, int], ...]) -> int:
        name = self.names.get(key)
        if name is None:
            name = self.names[key] = len(self.keys)
            self.keys.append(key)
            self.ends.append(ends)
            self.open.append(begun)
            self.next.append({})
        return name

    def _trim(self) -> None:
        """Forget the younger half of the states; the common ones were met first."""
        half = len(self.keys) // 2
        for key in self.keys[half:]:
            del self.names[key]
        for rows in (self.keys, self.ends, self.open, self.next):
            del rows[half:]
        for moves in self.next:
            for byte in [b for b, move in moves.items() if move[0] >= half]:
                del moves[byte]

    def _path(self, ends: tuple[int, ...], at: int) -> tuple[int, ...]:
        """The encoding of the first ``at`` pending bytes."""
        out = []
        while at > 0:
            out.append(ends[at])
            at -= self.size[ends[at]]
        return tuple(out[::-1])

    def _last(self, state: int, byte: int, begun: list[tuple[int, int]] | None = None) -> int:
        """The last token when ``byte`` follows ``state``; ``begun`` is filled with the places where tokens may still begin."""
        ends, child, word = self.ends[state], self.child, self.word
        last = -1
        for q, node in (*self.open[state], (len(ends) - 1, 0)):
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if begun is not None and self.grows[node]:
                begun.append((q, node))
            if last < 0 and word[node] >= 0:
                before, rank = ends[q], word[node]
                if before < 0:
                    fits = True
                else:
                    seam = before << 32 | rank
                    fits = self.pair.get(seam)
                    if fits is None:
                        fits = self.pair[seam] = self.merges.follows(before, rank)
                if fits:
                    last = rank
                    if begun is None:
                        break
        if last < 0:
            raise ValueError("the vocabulary lacks a byte")
        return last

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        begun: list[tuple[int, int]] = []
        last = self._last(state, byte, begun)
        left, pending = self.keys[state]
        ends = (*self.ends[state], last)
        # What the encodings up to all places where tokens may still begin share is certain.
        size, cut = self.size, len(ends) - 1
        for q, _ in begun:
            while cut != q:
                if cut > q:
                    cut -= size[ends[cut]]
                else:
                    q -= size[ends[q]]
            if not cut:
                break
        data, path = pending + bytes((byte,)), ()
        if cut:
            left, data, path = ends[cut], data[cut:], self._path(ends, cut)
            ends = (left, *ends[cut + 1 :])
            begun = [(q - cut, node) for q, node in begun]
        if data and not (begun and begun[0][0] == 0):  # no token begins at the first place any more, so it makes no difference what was before
            left, ends = -2, (-2, *ends[1:])
        move = self.next[state][byte] = self._state((left, data), ends, tuple(begun)), path
        return move

    def encode(self, piece: bytes) -> list[int]:
        if not piece:
            return []
        if len(self.keys) > STATES:
            self._trim()
        if len(self.pair) > 4 * STATES:
            self.pair.clear()
        state, out, moves = 0, [], self.next
        for byte in piece[:-1]:
            move = moves[state].get(byte) or self._step(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        # Most pieces end in a state of their own, so for the last byte none is made.
        ends = (*self.ends[state], self._last(state, piece[-1]))
        out += self._path(ends, len(ends) - 1)
        return out


class Utf8:
    """Incremental decoding: complete characters come out, the bytes of an unfinished one wait."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character and lack its continuation (0 to 3)."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= byte <= 0xDF else 3 if 0xE0 <= byte <= 0xEF else 4 if 0xF0 <= byte <= 0xF4 else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = self.unfinished(data)
        self.held = data[len(data) - keep :] if keep else b""
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class Codec:
    """Encoding and decoding of whole texts."""

    def __init__(self, merges: Merges, pattern: str):
        self.ranks = merges.ranks
        self.pattern = regex.compile(pattern)
        self.machine = Transducer(merges)
        self.tokens = merges.token
        self.pieces: dict[str, bytes] = {}

    def _learn(self, piece: str) -> bytes:
        """The ids of one piece as little-endian unsigned 32-bit integers."""
        data = piece.encode()
        rank = self.ranks.get(data)
        ids = self.machine.encode(data) if rank is None else (rank,)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids in bounded parts."""
        if len(text) <= 1 << 20:
            parts = [self.pattern.findall(text)]
        else:
            found = self.pattern.finditer(text)
            parts = iter(lambda: [m.group() for m in islice(found, CHUNK)], [])
        known = self.pieces
        for part in parts:
            new = {}
            for piece in set(part).difference(known):
                (known if len(piece) <= 32 else new)[piece] = self._learn(piece)
            if new:  # pieces that are too long to be kept
                yield b"".join([known.get(p) or new[p] for p in part])
            else:
                yield b"".join(map(known.__getitem__, part))
            if len(known) > PIECES:  # the common pieces were met first
                for piece in list(islice(known, PIECES // 2, None)):
                    del known[piece]

    def decode(self, parts: Iterable[bytes]) -> Iterator[str]:
        """Text in parts, from packed ids in parts that may cut characters anywhere."""
        stream, tokens = Utf8(), self.tokens
        for part in parts:
            ids = np.frombuffer(part, "<u4")
            for i in range(0, len(ids), CHUNK):
                yield stream.feed(b"".join(map(tokens.__getitem__, ids[i : i + CHUNK].tolist())))
        yield stream.finish()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(name: str, pattern: str, load) -> Codec:
    """One codec for each vocabulary a worker meets, so that its tables outlive a task."""
    if (name, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[name, pattern] = Codec(load(), pattern)
    return _CODECS[name, pattern]


def _run(rows: DataFrame, column: str, path: str, pattern: str, carry: list[str], extra: str, work) -> DataFrame:
    """``carry`` columns and what ``work`` makes of ``column``, with the merges compiled once and broadcast (their size is the vocabulary's)."""
    merges = Merges(read_ranks(path))
    name = hashlib.sha256(repr(sorted(merges.ranks.items())).encode()).hexdigest()
    shared = rows.sparkSession.sparkContext.broadcast(merges)
    at = len(carry)
    names = [*carry, *[c.split()[0] for c in extra.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(name, pattern, lambda: shared.value)
        collects = gc.isenabled()
        gc.disable()  # the tables have no cycles, and the collector would go through them again and again
        try:
            for batch in batches:
                for i in range(0, batch.num_rows, 512):
                    piece = batch.slice(i, 512)
                    columns = work(own, (value.as_py() for value in piece.column(at)))
                    yield pa.RecordBatch.from_arrays([*piece.columns[:at], *columns], names=names)
        finally:
            if collects:
                gc.enable()

    schema = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in carry)
    return rows.select(*carry, column).mapInArrow(run, schema + extra)


def encode(docs: DataFrame, path: str, pattern: str, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (doc_id by default) and ids array<int> of every row; a null text has no ids."""

    def work(own: Codec, texts: Iterable[str | None]):
        ids = [np.frombuffer(b"".join(own.encode(t or "")), "<u4").astype(np.int32) for t in texts]
        return [pa.array(ids, pa.list_(pa.int32()))]

    return _run(docs, "text", path, pattern, carry or ["doc_id"], "ids array<int>", work)


def decode(encoded: DataFrame, path: str, pattern: str, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns and text of every row of (.., ids); null ids give the empty text."""

    def work(own: Codec, rows: Iterable[list[int] | None]):
        return [pa.array(["".join(own.decode([np.array(ids or [], "<u4").tobytes()])) for ids in rows], pa.string())]

    return _run(encoded, "ids", path, pattern, carry or ["doc_id"], "text string", work)


def digests(docs: DataFrame, path: str, pattern: str, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns with n_tokens, ids_sha256 and decoded_sha256 of the round trip of every row.

    A null text counts as empty: no tokens.  Repeated rows get equal digests, extra columns are
    ignored unless carried, and an empty table gives an empty result.
    """

    def work(own: Codec, texts: Iterable[str | None]):
        n, ids, back = [], [], []
        for text in texts:
            parts, count, coded, plain = [], 0, hashlib.sha256(), hashlib.sha256()
            for part in own.encode(text or ""):
                parts.append(part)
                count += len(part) // 4
                coded.update(part)
            for piece in own.decode(parts):
                plain.update(piece.encode())
            n.append(count)
            ids.append(coded.hexdigest())
            back.append(plain.hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]

    return _run(docs, "text", path, pattern, carry or ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", work)
