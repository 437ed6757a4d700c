"""The transducer makes no states that nothing reads, and encodes as the merges define."""

import random
from itertools import product

from docengine.llm import bpe


def _vocabulary(r, letters, size):
    tokens = [bytes((k,)) for k in range(256)]
    while len(tokens) < 256 + size:
        made = r.choice([*tokens[256:], *letters]) + r.choice([*tokens[256:], *letters])
        if made not in tokens and len(made) <= 7:
            tokens.append(made)
    return bpe.Merges({t: k for k, t in enumerate(tokens)})


def test_last_bytes_make_no_states():
    machine = bpe.Transducer(bpe.Merges({**{bytes((k,)): k for k in range(256)}, b"ab": 256, b"abc": 257}))
    for last in range(256):
        assert machine.encode(b"ab" + bytes((last,))) == ([257] if last == ord("c") else [256, last])
    assert len(machine.keys) <= 4 and machine.encode(b"") == []


def test_every_short_piece_is_encoded_as_defined(monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 150)
    letters = [b"a", b"b", b"c"]
    for seed in range(8):
        merges = _vocabulary(random.Random(seed), letters, 25)
        machine = bpe.Transducer(merges)
        for n in range(1, 9):
            for piece in product(b"abc", repeat=n):
                assert machine.encode(bytes(piece)) == merges.encode(bytes(piece)), (seed, bytes(piece))
