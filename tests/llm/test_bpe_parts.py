"""Short pieces are cut where no token reaches across, and a part that many have is contracted once."""

import random

import numpy as np
import public_tokenizers

from tidegate.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def plain(piece):
    parts = [bytes([b]) for b in piece]
    while True:
        pairs = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                 if a + b in RANKS]
        if not pairs:
            return [RANKS[p] for p in parts]
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def encoded(pieces):
    con, vocabulary = bpe._connect(RANKS), bpe.Vocabulary(RANKS)
    flat, counts = bpe._encode_pieces(con, vocabulary, np.frombuffer(b"".join(pieces), np.uint8),
                                      np.array([len(p) for p in pieces]))
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def test_parts_are_contracted_once(monkeypatch):
    stems = [b" hearing", b"zqxj", b"\xc3\xb1cita", b"\xff\xfe"]
    pieces = [a + b + c for a in stems for b in stems for c in stems if len(a + b + c) <= 64]
    rows, real = [], bpe._contract
    monkeypatch.setattr(bpe, "_contract", lambda con, query, tokens, lengths: (
        rows.append(len(lengths)), real(con, query, tokens, lengths))[1])
    assert encoded(pieces) == [plain(p) for p in pieces]
    assert sum(rows) < len(pieces)


def test_random_short_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 300)
    monkeypatch.setattr(bpe, "QUERY_PIECES", 7)
    rng = random.Random(3)
    tokens = sorted(RANKS)
    pieces = [b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 5)))[:bpe.SHORT_BYTES]
              for _ in range(200)]
    pieces += [bytes(rng.randrange(256) for _ in range(n)) for n in range(1, 30)] + [b"aaaaaaaa", b"a"]
    assert encoded(pieces) == [plain(p) for p in pieces]
