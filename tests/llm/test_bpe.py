import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from data import LONG, ROWS, documents, key
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidegate.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                            special_tokens={})
ODD = [(1, "a" * 5000, ""), (2, "ab" * 700 + "==" * 1001 + "x", ""),
       (3, "x\x1c\x1d y \x85\xa0 z \n\n  end", ""),
       (4, "".join(chr(33 + (i * i * 7 + i) % 90) for i in range(2000)), ""),
       (5, "it's we'll ²³ ½ 日本語" * 20, ""), (6, " " * 300, ""), (7, "<|endoftext|>", "")]


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("rows", [ROWS, ODD])
def test_same_ids_as_the_library_and_exact_round_trip(spark, rows):
    encoded = bpe.encode(documents(spark, rows), RANKS, public_tokenizers.PATTERN)
    got = bpe.digests(bpe.decode(encoded, RANKS)).collect()
    want = []
    for doc_id, text, _ in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids)).encode()),
                     sha((text or "").encode())))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table_and_unknown_id(spark):
    none = bpe.encode(documents(spark, []), RANKS, public_tokenizers.PATTERN)
    assert bpe.decode(none, RANKS).collect() == []
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(odd, RANKS).collect()] == [b"", b""]
    wrong = spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(wrong, RANKS).collect()


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(max_size=60), max_size=8))
def test_any_text(spark, texts):
    rows = [(i, t, "") for i, t in enumerate(texts)]
    got = bpe.decode(bpe.encode(documents(spark, rows), RANKS, public_tokenizers.PATTERN),
                     RANKS).collect()
    for row in got:
        assert bytes(row.decoded) == texts[row.doc_id].encode()
        assert list(row.ids) == LIBRARY.encode_ordinary(texts[row.doc_id])


def test_long_text_has_many_tokens():
    assert len(LIBRARY.encode_ordinary(LONG)) > 20_000


def encode_all(pieces):
    con, vocabulary = bpe._connect(RANKS), bpe.Vocabulary(RANKS)
    flat, counts = bpe._encode_pieces(con, vocabulary, np.frombuffer(b"".join(pieces), np.uint8),
                                      np.array([len(p) for p in pieces]))
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def test_long_pieces_of_few_letters():
    rng = random.Random(3)
    pieces = ["".join(rng.choice(letters) for _ in range(rng.randrange(60, 400))).encode()
              for letters in ["ab", "aeth", "=-", "etaoin shrdlu", "ing", "一二的人", " \t"]
              for _ in range(60)]
    pieces += [p.encode() for p in ("=" * 70, "=" * 1000, "-" * 130 + "=" * 130, "a" * 65)]
    assert encode_all(pieces) == [LIBRARY._encode_single_piece(p) for p in pieces]


@pytest.mark.parametrize("low, high, n", [(0x61, 0x7B, 1_000_000), (0x4E00, 0x9FA5, 350_000),
                                          (0xE01, 0xE3A, 350_000), (0x61, 0x62, 1_000_000)])
def test_a_megabyte_without_blanks(low, high, n):
    """One piece; a query for each of its tokens would take minutes."""
    rng = random.Random(4)
    piece = "".join(chr(rng.randrange(low, high)) for _ in range(n)).encode()
    began = time.process_time()
    found = encode_all([piece])
    assert time.process_time() - began < 60
    assert found == [LIBRARY._encode_single_piece(piece)]


def test_no_merge_crosses_a_cut():
    vocabulary = bpe.Vocabulary(RANKS)
    text = ("日本語テキスト the quick brown fox" * 3).encode()
    cuts = {0, len(text), *vocabulary.cuts(np.frombuffer(text, np.uint8)).tolist()}
    for low in range(len(text)):
        for high in range(low + 2, min(len(text), low + 20) + 1):
            if text[low:high] in RANKS:
                assert not cuts & set(range(low + 1, high))
