"""Scores against a plain model of dictionaries."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from data import documents
from pyspark.sql import functions as F

from tidegate.llm import arrow, scoring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def quantised(p):
    return round(-math.log10(p) * scoring.STEPS)


def brute(rows):
    train = [tokens(t) for _, t, held in rows if not held]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(["\n", *t], t, strict=False))
    n, v = sum(one.values()), len(one)
    context = one | {"\n": len(train)}
    out = []
    for id_, text, held in rows:
        words = tokens(text)
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in words)
        total = 0
        for u, w in zip(["\n", *words], words, strict=False):
            q1, c = quantised((one[w] + 1) / (n + v + 1)), context.get(u, 0)
            if two[u, w]:
                p1 = 10 ** (-q1 / scoring.STEPS)
                total += quantised((two[u, w] + scoring.MU * p1) / (c + scoring.MU))
            else:
                total += quantised(scoring.MU / (c + scoring.MU)) + q1
        out.append((id_, bool(held), len(words), sum(one[w] > 0 for w in words), base,
                    -total / scoring.STEPS))
    return sorted(out, key=str), n


def check(spark, rows):
    df = spark.createDataFrame([(i, t, h, "x", 1.0) for i, t, h in rows],
                               "doc_id long, text string, held boolean, words string, base double")
    found, n = scoring.score(df.repartition(3), F.col("held"))
    want, total = brute(rows)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert n == total
    assert [(*g[:4], pytest.approx(g[4]), pytest.approx(g[5])) for g in got] == want
    return got


def corpus(n=120, seed=2):
    rng = random.Random(seed)
    words = ["the"] * 40 + [f"Word{i}" for i in range(80)]
    return [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 60]))), i % 5 == 0)
            for i in range(n)]


def test_equals_brute_force(spark):
    check(spark, corpus())


def test_many_slices_shards_and_hot_words(spark, monkeypatch):
    for name, value in (("SLICE_BYTES", 300), ("SHARD_WORDS", 40), ("SHARD_PAIRS", 200),
                        ("HOT", 5)):
        monkeypatch.setattr(scoring, name, value)
    check(spark, corpus())


def test_awkward_rows(spark):
    rows = [(1, None, False), (2, "", False), (2, "", True), (3, " \t\n ", True), (4, "a A a", False),
            (4, "a A a", False), (None, "a b", False), (None, "ü Ü \x00 b", None),
            (5, "long text " * 30000, False), (6, "never seen", True), (7, "x" * 100_000, False)]
    check(spark, rows)


def test_nothing_to_learn_and_empty_table(spark):
    check(spark, [(1, "a b", True)])
    assert check(spark, []) == []


def test_clashing_names(spark):
    found, _ = scoring.score(documents(spark), F.lit(False))
    assert found.count() == documents(spark).count()


def test_probabilities_add_up():
    """Over the known words and one unknown the mixture adds up to 1."""
    rows = corpus()
    train = [tokens(t) for _, t, held in rows if not held]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(t, t[1:], strict=False))
    n, v = sum(one.values()), len(one)
    for u in ("the", "word3"):
        total = sum((two[u, w] + scoring.MU * (c + 1) / (n + v + 1)) / (one[u] + scoring.MU)
                    for w, c in one.items())
        total += scoring.MU / (n + v + 1) / (one[u] + scoring.MU)
        assert total == pytest.approx(1)


def test_packed_arrays_come_back():
    arrays = [np.array(a, np.int64) for a in ([], [0], [255, 3], [256], [1 << 40, 0])]
    assert [a.tolist() for a in arrow.unpack(arrow.pack(*arrays))] == [
        a.tolist() for a in arrays]
