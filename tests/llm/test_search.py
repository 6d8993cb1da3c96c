"""Search against a plain scoring of all documents."""

import math
import random
import re

import pytest
from data import documents

from tidegate.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for doc, t in held:
            m = 75 + 25 * len(t) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                    * (10**9 * t.count(w) // (1000 * t.count(w) + 12 * m))
                    for w in terms(text) if w in t)
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if none else d, -s)
                for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def got(found):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=str)


def run(spark, docs, items, k=20):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs],
                               "doc_id long, text string, m string, tf int").repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items],
                                  "item_id long, text string, score int")
    return search.search(search.build(df), asked, k)


def random_docs(n=300, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(60)],
                                     k=rng.choice([0, 1, 3, 9, 40, 300])))) for i in range(n)]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(search, "SLICE_BYTES", 2000)
    monkeypatch.setattr(search, "VISIT", 50)
    docs = random_docs()
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices([f"w{j}" for j in range(70)], k=rng.randint(1, 25))))
             for i in range(30)]
    assert got(run(spark, docs, items, k)) == brute(docs, items, k)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, "!!! ?"), (4, "Straße İSTANBUL straße"), (4, "Straße İSTANBUL straße"),
            (None, "straße"), (None, "straße"), (5, "long " * 60000 + "needle"), (6, "needle a1-b2"),
            (7, "\x00tab\tand\x7fmore")]
    items = [(1, "straße"), (2, None), (2, ""), (3, "NEEDLE needle long"), (3, "needle"),
             (None, "b2 and"), (4, "nothing of this"), (5, "i̇stanbul"), (5, "İSTANBUL")]
    assert got(run(spark, docs, items)) == brute(docs, items, 20)


def test_empty_tables(spark):
    assert got(run(spark, [], [(1, "a")])) == []
    assert got(run(spark, [(1, "a")], [])) == []
    assert got(run(spark, [(1, "?")], [(1, "a")])) == []


def test_blocks_of_items(spark, monkeypatch):
    docs = random_docs(80)
    items = [(i, f"w{i % 40} w{i % 7} w{i % 7}") for i in range(25)]
    whole = got(run(spark, docs, items))
    monkeypatch.setattr(search, "BLOCK_ITEMS", 7)
    assert got(run(spark, docs, items)) == whole == brute(docs, items, 20)
    monkeypatch.setattr(search, "BLOCK_TERMS", 3)
    assert got(run(spark, docs, items)) == whole


def test_names_that_clash(spark):
    found = search.search(search.build(documents(spark)), documents(spark).select(
        "doc_id", "text", "row"), 2, id_col="doc_id")
    assert {r.rank for r in found.collect()} == {1, 2}


def test_strata_are_skipped():
    """Once k documents score more than a stratum can, it is not looked at."""
    import pyarrow as pa

    texts = ["needle"] * 5 + ["needle " + "x " * (20 * i) for i in range(1, 200)]
    raw = pa.array([t.encode() for t in texts], pa.large_binary())
    n = sum(len(t.split()) for t in texts)
    row = search._slice_index(pa.array(range(len(texts))), raw, len(texts), n)
    batch = pa.RecordBatch.from_pydict(
        {"doc_ids": [row[0].to_pylist()],
         **{name: pa.array([x], pa.binary()) for name, x in
            zip(("terms", "strata", "groups", "postings"), row[1:], strict=True)}})
    block = search.Block([(0, 0, search.item_terms("needle"))])
    block.weight[:] = 100
    best, seen = search.Best(1, 3), {}
    old, search.VISIT = search.VISIT, 10
    try:
        search._visit(block, best, batch, 0, pa.array(block.terms, pa.large_binary()), seen)
    finally:
        search.VISIT = old
    assert best.doc.tolist() == [0, 1, 2]
    assert seen["visited"] < seen["pairs"] / 5
