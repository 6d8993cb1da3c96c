import random

from data import ROWS, documents

from tidegate.llm import decontamination as d


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, doc_id long")


def test_verbatim_substituted_and_clean(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(15, 60)))) for i in range(40)]
    rows, want = [], set()
    for i, text in items:
        words = text.split()
        for kind in range(3):
            doc = 10 * i + kind
            new = list(words)
            if kind == 1:                      # one word in ten is another
                for at in rng.sample(range(len(new)), len(new) // 10):
                    new[at] = "other"
            if kind == 2:
                new = rng.choices(vocabulary, k=50)
            else:
                want.add((doc, i))
            around = rng.choices(vocabulary, k=200)
            rows.append((doc, " ".join(around[:90]) + " " + " ".join(new).upper() + ", "
                         + " ".join(around[90:]), "en"))
    got = {(r.doc_id, r.item_id) for r in
           d.leaks(documents(spark, rows), benchmark(spark, items)).collect()}
    assert got == want


def test_odd_rows_salt_full_filter_and_short_items(spark, monkeypatch):
    items = [(1, None), (2, ""), (3, "tok5 tok6 tok7"), (None, " ".join(f"tok{i}" for i in range(20))),
             (5, "alpha, beta gamma"), (5, "alpha, beta gamma")]
    whole = d.leaks(documents(spark), benchmark(spark, items)).collect()
    want = {(doc, item) for item, ids in ((3, (7, 8, 9, None)), (None, (7, 8, 9, None)), (5, (1, 6)))
            for doc in ids}
    assert {(r.doc_id, r.item_id) for r in whole} == want and len(whole) == len(want)
    monkeypatch.setattr(d, "HOT_SEED", 1)            # every shared hash is salted
    monkeypatch.setattr(d, "FILTER_BITS", (6, 6))    # the filter lets all through
    salted = d.leaks(documents(spark), benchmark(spark, items)).collect()
    assert sorted(map(str, salted)) == sorted(map(str, whole))
    assert d.leaks(documents(spark, []), benchmark(spark, items)).collect() == []
    assert d.leaks(documents(spark, ROWS), benchmark(spark, [])).collect() == []


def plain_matched(item, doc):
    """Most equal words of a stretch of any alignment in which four in five words are equal."""
    best = 0
    for start in range(-len(item) + 1, len(doc)):
        same = [0 <= start + i < len(doc) and doc[start + i] == w for i, w in enumerate(item)]
        for i in range(len(item)):
            equal = 0
            for j in range(max(0, i, -start), min(len(item), len(doc) - start)):
                equal += same[j]
                if i + start >= 0 and 5 * equal >= 4 * (j + 1 - i):
                    best = max(best, equal)
    return best if 5 * best >= 4 * len(item) or best >= 12 else 0


def found(spark, docs, items):
    frame = documents(spark, [(i, t, "en") for i, t in docs])
    return {(r.doc_id, r.item_id): r.matched
            for r in d.leaks(frame, benchmark(spark, items)).collect()}


def test_seeds_find_what_every_alignment_finds(spark):
    rng = random.Random(2)
    items = [(i, rng.choices([f"w{k}" for k in range(60)], k=30)) for i in range(10)]
    docs = [(i, [w if rng.random() > 0.08 else "x" for w in words] + rng.choices(words, k=20))
            for i, words in items]
    want = {(j, i): m for j, doc in docs for i, item in items if (m := plain_matched(item, doc))}
    assert found(spark, [(j, " ".join(t)) for j, t in docs],
                 [(i, " ".join(t)) for i, t in items]) == want


def test_every_item_with_four_in_five_words_is_found(spark):
    rng = random.Random(3)
    docs, items, want = [], [], {}
    for n in [*range(1, 31), 40, 60]:
        for kind in range(6):
            at = len(items)
            item = [f"w{at}_{i}" for i in range(n)]
            gone = (range(4, n, 5) if kind == 0 else [2] if kind == 1 and n > 4
                    else rng.sample(range(n), n // 5))
            new = ["other" if i in set(gone) else w for i, w in enumerate(item)]
            items.append((at, " ".join(item)))
            docs.append((at, " ".join(["x", *new, "y"])))
            want[at, at] = n - len(set(gone))
    assert found(spark, docs, items) == want


def test_leaks_are_those_of_a_plain_count(spark):
    rng = random.Random(4)
    docs, items, want = [], [], {}
    for at in range(60):
        vocabulary = [f"w{at}_{k}" for k in range(40)]
        item = rng.choices(vocabulary, k=rng.randrange(1, 30))
        low, high = sorted(rng.sample(range(len(item) + 1), 2))
        part = [w if rng.random() > 0.22 else rng.choice(vocabulary) for w in item[low:high]]
        doc = rng.choices(vocabulary, k=10) + part + rng.choices(vocabulary, k=10)
        items.append((at, " ".join(item)))
        docs.append((at, " ".join(doc)))
        if m := plain_matched(item, doc):
            want[at, at] = m
    assert found(spark, docs, items) == want


def test_repetitive_text_and_item(spark):
    """Positions meet as two lists: 20 million products of one hash are never rows."""
    text, item = "la li " * 10_000, "la li " * 500
    assert found(spark, [(1, text), (2, "la la " * 50)], [(7, item)]) == {(1, 7): 1000}


def test_rows_without_leaks_keep_their_columns(spark):
    item = " ".join(f"q{i}" for i in range(20))
    rows = [(1, f"so {item} it goes", "en"), (2, "clean", "en"), (None, None, None), (2, "clean", "en")]
    frame = documents(spark, rows)
    got = d.without_leaks(frame, benchmark(spark, [(1, item)]))
    assert got.columns == frame.columns
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in frame.collect() if r.doc_id != 1)
