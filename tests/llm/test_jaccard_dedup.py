import random

import numpy as np
import pyarrow as pa
from data import SCHEMA
from pyspark.sql import functions as F

import corpus_pipeline as p
from tidegate.llm import jaccard_dedup
from tidegate.llm.arrow import unpack


def plain_groups(texts):
    """The least place of the group of every text, from all pairs."""
    sets = []
    for text in texts:
        words = text.lower().split()
        n = min(5, len(words))
        sets.append({tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def edited(rng, words, edits):
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"e{rng.random()}"
    return out


def test_stage_against_all_pairs(spark):
    rng = random.Random(5)
    common = [f"c{i}" for i in range(30)]
    texts = ["", " \n", "a b", "a b", "a b c"]
    for size in (12, 40, 90, 300):
        for _ in range(8):                       # bases with copies of few and of many edits
            base = [f"w{rng.random()}" for _ in range(size)]
            texts += [" ".join(edited(rng, base, rng.randrange(0, size // 20 + 2)))
                      for _ in range(5)]
    chain = [f"k{i}" for i in range(120)]        # each like the next, not like the last
    texts += [" ".join(chain[i:i + 60]) for i in range(0, 60, 3)]
    texts += [" ".join([*common, *[f"u{rng.random()}" for _ in range(n)]])
              for n in (0, 1, 2, 4, 6, 8, 20) for _ in range(6)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "r") for i, t in enumerate(texts)],
                                 SCHEMA).select(*p.COLUMNS)
    want = plain_groups(texts)
    assert len(set(want)) < len(texts) - 40
    got = [r.doc_id for r in p.dedup_near(spark, docs, "").collect()]
    assert sorted(got) == sorted(set(want))


def sets(*texts):
    return jaccard_dedup.shingle_sets(pa.array([t.encode() for t in texts], pa.large_binary()))


def test_shingles_are_sets_of_five_words():
    assert [len(x) for x in sets(" ".join("abcdef"), "A a a a a a a", "", "x y", " \n")] == [
        2, 1, 0, 1, 0]
    assert sets("x Y z")[0].tolist() == sets("", "X  y\nZ", "q")[1].tolist()


def test_stage_with_small_slices_shards_and_hot_shingles(spark, monkeypatch):
    for name, value in (("SLICE_BYTES", 3000), ("SHARD_ENTRIES", 100), ("HOT", 3), ("LINEAR", 0),
                        ("ROUNDS", 2)):
        monkeypatch.setattr(jaccard_dedup, name, value)
    test_stage_against_all_pairs(spark)


def test_form_letters_give_few_candidates(spark, monkeypatch):
    """2,000 letters of one form, alike to 0.7, and none of them linked."""
    rng = random.Random(8)
    form = [f"f{i}" for i in range(160)]
    letters = [" ".join([*form, *[f"o{rng.random()}" for _ in range(30)]]) for _ in range(2000)]
    checked = []

    def counted(pairs, texts):
        checked.append(pairs.count())
        return real(pairs, texts)

    real = jaccard_dedup.verified
    monkeypatch.setattr(jaccard_dedup, "verified", counted)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "r") for i, t in enumerate(letters)],
                                 SCHEMA)
    a, b = sets(*letters[:2])
    assert 0.66 < len(set(a) & set(b)) / len(set(a) | set(b)) < 0.74
    assert jaccard_dedup.first_of_groups(docs).count() == 2000
    assert sum(checked) < 2 * 2000


def test_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(None, "a b c"), (None, "a b c"), (3, "A  b c"), (4, None), (5, ""), (6, long), (6, long),
            (7, long + " more"), (8, "x " * 5000), (9, "x " * 9000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1, "r") for i, t in rows], SCHEMA).select(
        "*", F.lit(1).alias("node"), F.lit(2).alias("oid"), F.lit(3).alias("none"))
    out = jaccard_dedup.first_of_groups(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 4, 6, 8]


def test_marks_bound_what_sets_share():
    rng = random.Random(3)
    for n, m, both in ((1, 1, 0), (1, 1, 1), (3, 4, 2), (127, 128, 100), (500, 610, 430),
                       (2000, 2040, 0)):
        a, b, c = (np.array(sorted(rng.getrandbits(64) for _ in range(k)), np.uint64)
                   for k in (n - both, m - both, both))
        a, b = np.sort(np.append(a, c)), np.sort(np.append(b, c))
        bits = [np.cumsum(unpack(jaccard_dedup.mark(x))[0], dtype=np.int64) for x in (a, b)]
        most = jaccard_dedup.most_shared(*bits)
        assert both <= most <= both + 0.25 * min(n, m) + 1
        assert jaccard_dedup.most_shared(bits[0], bits[0]) == n


def test_copies_in_part_send_no_texts(spark, monkeypatch):
    """Pairs alike to 0.73 meet by their first shingles; their marks rule them out, not their texts."""
    rng = random.Random(4)
    texts = []
    for _ in range(14):
        base = [f"w{rng.random()}" for _ in range(200)]
        for copy in range(6):
            words = list(base)
            for at in (10, 70, 130):
                words[at + 10 * copy] = f"e{rng.random()}"
            texts.append(" ".join(words))
    a, b = sets(*texts[:2])
    assert 0.7 < len(set(a) & set(b)) / len(set(a) | set(b)) < 0.78
    met, checked = [], []
    for name, seen in (("able_pairs", met), ("verified", checked)):
        def counted(pairs, other, real=getattr(jaccard_dedup, name, None), seen=seen):
            seen.append((pairs.count(), other.count()))
            return real(pairs, other)

        monkeypatch.setattr(jaccard_dedup, name, counted, raising=False)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "r")
                                  for i, t in enumerate([*texts, texts[0] + " end"])], SCHEMA)
    assert jaccard_dedup.first_of_groups(docs).count() == 84
    assert sum(pairs for pairs, _ in checked) <= 3 and max(held for _, held in checked) <= 4
    assert sum(pairs for pairs, _ in met) >= 30
