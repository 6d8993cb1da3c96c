"""The near-duplicate stage goes by op8's fingerprints first and is exact."""

import random

from data import documents

import corpus_pipeline as p
from tidegate.llm import jaccard_dedup, simhash_dedup

SF = "/root/testdata/sf0.001"


def distance(a, b):
    return bin(simhash_dedup.fingerprint(a) ^ simhash_dedup.fingerprint(b)).count("1")


def test_stage_goes_by_fingerprints_first(spark, monkeypatch):
    """Without the search by shingles, fingerprints alone link what they can, checked exactly."""
    rng = random.Random(5)
    short, long = ([f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (12, 60))
    # One word of twelve: seven in nine of the five-word shingles in common, under 80 %.
    unlike = next(t for i in range(20_000) for t in [" ".join([*short[:-1], f"o{i}"])]
                  if distance(" ".join(short), t) <= 2)
    near = next(t for i in range(20_000) for t in [" ".join([*long[:-1], f"o{i}"])]
                if distance(" ".join(long), t) <= 2)
    far = next(t for i in range(20_000) for t in [" ".join([*long[:30], f"o{i}", *long[31:]])]
               if distance(" ".join(long), t) > 2)
    docs = documents(spark, [(1, " ".join(short), "en"), (2, unlike, "en"), (4, near, "en"),
                             (4, near, "en"), (None, near, "en"), (3, " ".join(long), "en"),
                             (5, far, "en")]).select(*p.COLUMNS)

    def kept():
        return [r.doc_id for r in p.dedup_near(spark, docs, SF).orderBy("doc_id").collect()]

    assert kept() == [1, 2, 3]
    real = jaccard_dedup.open_buckets
    monkeypatch.setattr(jaccard_dedup, "open_buckets", lambda live: real(live).limit(0))
    assert kept() == [1, 2, 3, 5]


def test_stage_against_shingles_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    copies = docs.unionByName(docs.where("doc_id % 3 = 0"))
    got = [r.doc_id for r in p.dedup_near(spark, copies, SF).collect()]
    want = [r.doc_id for r in jaccard_dedup.first_of_groups(copies).collect()]
    assert sorted(got) == sorted(want) and len(got) < docs.count()
