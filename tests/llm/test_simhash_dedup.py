import random

import xxhash
from data import ROWS, documents, key

from tidegate.llm import simhash_dedup
from tidegate.llm.components import components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[:i]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(set(fps))
    least = {}
    for (doc_id, _), fp in zip(rows, fps, strict=True):
        old = least.get(roots[fp])
        least[roots[fp]] = doc_id if old is None else min(old, old if doc_id is None else doc_id)
    return [(d, fp - (fp >> 63 << 64), least[roots[fp]])
            for (d, _), fp in zip(rows, fps, strict=True)]


def test_odd_rows(spark):
    got = simhash_dedup.near_duplicates(documents(spark)).collect()
    want = expected([(i, t) for i, t, _ in ROWS])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash_dedup.near_duplicates(documents(spark, [])).collect() == []


def test_documents_against_all_pairs(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in df.collect()])
    got = simhash_dedup.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_links_keep_the_components_of_all_pairs(spark):
    rng = random.Random(4)
    fps = {0, -1}
    for _ in range(30):                      # chains and clouds of near fingerprints
        at = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            fps.add(at - (at >> 63 << 64))
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                at ^= 1 << bit
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = {r.u: r.v for r in components(simhash_dedup.links(frame)).collect()}
    unsigned = {f % (1 << 64): f for f in fps}
    roots = plain_components(set(unsigned))
    for a in unsigned:
        for b in unsigned:
            same = found.get(unsigned[a], unsigned[a]) == found.get(unsigned[b], unsigned[b])
            assert same == (roots[a] == roots[b])


def test_a_crowded_half_loses_no_link_and_gives_no_pairs(spark):
    rng = random.Random(5)
    half = rng.getrandbits(32)
    fps = {half | (rng.getrandbits(9) << 32) for _ in range(400)}       # one lower half
    fps |= {half ^ (1 << rng.randrange(32)) | (rng.getrandbits(9) << 32) for _ in range(40)}
    fps |= {rng.getrandbits(64) for _ in range(60)}
    signed = [f - (f >> 63 << 64) for f in fps]
    found = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    rows = [tuple(r) for r in found.collect()]
    assert all(0 < bin((a ^ b) % (1 << 64)).count("1") <= 2 for a, b in rows)
    assert len(rows) <= 65 * 2 * len(fps)
    tops = {r.u: r.v for r in components(found).collect()}
    roots = plain_components(fps)
    for a in fps:
        for b in fps:
            x, y = a - (a >> 63 << 64), b - (b >> 63 << 64)
            assert (tops.get(x, x) == tops.get(y, y)) == (roots[a] == roots[b])


def test_fetched_links_are_all_pairs_within_the_radius(spark):
    rng = random.Random(6)
    fps = set()
    for _ in range(20):
        at = rng.getrandbits(64)
        fps |= {at ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4)))
                for _ in range(8)}
    signed = [(f - (f >> 63 << 64),) for f in fps]
    got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in
           simhash_dedup.links(spark.createDataFrame(signed, "fp long")).collect()}
    assert got == {frozenset((a, b)) for a in fps for b in fps
                   if a != b and bin(a ^ b).count("1") <= 2}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.u: r.v for r in got} == {**{i: 0 for i in range(1, 301)},
                                       **{1000 + i: 1000 for i in range(1, 400)}}
