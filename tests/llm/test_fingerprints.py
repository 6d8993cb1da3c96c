import hashlib
import random

from data import ROWS, documents, key

from tidegate.llm import fingerprints as f


def expected(rows):
    import xxhash

    def text_key(text):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h - (h >> 63 << 64)
    order = sorted(((d, t or "") for d, t in rows),
                   key=lambda r: (r[0] is not None, r[0] or 0, text_key(r[1])))
    out = []
    for i, (doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        q = len(text) // 4
        new = text[:len(text) - q] + after[:q]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(),
                    f.simhash(text), f.simhash(new), f.simhash(after)))
    return out


def test_every_text_meets_its_successor(spark):
    for rows in ([(d, t) for d, t, _ in ROWS], [(5, "only one")],
                 [(i * 7, f"text {i} " * (i % 9)) for i in range(200)], []):
        df = documents(spark, [(d, t, None) for d, t in rows])
        got = [tuple(r) for r in f.with_successors(df).collect()]
        assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_search_equals_all_pairs(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(5):
            fps.add(at - (at >> 63 << 64))
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                at ^= 1 << bit
    asked = sorted(fps)[::7] + [12345]
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = f.within_radius(spark.createDataFrame([(x,) for x in asked], "fp long"), frame).collect()
    want = {(a, b) for a in asked for b in fps if bin((a ^ b) % (1 << 64)).count("1") <= 3}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_a_small_edit_moves_few_bits():
    text = " ".join(f"word{i}" for i in range(400))
    near = f.simhash(text) ^ f.simhash(text + " more")
    assert bin(near % (1 << 64)).count("1") <= 8
    assert f.simhash("") == 0 == f.simhash("  ")
