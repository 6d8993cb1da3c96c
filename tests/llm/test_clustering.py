"""Clustering against a plain Lloyd iteration, and the bounds against all distances."""

import hashlib

import numpy as np
import pytest

from tidegate.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, cells string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 9, "x") for i, v in rows], SCHEMA)


def lloyd(ids, x, k, rounds):
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), tuple(v))
                   for i, v in zip(ids, x.tolist(), strict=True) if i is not None)
    m = [list(v) for _, v in order[:k]]
    for number in range(rounds + 1):
        all_ = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in m]
                for v in x.tolist()]
        cluster = [min(range(len(m)), key=lambda c: (d[c], c)) for d in all_]
        if number == rounds:
            return cluster, [d[c] for d, c in zip(all_, cluster, strict=True)], m
        for c in range(len(m)):
            own = [v for v, o in zip(x.tolist(), cluster, strict=True) if o == c]
            if own:
                m[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return None


def run(spark, rows, size=8, k=5, rounds=4):
    df = clustering.scaled(frame(spark, rows), "vec_id", "embedding", size, 64)
    return clustering.cluster(df, size, k, rounds)


def data(n=400, size=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, size)) * 2
    return [(int(i), (centres[i % 5] + rng.normal(size=size) * (0.2 + i % 3)).tolist())
            for i in range(n)]


def test_equals_lloyd(spark):
    rows = data() + [(7, data()[7][1]), (None, [0.0] * 8), (None, [0.0] * 8)]
    found = run(spark, rows)
    out = clustering.with_inertia(found).collect()
    ids = [i for i, _ in rows]
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64)
    cluster, distance, m = lloyd(ids, x, 5, 4)
    want = sorted((str(i), c, d) for i, c, d in zip(ids, cluster, distance, strict=True))
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in out) == want
    assert found.centroids.tolist() == m
    assert {r.inertia for r in out} == {sum(distance)}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in m]
    assert all(r.centroid_sha256 == digests[r.cluster] for r in out)


def test_most_vectors_are_not_scanned_again(spark):
    found = run(spark, data(3000), rounds=6)
    assert found.scanned[0] == 3000
    assert sum(found.scanned[1:]) < 0.3 * 3000 * 6


def test_loosening_holds_and_is_less_than_full_drift():
    rng = np.random.default_rng(1)
    less = 0
    for _ in range(40):
        old = rng.normal(size=(6, 5)) * 20
        new = old + rng.normal(size=(6, 5)) * rng.uniform(0, 8)
        radius = rng.uniform(0, 15, 6)
        loss = clustering.loosening(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(1))
        assert (loss <= drift[None, :] * 1.0001).all()
        less += (loss.sum(0) < drift * 4.5).sum()
        for i in range(6):
            way = rng.normal(size=(300, 5))
            x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(
                0, 1, (300, 1)) ** 0.1
            shrunk = (np.linalg.norm(x[:, None] - old, axis=2)
                      - np.linalg.norm(x[:, None] - new, axis=2))
            assert (np.delete(shrunk - loss[i], i, 1) <= 1e-6).all()
    assert less > 20


def test_sphere_behind_the_move_loses_nothing():
    old = np.array([[0.0, 0.0], [10.0, 0.0]])
    new = np.array([[0.0, 0.0], [14.0, 0.0]])           # moves straight away
    assert clustering.loosening(old, new, np.array([3.0, 1.0]))[0, 1] == pytest.approx(0)


def test_large_components_are_exact():
    x = np.array([[clustering.LIMIT] * 4, [-clustering.LIMIT] * 4], np.int64)
    assert clustering.distances(x, x).tolist() == [[0, 4 << 56], [4 << 56, 0]]


def test_unusable_vectors_and_empty_tables(spark):
    bad = [(1, None), (2, [1.0] * 7), (3, [1.0] * 9), (4, [float("nan")] + [0.0] * 7),
           (5, [float("inf")] + [0.0] * 7), (6, [None] + [0.0] * 7), (8, [])]
    assert clustering.with_inertia(run(spark, bad)).collect() == []
    few = clustering.with_inertia(run(spark, [*bad, (7, [1e30, -1e30] + [0.5] * 6)])).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in few] == [(7, 0, 0)]
