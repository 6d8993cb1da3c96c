"""Ranges and joins by time against plain versions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegate.operators import ranges, temporal

KEYS = ["hub"]
T0 = datetime(2024, 1, 1)


def lanes(spark, rows):
    return spark.createDataFrame(rows, "hub string, first long, last long")


def numbers(rows):
    held = {}
    for hub, first, last in rows:
        if first is not None and last is not None:
            held.setdefault(hub, set()).update(range(first, last + 1))
    return held


def random_ranges(seed, n=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        first = rng.randrange(-50, 400)
        out.append((rng.choice(["a", "b", None]), first, first + rng.choice([-1, 0, 0, 1, 5, 40])))
    return [*out, ("a", None, 3), ("c", None, None)]


@pytest.mark.parametrize("cell", [1, 7, 64, 1 << 20])
def test_merged_holds_the_same_numbers_in_fewest_ranges(spark, cell):
    rows = random_ranges(cell)
    found = [tuple(r) for r in ranges.merged(lanes(spark, rows), KEYS, cell).collect()]
    assert numbers(found) == {k: v for k, v in numbers(rows).items() if v}
    for hub, held in numbers(found).items():
        starts = sum(n - 1 not in held for n in held)
        assert sum(f[0] == hub for f in found) == starts


def test_merge_in_any_order(spark):
    a, b = lanes(spark, random_ranges(1)), lanes(spark, random_ranges(2))
    one = ranges.merged(ranges.merged(a, KEYS, 16).union(b), KEYS, 16)
    other = ranges.merged(ranges.merged(b, KEYS, 16).union(a), KEYS, 16)
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


@pytest.mark.parametrize("cell", [5, 1 << 20])
def test_gaps_and_outside(spark, cell):
    held = ranges.merged(lanes(spark, random_ranges(9, 25)), KEYS, cell)
    have = numbers([tuple(r) for r in held.collect()])
    missing = numbers([tuple(r) for r in ranges.gaps(held, KEYS, cell).collect()])
    for hub, some in have.items():
        assert missing.get(hub, set()) == set(range(min(some), max(some))) - some
    rows = [(hub, n) for hub in ("a", "b", None, "z") for n in (*range(-60, 450), None)]
    messages = spark.createDataFrame(rows, "hub string, sequence_number long")
    left = {tuple(r) for r in ranges.outside(messages, held, KEYS, cell).collect()}
    assert left == {(h, n) for h, n in rows if n not in have.get(h, set())}


def test_empty_ranges(spark):
    none = lanes(spark, [])
    assert ranges.merged(none, KEYS).collect() == ranges.gaps(none, KEYS).collect() == []


@pytest.mark.parametrize("slot_rows", [3, 10_000])
def test_as_of(spark, slot_rows):
    rng = random.Random(4)
    hubs = ["a"] * 8 + ["b", None]
    rows = [(i, rng.choice(hubs), T0 + timedelta(seconds=rng.randrange(60))) for i in range(150)]
    rows += [(900, "a", None), (901, "z", T0)]
    states = [(rng.choice(hubs), T0 + timedelta(seconds=rng.randrange(5, 60)), i)
              for i in range(40)]
    states += [("a", None, 7)]
    found = temporal.as_of(
        spark.createDataFrame(rows, "id long, hub string, ts timestamp_ntz"),
        spark.createDataFrame(states, "hub string, since timestamp_ntz, level long"),
        KEYS, "ts", "since", slot_rows)
    want = {}
    for i, hub, ts in rows:
        able = [(since, level) for h, since, level in states
                if h == hub and since is not None and ts is not None and since <= ts]
        want[i] = max(able, default=None)
    got = {r.id: r.state and (r.state.since, r.state.level) for r in found.collect()}
    assert got == want


def test_within_needs_no_nested_loop(spark):
    rng = random.Random(6)
    points = [(i, rng.choice("ab"), T0 + timedelta(seconds=rng.randrange(9000)))
              for i in range(200)]
    spans = [(i, rng.choice("ab"), T0 + timedelta(seconds=s), T0 + timedelta(seconds=s + d))
             for i in range(40) for s, d in [(rng.randrange(8000), rng.choice([-5, 0, 60, 7000]))]]
    found = temporal.within(
        spark.createDataFrame(points, "id long, hub string, ts timestamp_ntz"),
        spark.createDataFrame(spans, "span long, hub string, lo timestamp_ntz, hi timestamp_ntz"),
        KEYS, "ts", "lo", "hi", bucket_seconds=600)
    assert sorted((r.id, r.span) for r in found.collect()) == sorted(
        (i, s) for i, h, ts in points for s, g, lo, hi in spans if g == h and lo <= ts <= hi)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scratch_frees_only_its_own(spark):
    from tidegate.session import pinned, scratch, stored

    outer = stored(spark.range(5), "outer")
    with scratch(spark, "kept"):
        kept, gone = stored(spark.range(3), "kept-rows"), stored(spark.range(4), "gone-rows")
        side = pinned(spark.range(6).withColumn("x", F.lit(1)))
        assert side.count() == 6 and gone.count() == 4
        paths = [gone.inputFiles()[0], side.inputFiles()[0]]
    assert outer.count() == 5 and kept.count() == 3
    import os
    assert not any(os.path.exists(p.removeprefix("file://")) for p in paths)
