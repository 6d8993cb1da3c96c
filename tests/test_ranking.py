import random
from datetime import datetime, timedelta

import pytest
from builders import frame, message
from pyspark.sql import functions as F

from tidegate.operators.ranking import ranked, slot_columns, slotted, with_arrival

DDL = "hub string, part string, t timestamp_ntz, id bigint"
T0 = datetime(2024, 1, 1)


def brute(rows, keys):
    seen, out = {}, {}
    for row in sorted(rows, key=lambda r: (r[2] is not None, r[2] or T0, r[3])):
        key = tuple(row[i] for i in keys)
        out[row] = seen.get(key, 0)
        seen[key] = out[row] + 1
    return out


def shapes():
    rng = random.Random(3)
    spread = [("a", str(i % 3), T0 + timedelta(seconds=rng.randrange(10_000)), i)
              for i in range(400)]
    one_instant = [("a", str(i % 3), T0, i) for i in range(400)]
    burst = spread[:50] + [("a", "0", T0 + timedelta(days=300, microseconds=i), 1000 + i)
                           for i in range(300)]
    hot_hub = [("hot" if i % 3 else f"h{i}", "0", T0 + timedelta(seconds=i % 7), i)
               for i in range(400)]
    nulls = [("a" if i % 2 else None, None if i % 5 else "1", None if i % 4 == 0 else T0, i)
             for i in range(300)]
    return {"spread": spread, "one_instant": one_instant, "burst": burst, "hot_hub": hot_hub,
            "nulls": nulls}


@pytest.mark.parametrize("shape", list(shapes()))
def test_row_numbers_equal_a_plain_count(spark, shape):
    rows = shapes()[shape]
    df = spark.createDataFrame(rows, DDL)
    got = ranked(df, {"arrival": ["hub"], "seq": ["hub", "part"]}, ["t", "id"], ["t", "id"],
                 slot_rows=20)
    assert not slot_columns(got)
    by_hub, by_part = brute(rows, [0]), brute(rows, [0, 1])
    found = {tuple(r)[:4]: (r.arrival, r.seq) for r in got.collect()}
    assert found == {r: (by_hub[r], by_part[r]) for r in rows}


@pytest.mark.parametrize("shape", ["spread", "one_instant", "burst", "hot_hub"])
def test_slots_stay_small(spark, shape):
    df, counts, parts = slotted(spark.createDataFrame(shapes()[shape], DDL), ["hub"], ["t", "id"], 20)
    sizes = [r["count"] for r in df.groupBy("hub", *slot_columns(df)).count().collect()]
    assert max(sizes) <= 20
    assert counts.count() == parts
    assert counts.agg({"_rows": "sum"}).first()[0] == df.count()


def test_nothing_is_cut_when_groups_are_small(spark):
    df, _, _ = slotted(spark.createDataFrame(shapes()["spread"], DDL), ["hub"], ["t"], 1000)
    assert not slot_columns(df)


def test_arrival_of_messages(spark):
    from builders import frame, message
    rows = [message("0", 5, seconds=3), message("1", 1, seconds=1), message("0", 4, seconds=2)]
    got = with_arrival(frame(spark, rows), ["eventhub"], slot_rows=1)
    assert [(r.sequence_number) for r in got.orderBy("arrival").collect()] == [1, 4, 5]


def test_hot_instant_is_cut_through_the_default_tie(spark):
    rows = [message(f"partition-{i % 7}", i, seconds=None if i % 3 == 0 else 5)
            for i in range(3000)]
    got = with_arrival(frame(spark, rows), ["eventhub"], slot_rows=100).collect()
    order = sorted(got, key=lambda r: (r.enqueued_time is not None, r.partition_id,
                                       r.sequence_number))
    assert [r.arrival for r in order] == list(range(3000))
    assert not slot_columns(frame(spark, rows))
    df, counts, _ = slotted(frame(spark, rows).withColumn("_rank_partition_id", F.substring(
        "partition_id", 11, 1).cast("int")), ["eventhub"],
        ["enqueued_time", "_rank_partition_id", "sequence_number"], 100)
    largest = counts.groupBy(*slot_columns(df)).agg(F.sum("_rows").alias("n")).agg(
        F.max("n")).first()[0]
    assert largest <= 100
