from builders import START, frame, message
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.operators import batching


def one_by_one(times, max_size, max_wait):
    """The rule itself: append, then close when full or old."""
    ids, batch, held, created = [], 0, 0, times[0]
    for t in times:
        ids.append(batch)
        held += 1
        if held >= max_size or t - created >= max_wait:
            batch, held, created = batch + 1, 0, t
    return ids


def assigned(spark, times, max_size, max_wait, **options):
    df = frame(spark, [message("0", i, seconds=t) for i, t in enumerate(times)])
    rows = batching.assign_batches(df, max_size, max_wait, **options).collect()
    return [r.batch_id for r in sorted(rows, key=lambda r: r.sequence_number)]


def test_full_at_exactly_max_size(spark):
    assert assigned(spark, [0] * 7, 3, None) == [0, 0, 0, 1, 1, 1, 2]
    assert assigned(spark, [0] * 7, 3, 300) == [0, 0, 0, 1, 1, 1, 2]


def test_closing_message_belongs_to_the_old_batch(spark):
    assert assigned(spark, [0, 10, 300, 301, 600], 1000, 300) == [0, 0, 0, 1, 1]


def test_batch_of_one(spark):
    assert assigned(spark, [0, 1, 2], 1, 300) == [0, 1, 2]


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(gaps=st.lists(st.integers(0, 9), min_size=1, max_size=120), max_size=st.integers(1, 9),
       max_wait=st.integers(1, 25), chunk=st.integers(2, 30), fan_in=st.integers(2, 4))
def test_chunks_give_the_same_batches(spark, gaps, max_size, max_wait, chunk, fan_in):
    times = [sum(gaps[:i + 1]) for i in range(len(gaps))]
    assert assigned(spark, times, max_size, max_wait, chunk_rows=chunk, fan_in=fan_in,
                    slot_rows=25) == one_by_one(times, max_size, max_wait)


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(gaps=st.lists(st.integers(0, 9), min_size=2, max_size=60), max_size=st.integers(1, 9),
       max_wait=st.integers(1, 25), cut=st.integers(1, 59))
def test_second_half_continues_the_first(spark, gaps, max_size, max_wait, cut):
    times = [sum(gaps[:i + 1]) for i in range(len(gaps))]
    cut = min(cut, len(times) - 1)
    df = frame(spark, [message("0", i, seconds=t) for i, t in enumerate(times)])
    first = batching.assign_batches(df.where(F.col("sequence_number") < cut), max_size, max_wait)
    left = batching.open_batches(first, max_size, max_wait)
    second = batching.assign_batches(df.where(F.col("sequence_number") >= cut), max_size,
                                     max_wait, opening=left, chunk_rows=12)
    got = {r.sequence_number: r.batch_id for r in first.collect() + second.collect()}
    assert [got[i] for i in range(len(times))] == one_by_one(times, max_size, max_wait)


def test_many_chunks_and_levels(spark):
    times = [i * i % 97 + 100 * (i // 97) for i in range(2000)]
    times.sort()
    assert assigned(spark, times, 7, 60, chunk_rows=8, fan_in=3) == one_by_one(times, 7, 60)


def test_last_added_is_not_the_highest(spark):
    df = frame(spark, [message("0", s, seconds=i) for i, s in enumerate([10, 15, 12, 20, 18])])
    df = df.withColumns({"arrival": F.unix_micros(F.col("enqueued_time").cast("timestamp")),
                         "batch_id": F.lit(0)})
    assert batching.last_arrived_sequence(df).first().last_sequence == 18


def test_summary(spark):
    df = frame(spark, [message(str(i % 3), 100 + i, seconds=i) for i in range(10)])
    rows = batching.batch_summary(batching.assign_batches(df, 4, None)).orderBy("batch_id")
    assert [(r.message_count, r.partitions) for r in rows.collect()] == [
        (4, ["0", "1", "2"]), (4, ["0", "1", "2"]), (2, ["0", "2"])]
    assert rows.first().first_enqueued == START
