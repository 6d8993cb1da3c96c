from datetime import timedelta

from builders import NS, START, frame, message
from pyspark.sql import functions as F

from tidegate.functions.text import with_clean
from tidegate.operators import sketches
from tidegate.schema import LANE_KEY
from tidegate.sources import hub, stored
from tidegate.streaming import events, ingest


def at(seconds):
    return START + timedelta(seconds=seconds)


def start(rows, folder):
    return (rows.writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/cp")
            .trigger(processingTime="0 seconds").start())


def test_late_rows_are_left_out_and_counted(spark, tmp_path):
    folder = str(tmp_path)
    stored.store_hub(frame(spark, [message("0", 0, seconds=5), message("0", 1, seconds=4000)]),
                     f"{folder}/hub")
    rows = events.tumbling(stored.stored_hub(spark, f"{folder}/hub"), "10 minutes", "1 minute")
    query = start(rows, folder)
    try:
        query.processAllAvailable()
        stored.store_hub(frame(spark, [message("0", 2, seconds=6), message("0", 3, seconds=9000),
                                       message("0", 4, None, seconds=None)]), f"{folder}/hub")
        query.processAllAvailable()
        late = ingest.progress(spark, query).agg(F.sum("late_rows")).first()[0]
    finally:
        query.stop()
    got = spark.read.schema(rows.schema).parquet(f"{folder}/out").collect()
    assert sorted((r.window_start, r.messages, r.last_sequence) for r in got) == [
        (START, 1, 0), (at(3600), 1, 1)]
    assert late == 1


def test_sessions_and_acknowledgements(spark, tmp_path):
    folder = str(tmp_path)
    sent = frame(spark, [message("0", n, seconds=s) for n, s in enumerate([0, 50, 99, 300, 350])])
    hub.write_hub(sent.unionByName(events.heartbeat(sent, "enqueued_time", "1 DAY")),
                  f"{folder}/hub")
    acks = spark.createDataFrame(
        [(NS, "test-hub", "0", 0, at(10)), (NS, "test-hub", "0", 1, at(50)),
         (NS, "test-hub", "0", 1, at(60)), (NS, "test-hub", "0", 2, at(500)),
         (NS, "test-hub", "0", 3, at(299)), (NS, "test-hub", None, 4, at(350))],
        "eventhub_namespace string, eventhub string, partition_id string, sequence_number bigint, "
        "acked_at timestamp_ntz")
    acks = acks.unionByName(events.heartbeat(acks, "acked_at", "1 DAY"))
    acks.write.parquet(f"{folder}/acks")
    source = hub.file_hub(spark, f"{folder}/hub")
    query = start(events.sessions(source, "60 seconds", "1 second"), f"{folder}/s")
    query.processAllAvailable()
    query.stop()
    got = [(r.window_start, r.window_end, r.messages, r.first_sequence) for r in
           spark.read.parquet(f"{folder}/s/out").collect() if r.eventhub != events.PULSE]
    assert sorted(got) == [(START, at(159), 3, 0), (at(300), at(410), 2, 3)]
    known = spark.readStream.schema(acks.schema).parquet(f"{folder}/acks")
    joined = events.with_acknowledgements(source, known, "2 MINUTES", "1 second")
    assert joined.columns == [*source.columns, "acked_at"]
    query = start(joined, f"{folder}/a")
    query.processAllAvailable()
    query.stop()
    back = spark.read.parquet(f"{folder}/a/out").where(F.col("eventhub") != events.PULSE)
    assert sorted(((r.sequence_number, r.acked_at) for r in back.collect()), key=str) == [
        (0, at(10)), (1, at(50)), (1, at(60)), (2, None), (3, None), (4, None)]


def test_heartbeat_of_nothing_is_nothing(spark):
    assert events.heartbeat(frame(spark, []), "enqueued_time", "1 DAY").isEmpty()
    one = events.heartbeat(frame(spark, [message(seconds=1)]), "enqueued_time", "1 DAY").first()
    assert [one[c] for c in LANE_KEY] == [events.PULSE] * 3
    assert one.enqueued_time == at(86401) and one.body is None


def test_sketches_merge_within_their_bounds(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 7).alias("batch"), F.lit("x").alias("k"), (F.col("id") % 9000).alias("user"),
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("amount"))
    kept = sketches.batch_sketches(rows, ["k", "batch"], F.col("user"), F.col("amount"))
    ranks = {"median": 0.5, "high": 0.9}
    for order in (kept, sketches.merged(kept.withColumn("half", F.col("batch") % 2), ["k", "half"])):
        got = sketches.estimates(sketches.merged(order, ["k"]), ranks).first()
        assert got.messages == 40_000
        assert abs(got.distinct - 9000) <= 9000 * sketches.distinct_error()
        assert abs(got.median / 40_000 - 0.5) <= sketches.RANK_ERROR
        assert abs(got.high / 40_000 - 0.9) <= sketches.RANK_ERROR
    nothing = sketches.batch_sketches(rows.limit(3), ["k"], F.lit(None).cast("string"),
                                      F.lit(None).cast("bigint"))
    assert tuple(sketches.estimates(nothing, ranks).first()) == ("x", 3, 0, None, None)


def test_nested_bytes_of_any_depth(spark):
    kinds = ("a map<binary, struct<b: array<binary>, c: map<string, array<binary>>, n: int>>, "
             "d array<struct<e: binary>>, f binary, g timestamp_ntz")
    rows = [({b"k\xff": ([b"x", None, b"\xfe"], {"m": [b"y"]}, 1)}, [(b"z",), None], None, START),
            (None, None, b"\xff\xfe", None)]
    clean = with_clean(spark.createDataFrame(rows, kinds))
    assert [r.asDict(recursive=True) for r in clean.collect()] == [
        {"a": {"k�": {"b": ["x", None, "�"], "c": {"m": ["y"]}, "n": 1}},
         "d": [{"e": "z"}, None], "f": None, "g": START},
        {"a": None, "d": None, "f": "��", "g": None}]
