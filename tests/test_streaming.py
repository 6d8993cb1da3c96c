import time

import pytest
from builders import START, frame, mapping, message
from pyspark.sql import functions as F

from tidegate.operators import batching, checkpoints, replays
from tidegate.sources import hub
from tidegate.streaming import ingest
from tidegate.streaming.sized import SizedBatches
from tidegate.streaming.sink import TableSink, delivered, in_lanes, prepare, read_rejected, read_target

DRAIN = {"availableNow": True}


def store(spark, path, *parts):
    """One file per part, appended in order."""
    for rows in parts:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def parts(count=3, size=10, hubs=("aa",)):
    return [[message(str(i % 3), n * size + i, hub=h, seconds=n * size + i)
             for i in range(size) for h in hubs] for n in range(count)]


def run(spark, folder, pairs, run_id="r", probe=None, transform=None):
    sink = TableSink(f"{folder}/target", f"{folder}/control", f"{folder}/errors", run_id)
    if probe:
        sink.probe = probe
    query = ingest.start_ingest(hub.file_hub(spark, f"{folder}/hub", 1), pairs, sink,
                                f"{folder}/progress", DRAIN, transform=transform)
    query.awaitTermination()
    return query


def levels(spark, folder):
    log = checkpoints.read_control_table(spark, f"{folder}/control")
    return {(r.eventhub, r.partition_id): r.waterlevel
            for r in checkpoints.latest_checkpoints(log, monotone=True).collect()}


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(hubs=("aa", "bb")))
    pairs = mapping(spark, "aa")
    query = run(spark, folder, pairs)
    landed = read_target(spark, f"{folder}/target")
    whole = delivered(prepare(spark.read.parquet(f"{folder}/hub"), pairs)).drop(
        "ingestion_timestamp")
    assert landed.select(whole.columns).exceptAll(whole).isEmpty() and landed.count() == 30
    assert levels(spark, folder) == {("aa", "0"): 29, ("aa", "1"): 27, ("aa", "2"): 28}
    seen = ingest.progress(spark, query).agg(F.sum("received"), F.sum("input_rows")).first()
    assert seen[0] == 60


@pytest.mark.parametrize("step", ["data", "checkpoint"])
def test_crash_and_restart_lose_and_double_nothing(spark, tmp_path, step):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(4))

    def fail(at, batch_id):
        if at == step and batch_id == 2:
            raise RuntimeError("power cut")

    with pytest.raises(Exception, match="power cut"):
        run(spark, folder, mapping(spark, "aa"), probe=fail)
    log = spark.read.parquet(f"{folder}/errors").collect()
    seen = (None, None) if step == "data" else ("HUB_1->TARGET_1", 10)
    assert [(r.error, r.mapping_key, r.message_count) for r in log] == [("power cut", *seen)]
    run(spark, folder, mapping(spark, "aa"))
    landed = read_target(spark, f"{folder}/target")
    assert (landed.count(), landed.select("row_id").distinct().count()) == (40, 40)
    assert levels(spark, folder) == {("aa", "0"): 39, ("aa", "1"): 37, ("aa", "2"): 38}


def test_second_run_continues(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(1))
    run(spark, folder, mapping(spark, "aa"))
    store(spark, f"{folder}/hub", *parts(2)[1:])
    run(spark, folder, mapping(spark, "aa"))
    assert read_target(spark, f"{folder}/target").count() == 20


def test_empty_batches_succeed(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(1, hubs=("unmapped",)))
    run(spark, folder, mapping(spark, "aa"))
    assert not (tmp_path / "control").exists()
    kept = read_rejected(spark, f"{folder}/target").collect()
    assert [r.reasons for r in kept] == ["unroutable"] * 10
    assert {r.event_body for r in kept} == {"{}"}


@pytest.mark.parametrize("run_id", ["a=1", "r#1", "2026-12-01T10:00", "x y%z", "{a,b}*"])
def test_any_run_id_is_checkpointed(spark, tmp_path, run_id):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(2))
    run(spark, folder, mapping(spark, "aa"), run_id=run_id)
    assert levels(spark, folder) == {("aa", "0"): 19, ("aa", "1"): 17, ("aa", "2"): 18}
    assert {r.run_id for r in read_target(spark, f"{folder}/target").collect()} == {run_id}


def test_replay_after_a_change_of_mapping_doubles_nothing(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(1))

    def fail(at, batch_id):
        if at == "checkpoint":
            raise RuntimeError("power cut")

    with pytest.raises(Exception, match="power cut"):
        run(spark, folder, mapping(spark, "aa"), run_id="r:1", probe=fail)
    moved = mapping(spark, "aa").withColumn("target_table", F.lit("T_new"))
    run(spark, folder, moved, run_id="r:1")
    landed = read_target(spark, f"{folder}/target").collect()
    assert {r.target_table for r in landed} == {"T_new"} and len(landed) == 10
    log = checkpoints.read_control_table(spark, f"{folder}/control").collect()
    assert {r.target_table for r in log} == {"T_new"}


def test_batches_and_progress_are_logged(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(3, hubs=("aa", "bb")))
    listener = ingest.ProgressLog(spark, f"{folder}/progress_log")
    spark.streams.addListener(listener)
    try:
        sink = TableSink(f"{folder}/target", f"{folder}/control", batches=f"{folder}/batches")
        query = ingest.start_ingest(hub.file_hub(spark, f"{folder}/hub", 1),
                                    mapping(spark, "aa", "bb"), sink, f"{folder}/p", DRAIN)
        query.awaitTermination()
        for _ in range(100):
            if (tmp_path / "progress_log").exists() and spark.read.parquet(
                    f"{folder}/progress_log").count() >= 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    rows = spark.read.parquet(f"{folder}/batches").collect()
    assert sorted((r.mapping_key, r.batch_id, r.message_count) for r in rows) == [
        (f"HUB_{h}->TARGET_{h}", b, 10) for h in (1, 2) for b in range(3)]
    assert all(r.started_at <= r.finished_at for r in rows)
    logged = spark.read.parquet(f"{folder}/progress_log")
    assert logged.agg(F.sum("received")).first()[0] == 60


def test_user_step_on_a_batch(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(1))
    run(spark, folder, mapping(spark, "aa"),
        transform=lambda df: df.withColumn("event_body", F.lit("seen")))
    got = read_target(spark, f"{folder}/target").select("event_body").distinct().collect()
    assert got == [("seen",)]


def test_one_failing_mapping_leaves_the_others(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(1, hubs=("aa", "bb")))

    def sink(key):
        made = TableSink(f"{folder}/target", f"{folder}/control", run_id=key.split("->")[0])
        if key.startswith("HUB_2"):
            def fail(step, batch_id):
                raise RuntimeError("target gone")
            made.probe = fail
        return made

    pairs = mapping(spark, "aa", "bb")
    queries = ingest.start_per_mapping(hub.file_hub(spark, f"{folder}/hub"), pairs,
                                       ["HUB_1->TARGET_1", "HUB_2->TARGET_2"], sink,
                                       f"{folder}/progress", DRAIN)
    with pytest.raises(RuntimeError, match="HUB_2->TARGET_2"):
        ingest.wait_all(queries)
    assert {r.target_table for r in read_target(spark, f"{folder}/target").collect()} == {"T_aa"}


def test_graceful_stop(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(1))
    query = ingest.start_ingest(
        hub.file_hub(spark, f"{folder}/hub"), mapping(spark, "aa"),
        TableSink(f"{folder}/target", f"{folder}/control"), f"{folder}/progress",
        {"processingTime": "0 seconds"})
    query.processAllAvailable()
    ingest.stop_gracefully(query)
    assert not query.isActive
    assert read_target(spark, f"{folder}/target").count() == 10


def test_busy_lane_is_cut_and_ordered(spark):
    rows = frame(spark, [message("0", s) for s in range(100)]).withColumn("target_table",
                                                                          F.lit("T"))
    got = in_lanes(rows, lane_rows=10).withColumn("task", F.spark_partition_id())
    per_task = {}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for r in rows:
        per_task.setdefault(r.task, []).append(r.sequence_number)
    assert len(per_task) > 1
    assert all(s == sorted(s) for s in per_task.values())


def test_replays_inside_a_stream(spark, tmp_path):
    folder = str(tmp_path)
    store(spark, f"{folder}/hub", *parts(2), *parts(1))
    out = replays.drop_stream_replays(hub.file_hub(spark, f"{folder}/hub", 1))
    query = (out.writeStream.format("parquet").option("checkpointLocation", f"{folder}/progress")
             .trigger(**DRAIN).start(f"{folder}/out"))
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 20


def sized(spark, folder, sink, *files):
    """Feed files one by one, each as a micro-batch of its own; batch id per message."""
    for rows in files:
        store(spark, f"{folder}/hub", rows)
        query = (hub.file_hub(spark, f"{folder}/hub").writeStream.foreachBatch(sink)
                 .option("checkpointLocation", f"{folder}/progress").trigger(**DRAIN).start())
        query.awaitTermination()
    return {(r.eventhub, r.sequence_number): r.batch_id
            for r in spark.read.parquet(f"{folder}/out").collect()}


def test_sized_batches_across_micro_batches(spark, tmp_path):
    folder = str(tmp_path)
    gaps = [1, 1, 30, 2, 2, 2, 2, 50, 1, 70, 70, 1, 1, 1, 1, 1, 1, 1, 5, 40, 1]
    times = [sum(gaps[:i + 1]) for i in range(len(gaps))]
    a = [message("0", i, hub="a", seconds=t) for i, t in enumerate(times)]
    b = [message("0", i, hub="b", seconds=t) for i, t in enumerate(times[:6])]
    sink = SizedBatches(f"{folder}/out", f"{folder}/state", 5, 60)
    got = sized(spark, folder, sink, a[:2] + b[:5], a[2:8], a[8:9], a[9:15] + b[5:], a[15:])
    whole = batching.assign_batches(frame(spark, a + b), 5, 60).collect()
    assert got == {(r.eventhub, r.sequence_number): r.batch_id for r in whole}


def test_replayed_micro_batch_gets_the_same_numbers(spark, tmp_path):
    rows = frame(spark, [message("0", i, hub="a", seconds=i) for i in range(8)])
    sink = SizedBatches(str(tmp_path / "out"), str(tmp_path / "state"), 3, 60)
    for n, part in enumerate([rows.where("sequence_number < 4"),
                              rows.where("sequence_number >= 4"),
                              ]):
        sink(part, n)
        sink(part, n)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("sequence_number").collect()
    assert [r.batch_id for r in got] == [0, 0, 0, 1, 1, 1, 2, 2]
    with pytest.raises(RuntimeError):
        sink(rows, 5)


def test_silent_hub_is_closed_by_the_clock(spark, tmp_path):
    later = F.lit(START).cast("timestamp_ntz") + F.expr("INTERVAL 2 MINUTES")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for sink in (SizedBatches(out, state, 100, 60, now=later), SizedBatches(out, state, 100, 60)):
        for n in range(2):
            sink(frame(spark, [message("0", n, hub="a", seconds=n)]), n)
        got = {r.sequence_number: r.batch_id for r in spark.read.parquet(out).collect()}
        assert got == ({0: 0, 1: 1} if sink.now is not None else {0: 0, 1: 0})


def test_kafka_records_become_messages(spark):
    records = spark.createDataFrame(
        [("hub-a", 3, 17, START, 0, b"x\xff", [("k", b"old"), ("k", b"v")]),
         ("hub-a", 3, 18, START, 0, None, None), ("hub-a", 3, 19, START, 0, b"y", None)],
        "topic string, partition int, offset bigint, timestamp timestamp, timestampType int, "
        "value binary, headers array<struct<key:string,value:binary>>")
    got = hub.from_kafka(records, "ns").orderBy("sequence_number").collect()
    assert [(r.eventhub, r.partition_id, r.sequence_number, r.offset, r.properties)
            for r in got] == [("hub-a", "3", 17, "17", {"k": "v"}), ("hub-a", "3", 19, "19", {})]


def test_a_micro_batch_opens_only_its_own_folders(spark, tmp_path):
    """What a micro-batch lists is one folder per target, however many came before."""
    sink = TableSink(f"{tmp_path}/target", f"{tmp_path}/control", run_id="a b:c")
    rows = prepare(frame(spark, parts(1, 6, ("aa", "bb"))[0]),
                   mapping(spark, "aa").union(mapping(spark, "bb")))
    for batch_id in range(12):
        sink(rows, batch_id)
        folders = sink._folders(spark, batch_id)
        assert len(folders) == len({r.target_table for r in rows.select("target_table").collect()})
        assert all(f.endswith(f"batch_id={batch_id}") for f in folders)
        assert sink._mine(spark, batch_id).count() == rows.count()
    assert sink._folders(spark, 99) == [] and sink._mine(spark, 99) is None


def test_a_running_stream_leaves_no_intermediate_tables(spark, tmp_path):
    from tidegate import session

    before = len(session._GIVEN)
    sized = SizedBatches(f"{tmp_path}/out", f"{tmp_path}/state", 7)
    for batch_id, rows in enumerate(parts(3, 20)):
        sized(frame(spark, rows), batch_id)
    assert len(session._GIVEN) == before
