import time

import pytest
from builders import NS, frame, mapping, message
from pyspark.sql import functions as F

from tidegate.sources import hub, stored
from tidegate.streaming import ingest
from tidegate.streaming.sink import TableSink, read_target


def rows(low, high, hubs=("aa",), partitions=("0",)):
    return [message(p, n, hub=h, seconds=n) for n in range(low, high) for h in hubs
            for p in partitions]


class Seen:
    """What each micro-batch held."""

    def __init__(self):
        self.batches = []

    def __call__(self, df, batch_id):
        self.batches.append(sorted((r.eventhub, r.partition_id, r.sequence_number)
                                   for r in df.collect()))


def drain(messages, folder, seen):
    query = (messages.writeStream.foreachBatch(seen).option("checkpointLocation", folder)
             .trigger(processingTime="0 seconds").start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_shares_serve_short_backlogs_first():
    assert stored.shares({"a": 1, "b": 100, "c": 0}, 11) == {"a": 1, "b": 10}
    assert stored.shares({"a": 5, "b": 5}, 100) == {"a": 5, "b": 5}
    assert stored.shares({"a": 1, "b": 9, "c": 9}, 2) == {"a": 0, "b": 1, "c": 1}
    assert stored.shares({}, 5) == {}
    for limit in range(1, 40):
        given = stored.shares({"a": 3, "b": 7, "c": 20}, limit)
        assert sum(given.values()) == min(limit, 30)


def test_rows_and_types_come_back(spark, tmp_path):
    path = str(tmp_path / "hub")
    # é and a blank: folder names that must be escaped; a null body, time and map stay null.
    kept = [message("p 1", 3, hub="hub é", body=None, properties={"a": "b", "c": None}),
            message("0", 7, hub="bb", seconds=5, body=b"\xff\x00", system={})]
    stored.store_hub(frame(spark, kept), path)
    out = str(tmp_path / "out")
    query = (stored.stored_hub(spark, path).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    back = sorted(map(tuple, spark.read.parquet(out).collect()), key=lambda r: r[3])
    assert back == kept


def test_limit_new_data_and_restart(spark, tmp_path):
    path, cp, at = (str(tmp_path / n) for n in ("hub", "cp", "at"))
    stored.store_hub(frame(spark, rows(0, 20, partitions=("0", "1"))
                           + rows(0, 2, hubs=("bb",))), path, segment=8)
    seen = Seen()
    source = lambda: stored.stored_hub(spark, path, "earliest", 12, at, 5)
    drain(source(), cp, seen)
    assert [len(b) for b in seen.batches] == [12, 12, 12, 6]
    assert ("bb", "0", 1) in seen.batches[0]        # the short backlog is not starved
    stored.store_hub(frame(spark, rows(20, 40) + rows(0, 3, hubs=("new",))), path, segment=8)
    drain(source(), cp, seen)
    everything = [r for b in seen.batches for r in b]
    assert [len(b) for b in seen.batches[4:]] == [12, 11]
    assert len(everything) == len(set(everything)) == 65


def test_failed_batch_is_read_again_as_it_was(spark, tmp_path):
    path, cp, at = (str(tmp_path / n) for n in ("hub", "cp", "at"))
    stored.store_hub(frame(spark, rows(0, 30)), path)
    seen = Seen()

    def fail(df, batch_id):
        if batch_id == 1:
            raise RuntimeError("power cut")
        seen(df, batch_id)

    with pytest.raises(Exception, match="power cut"):
        drain(stored.stored_hub(spark, path, "earliest", 10, at), cp, fail)
    stored.store_hub(frame(spark, rows(30, 35)), path)
    drain(stored.stored_hub(spark, path, "earliest", 10, at), cp, seen)
    assert [[r[2] for r in b] for b in seen.batches] == [
        list(range(10)), list(range(10, 20)), list(range(20, 30)), list(range(30, 35))]


def test_starts_where_the_checkpoints_say(spark, tmp_path):
    path = str(tmp_path / "hub")
    stored.store_hub(frame(spark, rows(0, 10, partitions=("0", "1", "2"))), path)
    text = '{"aa":{"0":7,"1":-1,"2":-2}}'
    seen = Seen()
    drain(stored.stored_hub(spark, path, text), str(tmp_path / "cp"), seen)
    got = {p: [r[2] for b in seen.batches for r in b if r[1] == p] for p in "012"}
    assert got == {"0": [7, 8, 9], "1": [], "2": list(range(10))}


def test_latest_waits_for_new_messages(spark, tmp_path):
    path, seen = str(tmp_path / "hub"), Seen()
    stored.store_hub(frame(spark, rows(0, 5)), path)
    query = (stored.stored_hub(spark, path, "latest").writeStream.foreachBatch(seen)
             .option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(processingTime="0 seconds").start())
    try:
        query.processAllAvailable()
        stored.store_hub(frame(spark, rows(5, 7)), path)
        deadline = time.monotonic() + 60
        while not any(seen.batches) and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    assert [r[2] for b in seen.batches for r in b] == [5, 6]


def test_one_task_per_stretch_of_a_partition(spark, tmp_path):
    path = str(tmp_path / "hub")
    stored.store_hub(frame(spark, rows(0, 20, partitions=("0", "1"))), path, segment=6)
    reader = stored.StoredHubReader({"root": path, "task": "10"})
    begin, end = reader.initialOffset(), reader.latestOffset()
    planned = reader.partitions(begin, end)
    assert [(s.lane, s.low, s.high, len(s.folders)) for s in planned] == [
        ((NS, "aa", p), low, low + 10, 2 if low == 0 else 3) for p in "01" for low in (0, 10)]
    assert [b.num_rows for b in reader.read(planned[1])] and sum(
        b.num_rows for b in reader.read(planned[1])) == 10


def test_what_is_refused(spark, tmp_path):
    path = str(tmp_path / "hub")
    with pytest.raises(Exception, match="sequence_number"):
        stored.store_hub(frame(spark, [message("0", None)]), path)
    with pytest.raises(ValueError, match="positions"):
        stored.stored_hub(spark, path, max_messages_per_trigger=5)
    stored.store_hub(frame(spark, rows(5, 9)), path)
    reader = stored.StoredHubReader({"root": path})
    with pytest.raises(ValueError, match="are gone"):
        reader.partitions({stored.lane_of(NS, "aa", "0"): 2}, reader.latestOffset())
    stored.store_hub(frame(spark, rows(7, 12)), path)
    with pytest.raises(ValueError, match="below"):
        reader.partitions(reader.initialOffset(), reader.latestOffset())


def test_empty_hub_waits(spark, tmp_path):
    path, seen = str(tmp_path / "hub"), Seen()
    stored.store_hub(frame(spark, []), path)
    drain(stored.stored_hub(spark, path), str(tmp_path / "cp"), seen)
    assert not any(seen.batches)


def test_delivers_into_targets(spark, tmp_path):
    path, folder = str(tmp_path / "hub"), str(tmp_path)
    stored.store_hub(frame(spark, rows(0, 30, hubs=("aa", "bb"), partitions=("0", "1"))), path)
    lanes = spark.createDataFrame([(NS, "aa", "0"), (NS, "aa", "1")],
                                  "eventhub_namespace string, eventhub string, partition_id string")
    latest = spark.createDataFrame(
        [(NS, "aa", "0", 9, None)], "eventhub_namespace string, eventhub string, partition_id "
        "string, waterlevel bigint, metadata string")
    text = hub.starting_offsets(hub.start_positions(latest, lanes, "earliest"))
    messages = stored.stored_hub(spark, path, text, 25, f"{folder}/at")
    query = ingest.start_ingest(messages, mapping(spark, "aa"),
                                TableSink(f"{folder}/target", f"{folder}/control",
                                          f"{folder}/errors", "r"),
                                f"{folder}/progress", {"processingTime": "0 seconds"})
    query.processAllAvailable()
    query.stop()
    got = {r.partition_id: (r.n, r.low) for r in read_target(spark, f"{folder}/target")
           .groupBy("partition_id").agg(F.count("*").alias("n"),
                                        F.min("sequence_number").alias("low")).collect()}
    assert got == {"0": (20, 10), "1": (30, 0)}
