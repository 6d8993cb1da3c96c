"""Queries that run a stream to its end and read back what it left."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import checkpoints
from tidegate.plans import delivery, frames
from tidegate.plans.frames import MSGS, ROUTED
from tidegate.session import fresh_dir
from tidegate.sources import hub
from tidegate.sources.tables import event_messages
from tidegate.streaming import fanout, ingest
from tidegate.streaming.sized import SizedBatches
from tidegate.streaming.sink import TableSink, read_rejected, read_target

DRAIN = {"availableNow": True}


def _hub(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events as a stored hub, read in as many files at a time as the cluster can hold."""
    path = f"{folder}/hub"
    hub.write_hub(event_messages(spark, sf_dir), path)
    return hub.file_hub(spark, path, max(1, spark.sparkContext.defaultParallelism // 2))


def _sink(folder: str, run_id: str = "run") -> TableSink:
    return TableSink(f"{folder}/target", f"{folder}/control", f"{folder}/errors", run_id)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "ingest")
    query = ingest.start_ingest(_hub(spark, sf_dir, folder), frames.mapping(spark),
                                _sink(folder), f"{folder}/progress", DRAIN)
    query.awaitTermination()
    return read_target(spark, f"{folder}/target").select(
        "target_table", "mapping_key", "eventhub", "partition_id", "sequence_number", "row_id",
        "offset", "enqueued_time", "event_body", "properties")


def stream_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "checkpoints")
    query = ingest.start_ingest(_hub(spark, sf_dir, folder), frames.mapping(spark),
                                _sink(folder), f"{folder}/progress", DRAIN)
    query.awaitTermination()
    log = checkpoints.read_control_table(spark, f"{folder}/control")
    # File order is not message order, so the highest waterlevel counts, not the newest.
    return checkpoints.latest_checkpoints(log, monotone=True).select(
        "eventhub_namespace", "eventhub", "target_table", "partition_id", "waterlevel")


def stream_multi_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per mapping, side by side."""
    folder = fresh_dir(spark, "mappings")
    keys = [r.mapping_key for r in frames.mapping(spark).select("mapping_key").collect()]
    queries = ingest.start_per_mapping(
        _hub(spark, sf_dir, folder), frames.mapping(spark), keys,
        lambda key: _sink(folder, key.split("->")[0]), f"{folder}/progress", DRAIN)
    ingest.wait_all(queries)
    return (read_target(spark, f"{folder}/target").groupBy("target_table", "run_id", "eventhub")
            .agg(F.count(F.lit(1)).alias("landed"),
                 F.countDistinct("row_id").alias("row_ids"),
                 F.max("sequence_number").alias("last_sequence")))


def _refuse(key: str | None, batch_id: int, attempt: int) -> None:
    """One target that is out of reach at first, and one that lets nobody in."""
    if key and key.startswith("HUB_2->") and attempt == 1:
        raise ConnectionError("connection reset by peer")
    if key and key.startswith("HUB_4->"):
        raise RuntimeError("401 unauthorized")


def _fan_out(spark: SparkSession, sf_dir: str) -> str:
    """A drained stream for all mappings with two failing targets, and one retry; its folder."""
    folder = fresh_dir(spark, "fan-out")
    sink = fanout.FanOutSink(f"{folder}/target", f"{folder}/control", f"{folder}/ledger",
                             f"{folder}/parked", probe=_refuse)
    ingest.start_ingest(_hub(spark, sf_dir, folder), frames.mapping(spark), sink,
                        f"{folder}/progress", DRAIN).awaitTermination()
    later = sink.now() + timedelta(hours=1)
    sink.now = lambda: later
    sink.retry(spark)
    return folder


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landed of each mapping, all read from the stream once."""
    landed = read_target(spark, f"{_fan_out(spark, sf_dir)}/target")
    return landed.groupBy("mapping_key", "target_table").agg(
        F.count(F.lit(1)).alias("landed"), F.countDistinct("row_id").alias("row_ids"))


def stream_parked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger that the sink itself wrote: messages by mapping, attempt and what became of them."""
    ledger = fanout.read_ledger(spark, f"{_fan_out(spark, sf_dir)}/ledger")
    return (ledger.where("mapping_key is not null")
            .groupBy("mapping_key", "attempt", "state", "category", "error")
            .agg(F.sum("messages").alias("messages"),
                 F.bool_and(F.col("due").isNotNull()).alias("will_retry")))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed and kept back, by target and reasons; together they are all received.

    Some messages lack a sequence number, one hub has no target, and the names of one mapping
    break a rule.
    """
    folder = fresh_dir(spark, "quarantine")
    holes = event_messages(spark, sf_dir).withColumn(
        "sequence_number", F.when(F.col("event_id") % 97 != 0, F.col("sequence_number")))
    hub.write_hub(holes, f"{folder}/hub")
    bad = F.when(F.col("eventhub") == "error", F.lit("  \t")).otherwise(F.col("consumer_group"))
    query = ingest.start_ingest(
        hub.file_hub(spark, f"{folder}/hub"),
        frames.mapping(spark).withColumn("consumer_group", bad), _sink(folder),
        f"{folder}/progress", DRAIN)
    query.awaitTermination()
    landed = read_target(spark, f"{folder}/target").withColumn("reasons", F.lit(""))
    kept = read_rejected(spark, f"{folder}/target")
    columns = ["eventhub", "partition_id", "event_body", "reasons"]
    return (landed.select(*columns).unionByName(kept.select(*columns))
            .groupBy("eventhub", "partition_id", "reasons")
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.sum(F.length("event_body")).alias("characters")))


def stream_sized_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size-or-age batches of everything a stored hub holds, as one micro-batch."""
    folder = fresh_dir(spark, "sized")
    hub.write_hub(event_messages(spark, sf_dir), f"{folder}/hub")
    sink = SizedBatches(f"{folder}/out", f"{folder}/state", frames.BATCH, delivery.DAY)
    query = (hub.file_hub(spark, f"{folder}/hub").writeStream.foreachBatch(sink)
             .option("checkpointLocation", f"{folder}/progress").trigger(**DRAIN).start())
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(
        "eventhub", "partition_id", "sequence_number", "batch_id")


QUERIES = {f.__name__: f for f in (stream_ingest, stream_checkpoints, stream_multi_target,
                                   stream_fan_out, stream_parked, stream_quarantine,
                                   stream_sized_batches)}

ORACLES = {
    "stream_fan_out": f"""WITH {ROUTED}
SELECT mapping_key, target_table, count(*) AS landed, count(DISTINCT partition_id || '_' ||
  sequence_number) AS row_ids
FROM routed WHERE mapping_key NOT LIKE 'HUB_4->%' GROUP BY mapping_key, target_table""",
    "stream_parked": f"""WITH {ROUTED},
counts AS (SELECT split_part(mapping_key, '->', 1) AS hub_key, mapping_key, count(*) AS messages
  FROM routed GROUP BY mapping_key)
SELECT mapping_key, CAST(1 AS INTEGER) AS attempt,
  CASE WHEN hub_key IN ('HUB_2', 'HUB_4') THEN 'parked' ELSE 'landed' END AS state,
  CASE hub_key WHEN 'HUB_2' THEN 'network' WHEN 'HUB_4' THEN 'auth' END AS category,
  CASE hub_key WHEN 'HUB_2' THEN 'connection reset by peer' WHEN 'HUB_4' THEN '401 unauthorized'
    END AS error, messages, hub_key = 'HUB_2' AS will_retry
FROM counts
UNION ALL SELECT mapping_key, 2, 'landed', NULL, NULL, messages, false FROM counts
WHERE hub_key = 'HUB_2'""",
    "stream_ingest": f"""WITH {ROUTED}
SELECT target_table, mapping_key, eventhub, partition_id, sequence_number,
  partition_id || '_' || sequence_number AS row_id, "offset", enqueued_time,
  body AS event_body, properties
FROM routed""",
    "stream_checkpoints": f"""WITH {ROUTED}
SELECT eventhub_namespace, eventhub, target_table, partition_id, max(event_id) AS waterlevel
FROM routed GROUP BY eventhub_namespace, eventhub, target_table, partition_id""",
    "stream_quarantine": f"""WITH {MSGS}
SELECT eventhub, partition_id, concat_ws(',', CASE WHEN event_id % 97 = 0 THEN 'no_sequence' END,
    CASE eventhub WHEN 'view' THEN 'unroutable' WHEN 'error' THEN 'consumer_group' END) AS reasons,
  count(*) AS messages, CAST(sum(length(body)) AS BIGINT) AS characters
FROM msgs GROUP BY ALL""",
    "stream_sized_batches": f"""WITH RECURSIVE {delivery.sized_steps(frames.BATCH, delivery.DAY)}
SELECT eventhub, partition_id, sequence_number, batch_id
FROM steps JOIN msgs USING (eventhub, arrival)""",
    "stream_multi_target": f"""WITH {ROUTED}
SELECT target_table, split_part(mapping_key, '->', 1) AS run_id, eventhub, count(*) AS landed,
  count(DISTINCT partition_id || '_' || sequence_number) AS row_ids,
  max(sequence_number) AS last_sequence
FROM routed GROUP BY target_table, split_part(mapping_key, '->', 1), eventhub""",
}
