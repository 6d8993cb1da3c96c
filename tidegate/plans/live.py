"""Queries on a live hub: start positions, closings by timer, event time, sketches."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import with_clean
from tidegate.operators import replays, sketches
from tidegate.plans import delivery, frames
from tidegate.plans.frames import MSGS, ROUTED
from tidegate.schema import LANE_KEY, MESSAGE
from tidegate.session import fresh_dir, small_side, stored
from tidegate.sources import hub
from tidegate.sources.stored import store_hub, stored_hub
from tidegate.sources.tables import event_messages, table
from tidegate.streaming import closing, events

DRAIN = {"availableNow": True}
#: Sequence numbers that a trigger takes here at most.
TRIGGER_MESSAGES = 50_000
WAIT_SECONDS = 600


def _drained(rows: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    query = (rows.writeStream.format("parquet").outputMode(mode)
             .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress")
             .trigger(**DRAIN).start())
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/out")


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that a stream reads from a hub after the stored checkpoints of every partition."""
    folder = fresh_dir(spark, "resumed")
    messages = event_messages(spark, sf_dir)
    store_hub(messages, f"{folder}/hub")
    positions = hub.start_positions(delivery._stored(spark, sf_dir), replays.lanes(messages),
                                    "earliest")
    source = stored_hub(spark, f"{folder}/hub", hub.starting_offsets(positions),
                        TRIGGER_MESSAGES, f"{folder}/positions")
    query = (source.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/progress")
             .trigger(processingTime="0 seconds").start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(MESSAGE).parquet(f"{folder}/out").select(
        "eventhub", "partition_id", "sequence_number", "offset", "enqueued_time",
        F.col("body").cast("string").alias("body"))


def stream_age_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of hubs that fall silent: full ones close by size, the rest by their timer."""
    folder = fresh_dir(spark, "flush")
    messages = event_messages(spark, sf_dir)
    store_hub(messages, f"{folder}/hub")
    total = spark.read.parquet(f"{folder}/hub/data").count()
    query = closing.start_closing(
        closing.closed_batches(stored_hub(spark, f"{folder}/hub"), frames.BATCH, 1),
        f"{folder}/closed", f"{folder}/progress")
    deadline = time.monotonic() + WAIT_SECONDS
    try:
        while query.isActive and time.monotonic() < deadline:
            try:
                if closing.closed_messages(spark, f"{folder}/closed") == total:
                    break
            except AnalysisException:       # nothing has closed yet
                pass
            time.sleep(0.5)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()
    return closing.read_closed(spark, f"{folder}/closed").select(
        "eventhub", "batch_id", "reason", "messages", "first", "last")


def _timed(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The stored events, and a message long after them that moves the watermark."""
    messages = event_messages(spark, sf_dir).select(*MESSAGE.names)
    kept = messages.unionByName(events.heartbeat(messages, "enqueued_time", "10 DAYS"))
    hub.write_hub(kept, f"{folder}/hub")
    return hub.file_hub(spark, f"{folder}/hub")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of every lane by the hour."""
    folder = fresh_dir(spark, "windows")
    rows = events.tumbling(_timed(spark, sf_dir, folder), "1 hour", "10 minutes")
    return _drained(rows, folder).where(F.col("eventhub") != events.PULSE).select(
        "eventhub", "partition_id", "window_start", "messages", "first_sequence", "last_sequence")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of every hub: runs of messages with less than 20 minutes between two."""
    folder = fresh_dir(spark, "sessions")
    rows = events.sessions(_timed(spark, sf_dir, folder), "1200500 milliseconds", "10 minutes")
    return _drained(rows, folder).where(F.col("eventhub") != events.PULSE).select(
        "eventhub", "partition_id", "window_start", "messages", "first_sequence", "last_sequence")


def stream_acknowledged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages joined with the stream of their acknowledgements; some have none in time."""
    folder = fresh_dir(spark, "acks")
    acked = event_messages(spark, sf_dir).where("event_id % 7 <> 0").select(
        *LANE_KEY, "sequence_number",
        F.expr("timestampadd(MINUTE, event_id % 20, enqueued_time)").alias("acked_at"))
    kept = acked.unionByName(events.heartbeat(acked, "acked_at", "10 DAYS"))
    kept.write.parquet(f"{folder}/acks")
    acks = spark.readStream.schema(kept.schema).parquet(f"{folder}/acks")
    rows = events.with_acknowledgements(_timed(spark, sf_dir, folder), acks, "15 MINUTES",
                                        "10 minutes")
    return (_drained(rows.select("eventhub", "partition_id", "sequence_number", "acked_at"), folder)
            .where(F.col("eventhub") != events.PULSE))


def batch_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and the median size of bodies per hub, from sketches kept per batch: whether they lie
    within the stated bounds of the exact values."""
    rows = frames.routed(spark, sf_dir).withColumn("size", F.octet_length("body").cast("bigint"))
    user = F.col("properties")["user_id"]
    kept = stored(sketches.batch_sketches(rows, ["eventhub", "batch_id"], user, F.col("size")),
                  "sketches")
    days = sketches.merged(kept.withColumn("half", F.col("batch_id") % 2), ["eventhub", "half"])
    found = small_side(sketches.estimates(sketches.merged(days, ["eventhub"]), {"median": 0.5})
                       .withColumnRenamed("messages", "sketched"))
    median, error = F.col("median"), sketches.distinct_error()
    exact = rows.join(found, "eventhub").groupBy("eventhub", "sketched", "distinct").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct(user).alias("users"),
        F.avg((F.col("size") < median).cast("int")).alias("below"),
        F.avg((F.col("size") <= median).cast("int")).alias("reached"))
    return exact.select(
        "eventhub", "messages", "users", (F.col("sketched") == F.col("messages")).alias("all_seen"),
        (F.abs(F.col("distinct") - F.col("users")) <= error * F.col("users")).alias("users_within"),
        ((F.col("below") <= 0.5 + sketches.RANK_ERROR)
         & (F.col("reached") >= 0.5 - sketches.RANK_ERROR)).alias("median_within"))


def nested_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of lists of structs of maps, with bytes at every level, as text."""
    raw = lambda c: F.encode(c, "utf-8")
    deep = F.create_map(
        raw(F.lit("outer")), F.array(
            F.struct(F.concat(raw("lang"), F.unhex(F.lit("C3"))).alias("inner"),
                     F.create_map(raw("source"), F.array(raw("lang"), F.lit(None))).alias("more"),
                     F.col("n_chars").alias("n"))))
    rows = table(spark, sf_dir, "documents").select("doc_id", deep.alias("deep"))
    return with_clean(rows, "deep").select("doc_id", F.to_json(
        "deep", {"ignoreNullFields": "false"}).alias("properties"))


QUERIES = {f.__name__: f for f in (
    stream_resumed, stream_age_flush, stream_windows, stream_sessions, stream_acknowledged,
    batch_sketches, nested_properties)}

_RUNS = f"""WITH {MSGS},
marked AS (SELECT *, CASE WHEN enqueued_time - lag(enqueued_time) OVER lane
    < INTERVAL 1200500 MILLISECONDS THEN 0 ELSE 1 END AS fresh FROM msgs
  WINDOW lane AS (PARTITION BY eventhub, partition_id ORDER BY sequence_number)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY eventhub, partition_id
  ORDER BY sequence_number) AS run FROM marked)"""

ORACLES = {
    "stream_resumed": f"""WITH {delivery._STORED}
SELECT m.eventhub, m.partition_id, m.sequence_number, m."offset", m.enqueued_time, m.body
FROM msgs m LEFT JOIN reached s ON m.eventhub = s.eventhub AND m.partition_id = s.partition_id
WHERE m.sequence_number > coalesce(s.sequence_number, -1)""",
    "stream_age_flush": f"""WITH {MSGS}
SELECT eventhub, arrival // {frames.BATCH} AS batch_id,
  CASE WHEN count(*) = {frames.BATCH} THEN 'size' ELSE 'age' END AS reason, count(*) AS messages,
  min(arrival) AS first, max(arrival) AS last
FROM msgs GROUP BY eventhub, arrival // {frames.BATCH}""",
    "stream_windows": f"""WITH {MSGS}
SELECT eventhub, partition_id, date_trunc('hour', enqueued_time) AS window_start,
  count(*) AS messages, min(sequence_number) AS first_sequence,
  max(sequence_number) AS last_sequence
FROM msgs GROUP BY ALL""",
    "stream_sessions": f"""{_RUNS}
SELECT eventhub, partition_id, min(enqueued_time) AS window_start, count(*) AS messages,
  min(sequence_number) AS first_sequence, max(sequence_number) AS last_sequence
FROM runs GROUP BY eventhub, partition_id, run""",
    "stream_acknowledged": f"""WITH {MSGS}
SELECT eventhub, partition_id, sequence_number, CASE WHEN event_id % 7 <> 0 AND event_id % 20 <= 15
  THEN enqueued_time + to_minutes(event_id % 20) END AS acked_at
FROM msgs""",
    "batch_sketches": f"""WITH {ROUTED}
SELECT r.eventhub, count(*) AS messages, count(DISTINCT user_id) AS users, TRUE AS all_seen,
  TRUE AS users_within, TRUE AS median_within
FROM routed r JOIN events e ON r.event_id = e.event_id GROUP BY r.eventhub""",
    "nested_properties": """SELECT doc_id, '{"outer":[{"inner":"' || lang || chr(65533)
  || '","more":{"' || source || '":["' || lang || '",null]},"n":' || n_chars || '}]}' AS properties
FROM documents""",
}
