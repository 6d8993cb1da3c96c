"""Queries on batches, waterlevels and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import batching, checkpoints, replays
from tidegate.operators.routing import route
from tidegate.plans import frames
from tidegate.plans.frames import BATCH, LOG, MSGS, ROUTED
from tidegate.schema import CHECKPOINT_KEY
from tidegate.session import fresh_dir
from tidegate.sources import hub
from tidegate.sources.tables import event_messages, lineitem_messages
from tidegate.streaming.sink import in_lanes

DAY = 24 * 3600
INGEST_BATCH = 1000


def _summary(batched: DataFrame) -> DataFrame:
    return batching.batch_summary(batched).withColumn("partitions",
                                                      F.array_join("partitions", ","))


def batch_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(frames.batched(spark, sf_dir))


def batch_by_target_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of the size that each target asks for."""
    routed = route(event_messages(spark, sf_dir), frames.mapping(spark))
    return (batching.batches_by_size(routed, "batch_size")
            .groupBy("target_table", "batch_id")
            .agg(F.count(F.lit(1)).alias("message_count"),
                 F.min("arrival").alias("first_arrival"), F.max("arrival").alias("last_arrival")))


def batch_by_size_or_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(batching.assign_batches(event_messages(spark, sf_dir), BATCH, DAY))


def batch_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size-or-age batch of every message, with a shorter age."""
    return (batching.assign_batches(event_messages(spark, sf_dir), 50, DAY // 4)
            .select("eventhub", "event_id", "arrival", "batch_id"))


def last_vs_max_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last arrived and highest sequence differ once messages arrive out of order."""
    shuffled = frames.batched(spark, sf_dir).withColumn(
        "seen", F.col("arrival") + F.col("event_id") % 7 * 10_000_000)
    keys = ["eventhub", "batch_id", "partition_id"]
    last = batching.last_arrived_sequence(shuffled, arrival="seen")
    top = checkpoints.highest_messages(shuffled, keys, "seen")
    return last.join(top.select(*keys, F.col("sequence_number").alias("max_sequence"), "offset"),
                     keys)


def batch_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.checkpoint_rows(spark, sf_dir)


def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.latest_checkpoints(frames.checkpoint_rows(spark, sf_dir))


def hub_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest waterlevels of one hub and target, the lookup made at start-up."""
    return checkpoints.latest_checkpoints(
        frames.checkpoint_rows(spark, sf_dir), frames.NAMESPACE, "click",
        ("LAKE", "RAW", "EVENTS_CLICK")).select("partition_id", "waterlevel")


def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even batches are stored, odd ones arrive; an update wins even where it is lower."""
    log = frames.control_log(spark, sf_dir)
    current = checkpoints.latest_checkpoints(log.where("batch_id % 2 = 0"))
    updates = checkpoints.latest_checkpoints(log.where("batch_id % 2 = 1"))
    return checkpoints.upsert_checkpoints(current, updates).drop("metadata", "run_id")


def checkpoint_upsert_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = frames.control_log(spark, sf_dir)
    current = checkpoints.latest_checkpoints(log.where("batch_id % 2 = 0"))
    updates = checkpoints.latest_checkpoints(log.where("batch_id % 2 = 1"))
    return (checkpoints.upsert_checkpoints(current, updates, monotone=True)
            .select(*CHECKPOINT_KEY, "waterlevel"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints as they stood after batch 2; hub click feeds a second target, still at 1."""
    log = frames.checkpoint_rows(spark, sf_dir)
    second = log.where("eventhub = 'click' and batch_id <= 1").withColumn(
        "target_table", F.lit("EVENTS_CLICK_COPY"))
    return checkpoints.latest_checkpoints(log.where("batch_id <= 2").unionByName(second))


def resume_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some messages carry offsets that are no numbers, as do some of the checkpoints."""
    messages = frames.with_invalid_offsets(event_messages(spark, sf_dir))
    return (checkpoints.resume_messages(messages, _stored(spark, sf_dir), start="earliest")
            .select("eventhub", "partition_id", "sequence_number", "offset"))


def resume_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.resume_listing(_stored(spark, sf_dir))


def start_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hub.start_positions(_stored(spark, sf_dir),
                               replays.lanes(event_messages(spark, sf_dir)))


def checkpoint_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.checkpoint_lag(event_messages(spark, sf_dir), _stored(spark, sf_dir))


def compacted_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest waterlevels of a log that was compacted half-way and then appended to."""
    log, folder = frames.control_log(spark, sf_dir), fresh_dir(spark, "control")
    checkpoints.append_checkpoints(log.where("batch_id <= 2"), f"{folder}/old")
    checkpoints.compact_checkpoints(spark, f"{folder}/old", f"{folder}/new")
    checkpoints.append_checkpoints(log.where("batch_id > 2 and partition_id <> '0'"),
                                   f"{folder}/new")
    return checkpoints.latest_checkpoints(
        checkpoints.read_control_table(spark, f"{folder}/new")).select(
        *CHECKPOINT_KEY, "waterlevel", "batch_id")


def committed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.committed_positions(frames.routed(spark, sf_dir),
                                           ["target_table", "partition_id"])


def dedup_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches, then a second delivery of every batch from 2 on."""
    rows = frames.batched(spark, sf_dir).select(
        "eventhub_namespace", "eventhub", "partition_id", "sequence_number", "offset", "batch_id")
    first = rows.withColumn("delivery", F.lit(0))
    again = rows.where("batch_id >= 2").withColumn("delivery", F.lit(1))
    return replays.drop_replays(first.unionByName(again), "delivery")


def not_yet_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches from 2 on are delivered to a target that already holds batches up to 3."""
    rows = frames.batched(spark, sf_dir).select(
        "eventhub_namespace", "eventhub", "partition_id", "sequence_number", "batch_id")
    return replays.not_yet_landed(rows.where("batch_id >= 2"),
                                  rows.where("batch_id <= 3").drop("batch_id"))


def recent_checkpoints_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (frames.checkpoint_rows(spark, sf_dir)
            .orderBy(F.desc("ts_inserted"), "eventhub", "partition_id").limit(10)
            .select("ts_inserted", "eventhub", "partition_id", "waterlevel"))


def bench_lineitem_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all line items in ordered lanes, then checkpoint every batch from what landed."""
    from tidegate.operators.envelope import to_landed
    messages = batching.batches_by_size(lineitem_messages(spark, sf_dir), INGEST_BATCH)
    named = messages.select("*", F.lit("LAKE").alias("target_db"), F.lit("RAW").alias(
        "target_schema"), F.lit("LINEITEM").alias("target_table"))
    landed = to_landed(named, keep=["eventhub_namespace", "eventhub", "target_db",
                                    "target_schema", "target_table", "offset", "arrival",
                                    "batch_id"])
    path = fresh_dir(spark, "lineitem")
    in_lanes(landed).write.parquet(path)
    return (checkpoints.batch_checkpoints(spark.read.parquet(path), frames.log_time())
            .select("eventhub", "partition_id", "batch_id", "waterlevel"))


QUERIES = {f.__name__: f for f in (
    batch_by_size, batch_by_target_size, batch_by_size_or_age, batch_assignment, last_vs_max_sequence,
    batch_checkpoints, latest_checkpoint, hub_checkpoints, checkpoint_upsert,
    checkpoint_upsert_monotone, resume_messages, resume_listing, start_positions,
    checkpoint_lag, compacted_checkpoints, committed_positions, dedup_replay, not_yet_landed,
    recent_checkpoints_topk, bench_lineitem_ingest)}


def sized_steps(max_size: int, seconds: int) -> str:
    """Size-or-age batches, one message after the other."""
    return f"""{MSGS},
clocked AS (SELECT eventhub, arrival, epoch_us(enqueued_time) AS t FROM msgs),
steps AS (
  SELECT eventhub, arrival, CAST(0 AS BIGINT) AS batch_id, 1 AS held, t AS created, t,
    {max_size} = 1 AS closed
  FROM clocked WHERE arrival = 0
  UNION ALL
  SELECT c.eventhub, c.arrival,
    s.batch_id + CASE WHEN s.closed THEN 1 ELSE 0 END,
    CASE WHEN s.closed THEN 1 ELSE s.held + 1 END,
    CASE WHEN s.closed THEN s.t ELSE s.created END, c.t,
    (CASE WHEN s.closed THEN 1 ELSE s.held + 1 END) >= {max_size}
      OR c.t - (CASE WHEN s.closed THEN s.t ELSE s.created END) >= {seconds * 1_000_000}
  FROM steps s JOIN clocked c ON c.eventhub = s.eventhub AND c.arrival = s.arrival + 1)"""


_SUMMARY = """count(*) AS message_count,
  string_agg(DISTINCT partition_id, ',' ORDER BY partition_id) AS partitions,
  min(arrival) AS first_arrival, max(arrival) AS last_arrival,
  min(enqueued_time) AS first_enqueued, max(enqueued_time) AS last_enqueued"""
_STORED = f"""{LOG},
twofold AS (SELECT * FROM log WHERE batch_id <= 2
  UNION ALL SELECT * REPLACE ('EVENTS_CLICK_COPY' AS target_table) FROM log
  WHERE eventhub = 'click' AND batch_id <= 1),
stored AS (SELECT * FROM twofold QUALIFY row_number() OVER (
  PARTITION BY eventhub, target_table, partition_id ORDER BY ts_inserted DESC) = 1),
reached AS (SELECT eventhub, partition_id, min(sequence_number) AS sequence_number
  FROM stored GROUP BY eventhub, partition_id)"""
_UPSERT = f"""{LOG},
cur AS (SELECT * FROM log WHERE batch_id % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY eventhub, partition_id ORDER BY ts_inserted DESC) = 1),
upd AS (SELECT * FROM log WHERE batch_id % 2 = 1
  QUALIFY row_number() OVER (PARTITION BY eventhub, partition_id ORDER BY ts_inserted DESC) = 1)"""
_KEY = ", ".join(CHECKPOINT_KEY)

ORACLES = {
    "batch_by_size": f"""WITH {MSGS}
SELECT eventhub, arrival // {BATCH} AS batch_id, {_SUMMARY}
FROM msgs GROUP BY eventhub, arrival // {BATCH}""",
    "batch_by_target_size": f"""WITH {ROUTED}
SELECT target_table, arrival // batch_size AS batch_id, count(*) AS message_count,
  min(arrival) AS first_arrival, max(arrival) AS last_arrival
FROM routed GROUP BY target_table, arrival // batch_size""",
    "batch_by_size_or_age": f"""WITH RECURSIVE {sized_steps(BATCH, DAY)}
SELECT eventhub, batch_id, {_SUMMARY}
FROM steps JOIN msgs USING (eventhub, arrival) GROUP BY eventhub, batch_id""",
    "batch_assignment": f"""WITH RECURSIVE {sized_steps(50, DAY // 4)}
SELECT eventhub, event_id, arrival, batch_id FROM steps JOIN msgs USING (eventhub, arrival)""",
    "last_vs_max_sequence": f"""WITH {MSGS},
seen AS (SELECT *, arrival // {BATCH} AS batch_id, arrival + event_id % 7 * 10000000 AS seen
  FROM msgs)
SELECT eventhub, batch_id, partition_id, arg_max(sequence_number, seen) AS last_sequence,
  max(sequence_number) AS max_sequence, arg_max("offset", sequence_number) AS "offset"
FROM seen GROUP BY eventhub, batch_id, partition_id""",
    "batch_checkpoints": f"WITH {LOG} SELECT * EXCLUDE (sequence_number) FROM log",
    "latest_checkpoint": f"""WITH {LOG}
SELECT {_KEY}, ts_inserted, waterlevel, metadata, run_id, batch_id FROM log
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY ts_inserted DESC) = 1""",
    "hub_checkpoints": f"""WITH {LOG}
SELECT partition_id, waterlevel FROM log WHERE eventhub = 'click'
QUALIFY row_number() OVER (PARTITION BY partition_id ORDER BY ts_inserted DESC) = 1""",
    "checkpoint_upsert": f"""WITH {_UPSERT}
SELECT ts_inserted, eventhub_namespace, eventhub, target_db, target_schema, target_table,
  waterlevel, partition_id, batch_id FROM upd
UNION ALL
SELECT ts_inserted, eventhub_namespace, eventhub, target_db, target_schema, target_table,
  waterlevel, partition_id, batch_id FROM cur c
WHERE NOT EXISTS (SELECT 1 FROM upd u
  WHERE u.eventhub = c.eventhub AND u.partition_id = c.partition_id)""",
    "checkpoint_upsert_monotone": f"""WITH {_UPSERT}
SELECT {_KEY}, max(waterlevel) AS waterlevel
FROM (SELECT * FROM cur UNION ALL SELECT * FROM upd) GROUP BY {_KEY}""",
    "resume_messages": f"""WITH {_STORED}
SELECT m.eventhub, m.partition_id, m.sequence_number,
  CASE WHEN m.event_id % 50 = 0 THEN 'invalid' ELSE m."offset" END AS "offset"
FROM msgs m LEFT JOIN reached s ON m.eventhub = s.eventhub AND m.partition_id = s.partition_id
WHERE s.sequence_number IS NULL OR m.sequence_number > s.sequence_number""",
    "resume_listing": f"""WITH {_STORED}
SELECT {_KEY},
  'group' || CASE eventhub WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
    ELSE 4 END AS consumer_group,
  CAST(waterlevel AS VARCHAR) AS "offset", sequence_number FROM stored""",
    "start_positions": f"""WITH {_STORED}
SELECT DISTINCT m.eventhub_namespace, m.eventhub, m.partition_id,
  coalesce(s.sequence_number + 1, -1) AS position
FROM msgs m LEFT JOIN reached s ON m.eventhub = s.eventhub AND m.partition_id = s.partition_id""",
    "checkpoint_lag": f"""WITH {_STORED},
ends AS (SELECT eventhub_namespace, eventhub, partition_id, max(sequence_number) AS end_sequence,
  count(*) AS messages FROM msgs GROUP BY eventhub_namespace, eventhub, partition_id)
SELECT m.eventhub_namespace, m.eventhub, target_db, target_schema, target_table, m.partition_id,
  end_sequence, messages, s.sequence_number AS checkpoint_sequence,
  end_sequence - coalesce(s.sequence_number, -1) AS lag
FROM ends m LEFT JOIN stored s ON m.eventhub = s.eventhub AND m.partition_id = s.partition_id""",
    "compacted_checkpoints": f"""WITH {LOG}
SELECT {_KEY}, waterlevel, batch_id FROM log
WHERE batch_id <= 2 OR partition_id <> '0'
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY ts_inserted DESC) = 1""",
    "committed_positions": f"""WITH {ROUTED}
SELECT target_table, partition_id, max(sequence_number) AS committed_sequence,
  count(*) AS landed_rows FROM routed GROUP BY target_table, partition_id""",
    "dedup_replay": f"""WITH {MSGS},
twice AS (SELECT *, arrival // {BATCH} AS batch_id, 0 AS delivery FROM msgs
  UNION ALL SELECT *, arrival // {BATCH}, 1 FROM msgs WHERE arrival // {BATCH} >= 2)
SELECT eventhub_namespace, eventhub, partition_id, sequence_number, "offset", batch_id, delivery
FROM twice
QUALIFY row_number() OVER (PARTITION BY eventhub, partition_id, sequence_number
                           ORDER BY delivery) = 1""",
    "not_yet_landed": f"""WITH {MSGS}
SELECT eventhub_namespace, eventhub, partition_id, sequence_number,
  arrival // {BATCH} AS batch_id FROM msgs WHERE arrival // {BATCH} >= 4""",
    "recent_checkpoints_topk": f"""WITH {LOG}
SELECT ts_inserted, eventhub, partition_id, waterlevel FROM log
ORDER BY ts_inserted DESC, eventhub, partition_id LIMIT 10""",
    "bench_lineitem_ingest": f"""WITH numbered AS (
  SELECT 'lineitem_' || lower(l_returnflag) AS eventhub,
    CAST(l_orderkey % 8 AS VARCHAR) AS partition_id,
    row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber,
      l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus) - 1
      AS arrival
  FROM lineitem)
SELECT eventhub, partition_id, arrival // {INGEST_BATCH} AS batch_id, max(arrival) AS waterlevel
FROM numbered GROUP BY eventhub, partition_id, arrival // {INGEST_BATCH}""",
}
