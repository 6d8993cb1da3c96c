"""Queries on landed ranges and on joins by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import ranges, stats, temporal
from tidegate.plans import frames
from tidegate.plans.frames import BATCHES, ERRORS, ROUTED
from tidegate.session import stored
from tidegate.sources.tables import event_messages

LANE = ["eventhub", "partition_id"]
#: Numbers in a cell here, so that ranges of the test tables span several.
CELL = 64


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all batches but every fifth of a hub, which failed."""
    return frames.routed(spark, sf_dir).where("batch_id % 5 <> 3")


def landed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of what has landed, kept per batch and merged."""
    per_batch = ranges.landed_ranges(_landed(spark, sf_dir), [*LANE, "batch_id"], CELL)
    return ranges.merged(per_batch, LANE, CELL)


def landed_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges between those that have landed."""
    found = stored(landed_ranges(spark, sf_dir), "ranges")
    return (ranges.gaps(found, LANE, CELL)
            .withColumn("messages", F.col("last") - F.col("first") + 1))


def outside_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of mapped hubs that no landed range holds."""
    found = landed_ranges(spark, sf_dir)
    return (ranges.outside(frames.routed(spark, sf_dir), found, LANE, CELL)
            .select("event_id", "eventhub", "partition_id", "sequence_number"))


def checkpoint_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with the newest checkpoint of its lane when it arrived."""
    points = (frames.routed(spark, sf_dir).groupBy(*LANE, "batch_id")
              .agg(F.max("enqueued_time").alias("since"), F.max("sequence_number").alias("waterlevel"))
              .select(*LANE, "since", "waterlevel"))
    messages = event_messages(spark, sf_dir).select("event_id", *LANE, "enqueued_time")
    found = temporal.as_of(messages, points, LANE, "enqueued_time", "since", slot_rows=500)
    return found.select("event_id", "eventhub", "partition_id", F.col("state.since").alias("since"),
                        F.col("state.waterlevel").alias("waterlevel"))


def failures_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of every batch of the mapping whose span holds them."""
    spans = frames.batches(spark, sf_dir).select("mapping_key", "batch_id", "started_at",
                                                 "finished_at")
    errors = frames.error_log(spark, sf_dir).select("mapping_key", "ts", "error")
    return (temporal.within(errors, spans, ["mapping_key"], "ts", "started_at", "finished_at")
            .groupBy("mapping_key", "batch_id").agg(
                F.count(F.lit(1)).alias("failures"), F.countDistinct("error").alias("texts"),
                F.min("ts").alias("first_at"), F.max("ts").alias("last_at")))


def health_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent failures of each mapping and of all."""
    return stats.health_errors(frames.error_log(spark, sf_dir), 5)


_RANGES = f"""{ROUTED},
landed AS (SELECT DISTINCT eventhub, partition_id, sequence_number FROM routed
  WHERE batch_id % 5 <> 3),
ranges AS (SELECT eventhub, partition_id, min(sequence_number) AS first,
    max(sequence_number) AS last
  FROM (SELECT *, sequence_number - row_number() OVER (PARTITION BY eventhub, partition_id
      ORDER BY sequence_number) AS island FROM landed)
  GROUP BY eventhub, partition_id, island)"""

QUERIES = {f.__name__: f for f in (landed_ranges, landed_gaps, outside_ranges,
                                   checkpoint_in_force, failures_in_batches, health_errors)}
ORACLES = {
    "landed_ranges": f"WITH {_RANGES} SELECT * FROM ranges",
    "landed_gaps": f"""WITH {_RANGES},
gaps AS (SELECT eventhub, partition_id, lag(last) OVER (PARTITION BY eventhub, partition_id
    ORDER BY first) + 1 AS first, first - 1 AS last FROM ranges)
SELECT *, last - first + 1 AS messages FROM gaps WHERE first IS NOT NULL""",
    "outside_ranges": f"""WITH {ROUTED}
SELECT event_id, eventhub, partition_id, sequence_number FROM routed WHERE batch_id % 5 = 3""",
    "checkpoint_in_force": f"""WITH {ROUTED},
ends AS (SELECT eventhub, partition_id, max(enqueued_time) AS since,
    max(sequence_number) AS waterlevel FROM routed GROUP BY eventhub, partition_id, batch_id),
points AS (SELECT eventhub, partition_id, since, max(waterlevel) AS waterlevel FROM ends
  GROUP BY eventhub, partition_id, since)
SELECT event_id, m.eventhub, m.partition_id, since, waterlevel FROM msgs m
ASOF LEFT JOIN points p ON m.eventhub = p.eventhub AND m.partition_id = p.partition_id
  AND m.enqueued_time >= p.since""",
    "failures_in_batches": f"""WITH {BATCHES},
errors AS ({ERRORS.split("errors AS (")[1]}
SELECT b.mapping_key, batch_id, count(*) AS failures, count(DISTINCT error) AS texts,
  min(ts) AS first_at, max(ts) AS last_at
FROM batches b JOIN errors e ON b.mapping_key = e.mapping_key
  AND e.ts BETWEEN b.started_at AND b.finished_at
GROUP BY b.mapping_key, batch_id""",
    "health_errors": f"""WITH {ERRORS},
signed AS (SELECT mapping_key, error_type || ':' || substr(error, 1, 100) AS signature, count(*) AS
    failures, max(ts) AS last_at, arg_max(error, (ts, error)) AS last_error
  FROM errors GROUP BY GROUPING SETS ((mapping_key, signature), (signature)))
SELECT mapping_key, CAST(place AS INTEGER) AS place, signature, failures, last_at, last_error
FROM (SELECT *, row_number() OVER (PARTITION BY mapping_key ORDER BY failures DESC, signature)
  AS place FROM signed) WHERE place <= 5""",
}
