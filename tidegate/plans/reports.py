"""Queries on routing, statistics and failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import labels
from tidegate.functions.failure import CREDENTIAL_PHRASES, FATAL, PERMISSION_PHRASES, RETRYABLE
from tidegate.operators import checkpoints, failures, routing, stats
from tidegate.plans import frames
from tidegate.plans.frames import BATCHES, ERRORS, LOG, MAPPING, MSGS, ROUTED
from tidegate.sources.tables import NAMESPACE, event_messages, table


# --- routing -------------------------------------------------------------------------------


def auto_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs found by number, with the messages each one carries."""
    mapping = frames.mapping(spark)
    carried = routing.hub_counts(event_messages(spark, sf_dir))
    return (mapping.join(carried, routing.HUB, "left")
            .select("mapping_key", "eventhub", "target_table", "batch_size",
                    F.coalesce("messages", F.lit(0)).alias("messages")))


def explicit_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hubs sent to one target by name, with the messages that arrive there."""
    pairs = spark.sql("SELECT * FROM VALUES ('HUB_1', 'TARGET_6'), ('HUB_5', 'TARGET_6'), "
                      "('HUB_9', 'TARGET_1'), ('HUB_2', 'TARGET_5') AS v(hub_key, target_key)")
    hubs, targets = frames.hubs(spark), frames.targets(spark)
    mapping = routing.explicit_mapping(pairs, hubs, targets)
    carried = (routing.route(event_messages(spark, sf_dir), mapping)
               .groupBy("mapping_key").agg(F.count(F.lit(1)).alias("messages"))
               .select("mapping_key", F.lit("").alias("missing"), "messages"))
    broken = routing.dangling_pairs(pairs, hubs, targets).select(
        labels.mapping_key().alias("mapping_key"), "missing",
        F.lit(0).cast("bigint").alias("messages"))
    return carried.unionByName(broken)


def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (routing.route(event_messages(spark, sf_dir), frames.mapping(spark))
            .select("eventhub", "event_id", "sequence_number", "mapping_key", "target_table"))


def unroutable_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (routing.unroutable(event_messages(spark, sf_dir), frames.mapping(spark))
            .select("eventhub", "event_id", "sequence_number"))


def unmapped_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.unmapped_report(event_messages(spark, sf_dir), frames.mapping(spark))


def mapping_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.mapping_report(event_messages(spark, sf_dir), frames.mapping(spark))


def configuration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.configuration_report(
        event_messages(spark, sf_dir), frames.hubs(spark), frames.targets(spark),
        frames.mapping(spark))


def processing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to do after batch 2 of every hub."""
    stored = checkpoints.latest_checkpoints(
        frames.checkpoint_rows(spark, sf_dir).where("batch_id <= 2"))
    pending = checkpoints.resume_messages(event_messages(spark, sf_dir), stored, "earliest")
    return routing.processing_plan(pending, frames.mapping(spark))


# --- statistics ----------------------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("runtime_seconds", "messages_per_second")
                           if c in df.columns})


def mapping_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.mapping_stats(frames.batches(spark, sf_dir)))


def consumer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _rounded(stats.consumer_stats(frames.batched(spark, sf_dir)))
    pairs = F.transform(F.map_entries("last_checkpoint"), lambda e: F.concat_ws(
        "=", e["key"], e["value"].cast("string")))
    return found.withColumn("last_checkpoint", F.array_join(pairs, ","))


def sink_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.routed(spark, sf_dir)
    return _rounded(stats.sink_stats(
        frames.batches(spark, sf_dir),
        rows.select("target_table", labels.lane_name("c1").alias("channel"))))


def pipeline_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.pipeline_rollup(frames.batches(spark, sf_dir)))


def health_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.health_rollup(frames.batches(spark, sf_dir), frames.error_log(spark, sf_dir))


def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.error_summary(frames.error_log(spark, sf_dir))


# --- failures ------------------------------------------------------------------------------


def classify_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (failures.classify_failures(frames.error_log(spark, sf_dir))
            .select("event_id", "category", "should_retry"))


def receive_error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (failures.classify_receive_errors(frames.error_log(spark, sf_dir))
            .groupBy("mapping_key", "error_class").agg(F.count(F.lit(1)).alias("failures")))


def failure_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (failures.failure_signatures(frames.error_log(spark, sf_dir))
            .select("signature", "failures", "first_at", "category", "should_retry"))


def shared_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures with a long text, so that different texts share a signature."""
    errors = frames.error_log(spark, sf_dir).withColumn(
        "error", F.concat(F.rpad("error_type", 100, "."), F.col("error")))
    return (failures.share_decisions(errors)
            .select("event_id", "signature", "category", "should_retry"))


def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds spent waiting per mapping and attempt, over all failures worth a retry."""
    worth = failures.classify_failures(frames.error_log(spark, sf_dir)).where("should_retry")
    return (failures.backoff_schedule(worth, max_attempts=6)
            .groupBy("mapping_key", "retry_attempt", "wait_seconds")
            .agg(F.count(F.lit(1)).alias("failures"),
                 F.sum("wait_seconds").alias("total_wait")))


def decision_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 75).alias("suggested_wait_seconds"),
        (F.col("value") / 250).alias("confidence"))
    return failures.check_decisions(decisions).select("event_id", "in_bounds")


QUERIES = {f.__name__: f for f in (
    auto_mapping, explicit_mapping, route_messages, unroutable_messages, unmapped_report,
    mapping_report, configuration_report, processing_plan, mapping_stats, consumer_stats,
    sink_stats, pipeline_rollup, health_rollup, error_summary, classify_failures,
    receive_error_class, failure_signatures, shared_decisions, backoff_schedule,
    decision_bounds)}


_SEEN = "seen AS (SELECT eventhub, count(*) AS messages FROM msgs GROUP BY eventhub)"
_RUNTIME = "round((epoch_us(max(finished_at)) - epoch_us(min(started_at))) / 1000000.0, 6)"
_PROCESSED = f"""coalesce(CAST(sum(message_count) FILTER (success) AS BIGINT), 0)
    AS messages_processed,
  count(*) FILTER (success) AS batches_processed,
  max(finished_at) FILTER (success) AS last_activity,
  count(*) FILTER (NOT success) AS errors,
  {_RUNTIME} AS runtime_seconds"""
_RATE = "(epoch_us(max(finished_at)) - epoch_us(min(started_at))) / 1000000.0"


def _category(text: str) -> str:
    tests = "\n".join(f"  WHEN regexp_matches({text}, '{pattern}') THEN '{name}'"
                      for name, pattern in {**FATAL, **RETRYABLE}.items())
    return f"CASE\n{tests}\n  ELSE 'unknown' END"


def _any(phrases: list[str]) -> str:
    return " OR ".join(f"contains(lower(error), '{p}')" for p in phrases)


_RETRY = "category IN (" + ", ".join(f"'{name}'" for name in RETRYABLE) + ")"
_CLASSED = f"""{ERRORS},
classed AS (SELECT *, {_category("lower(error_type) || ' ' || lower(error)")} AS category
  FROM errors)"""

ORACLES = {
    "auto_mapping": f"""WITH {MSGS}, {MAPPING}, {_SEEN}
SELECT mapping_key, eventhub, target_table, batch_size, coalesce(messages, 0) AS messages
FROM mapping LEFT JOIN seen USING (eventhub)""",
    "explicit_mapping": """SELECT 'HUB_' || CASE event_type WHEN 'click' THEN 1 ELSE 5 END
    || '->TARGET_6' AS mapping_key, '' AS missing, count(*) AS messages
FROM events WHERE event_type IN ('click', 'view') GROUP BY event_type
UNION ALL SELECT 'HUB_9->TARGET_1', 'hub', 0 UNION ALL SELECT 'HUB_2->TARGET_5', 'target', 0""",
    "route_messages": f"""WITH {ROUTED}
SELECT eventhub, event_id, sequence_number, mapping_key, target_table FROM routed""",
    "unroutable_messages": f"""WITH {MSGS}
SELECT eventhub, event_id, sequence_number FROM msgs WHERE eventhub = 'view'""",
    "unmapped_report": f"""SELECT 'unmapped_hub' AS finding, '{NAMESPACE}' AS eventhub_namespace,
  event_type AS eventhub, CAST(NULL AS VARCHAR) AS mapping_key, count(*) AS messages
FROM events WHERE event_type = 'view' GROUP BY event_type
UNION ALL SELECT 'idle_mapping', '{NAMESPACE}', 'audit', 'HUB_7->TARGET_7', 0""",
    "mapping_report": f"""WITH {MSGS}, {MAPPING}, {_SEEN}
SELECT '{NAMESPACE}' AS eventhub_namespace, eventhub, mapping_key,
  CASE WHEN mapping_key IS NULL THEN 0 ELSE coalesce(messages, 0) END AS routed,
  CASE WHEN mapping_key IS NULL THEN messages ELSE 0 END AS unroutable,
  mapping_key IS NOT NULL AS valid
FROM seen FULL JOIN mapping USING (eventhub)""",
    "configuration_report": """SELECT CAST(6 AS BIGINT) AS hubs_count,
  CAST(6 AS BIGINT) AS targets_count, CAST(5 AS BIGINT) AS mappings_count,
  CAST(1 AS BIGINT) AS unmapped_hubs, CAST(1 AS BIGINT) AS unmapped_targets,
  count(*) FILTER (event_type <> 'view') AS routed,
  count(*) FILTER (event_type = 'view') AS unroutable, false AS valid FROM events""",
    "processing_plan": f"""WITH {LOG},
stored AS (SELECT * FROM log WHERE batch_id <= 2
  QUALIFY row_number() OVER (PARTITION BY eventhub, partition_id ORDER BY ts_inserted DESC) = 1),
pending AS (
  SELECT m.eventhub, count(*) AS messages
  FROM msgs m LEFT JOIN stored s ON m.eventhub = s.eventhub AND m.partition_id = s.partition_id
  WHERE s.waterlevel IS NULL
    OR CASE WHEN s.metadata LIKE '%"waterlevel_kind":"sequence"%' THEN m.sequence_number
       ELSE CAST(m."offset" AS BIGINT) END > s.waterlevel
  GROUP BY m.eventhub)
SELECT mapping_key, eventhub_namespace || '/' || eventhub AS source,
  target_db || '.' || target_schema || '.' || target_table AS target, consumer_group,
  batch_size, CAST(300 AS INT) AS max_wait_seconds, coalesce(messages, 0) AS pending_messages,
  CAST((coalesce(messages, 0) + batch_size - 1) // batch_size AS BIGINT) AS expected_batches
FROM mapping LEFT JOIN pending USING (eventhub)""",
    "mapping_stats": f"""WITH {BATCHES}
SELECT mapping_key, {_PROCESSED},
  round(CAST(sum(message_count) FILTER (success) AS DOUBLE) / nullif({_RATE}, 0), 6)
    AS messages_per_second
FROM batches GROUP BY mapping_key""",
    "consumer_stats": f"""WITH {MSGS},
b AS (SELECT *, arrival // 300 AS batch_id FROM msgs),
t AS (SELECT eventhub, max(batch_id) AS last_batch, count(*) AS messages_received,
    count(DISTINCT batch_id) AS batches_processed,
    (epoch_us(max(enqueued_time)) - epoch_us(min(enqueued_time))) / 1000000.0 AS secs
  FROM b GROUP BY eventhub),
l AS (SELECT b.eventhub, partition_id, max(sequence_number) AS last_sequence
  FROM b JOIN t ON b.eventhub = t.eventhub AND b.batch_id = t.last_batch
  GROUP BY b.eventhub, partition_id),
c AS (SELECT eventhub,
    string_agg(partition_id || '=' || last_sequence, ',' ORDER BY partition_id)
      AS last_checkpoint
  FROM l GROUP BY eventhub)
SELECT eventhub, messages_received, batches_processed, last_checkpoint,
  round(secs, 6) AS runtime_seconds,
  round(CAST(messages_received AS DOUBLE) / nullif(secs, 0), 6) AS messages_per_second
FROM t JOIN c USING (eventhub)""",
    "sink_stats": f"""WITH {BATCHES},
lanes AS (SELECT target_table, count(DISTINCT partition_id) AS channels_created
  FROM routed GROUP BY target_table),
sent AS (SELECT target_table,
    coalesce(CAST(sum(message_count) FILTER (success) AS BIGINT), 0) AS total_messages_sent,
    count(*) FILTER (success) AS total_batches_sent,
    count(*) FILTER (NOT success) AS failed_retries,
    max(finished_at) FILTER (success) AS last_ingestion,
    {_RATE} AS secs
  FROM batches GROUP BY target_table)
SELECT target_table, total_messages_sent, total_batches_sent, failed_retries, last_ingestion,
  round(secs, 6) AS runtime_seconds, channels_created,
  CASE WHEN total_messages_sent = 0 THEN NULL WHEN secs > 0
    THEN round(CAST(total_messages_sent AS DOUBLE) / secs, 6) ELSE 0.0 END
    AS messages_per_second
FROM sent JOIN lanes USING (target_table)""",
    "pipeline_rollup": f"""WITH {BATCHES}
SELECT mapping_key, CAST(grouping(mapping_key) AS INT) AS is_total, {_PROCESSED}
FROM batches GROUP BY ROLLUP (mapping_key)""",
    "health_rollup": f"""WITH {BATCHES}, fails AS (
  SELECT mapping_key, count(*) AS errors, max(ts) AS last_error_at
  FROM ({frames._ERROR_LOG.format(events='events', mapping='mapping')})
  GROUP BY mapping_key),
runs AS (SELECT mapping_key, count(*) AS batches,
    count(*) FILTER (NOT success) AS failed_batches, arg_max(success, batch_id) AS sink_ok,
    max(finished_at) AS last_seen
  FROM batches GROUP BY mapping_key),
each AS (SELECT mapping_key, coalesce(batches, 0) AS batches,
    coalesce(failed_batches, 0) AS failed_batches, coalesce(errors, 0) AS errors,
    coalesce(sink_ok, false) AS sink_ok, batches IS NOT NULL AS consumer_ok,
    coalesce(last_error_at <= last_seen, last_error_at IS NULL) AS recovered
  FROM runs FULL JOIN fails USING (mapping_key))
SELECT mapping_key, CAST(grouping(mapping_key) AS INT) AS is_total, count(*) AS mappings,
  CAST(sum(batches) AS BIGINT) AS batches, CAST(sum(failed_batches) AS BIGINT) AS failed_batches,
  CAST(sum(errors) AS BIGINT) AS errors, bool_and(sink_ok) AS sink_ok,
  bool_and(consumer_ok) AS consumer_ok,
  bool_and(sink_ok AND consumer_ok AND recovered) AS healthy
FROM each GROUP BY ROLLUP (mapping_key)""",
    "error_summary": f"""WITH {ERRORS}
SELECT mapping_key, error, count(*) AS failures, CAST(sum(message_count) AS BIGINT) AS messages,
  min(ts) AS first_at, max(ts) AS last_at
FROM errors GROUP BY mapping_key, error""",
    "classify_failures": f"""WITH {_CLASSED}
SELECT event_id, category, {_RETRY} AS should_retry FROM classed""",
    "receive_error_class": f"""WITH {ERRORS},
classed AS (SELECT mapping_key, CASE WHEN {_any(CREDENTIAL_PHRASES)} THEN 'credential'
    WHEN {_any(PERMISSION_PHRASES)} THEN 'rbac' ELSE 'other' END AS error_class
  FROM errors)
SELECT mapping_key, error_class, count(*) AS failures
FROM classed GROUP BY mapping_key, error_class""",
    "failure_signatures": f"""WITH {_CLASSED}
SELECT error_type || ':' || substr(error, 1, 100) AS signature, count(*) AS failures,
  min(ts) AS first_at, arg_min(category, ts) AS category,
  arg_min({_RETRY}, ts) AS should_retry
FROM classed GROUP BY error_type || ':' || substr(error, 1, 100)""",
    "shared_decisions": f"""WITH {ERRORS},
longer AS (SELECT * REPLACE (rpad(error_type, 100, '.') || error AS error) FROM errors),
classed AS (SELECT *, {_category("lower(error_type) || ' ' || lower(error)")} AS category
  FROM longer),
keyed AS (SELECT event_id, ts, category, {_RETRY} AS should_retry,
    error_type || ':' || substr(error, 1, 100) AS signature FROM classed)
SELECT event_id, signature,
  first_value(category) OVER (PARTITION BY signature ORDER BY ts) AS category,
  first_value(should_retry) OVER (PARTITION BY signature ORDER BY ts) AS should_retry
FROM keyed""",
    "backoff_schedule": f"""WITH {_CLASSED},
waits AS (SELECT mapping_key, CAST(n AS INT) AS retry_attempt,
    greatest(1.0::DOUBLE, least(10.0::DOUBLE, pow(2.0, n - 1))) AS wait_seconds
  FROM classed, range(1, 6) AS r(n) WHERE {_RETRY})
SELECT mapping_key, retry_attempt, wait_seconds, count(*) AS failures,
  sum(wait_seconds) AS total_wait
FROM waits GROUP BY mapping_key, retry_attempt, wait_seconds""",
    "decision_bounds": """SELECT event_id, event_id % 75 BETWEEN 1 AND 60
  AND value / 250 BETWEEN 0 AND 1 AS in_bounds FROM events""",
}
