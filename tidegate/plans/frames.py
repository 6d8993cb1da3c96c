"""Inputs shared by the queries, and the same inputs as SQL for their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.batching import batches_by_size
from tidegate.operators.checkpoints import batch_checkpoints
from tidegate.operators.routing import auto_mapping, route
from tidegate.operators.stats import batch_log
from tidegate.session import pinned
from tidegate.sources.tables import NAMESPACE, event_messages

BATCH = 300
LOG_START = "2024-02-01 00:00:00"

# Hub 5 has no target, target 6 has no hub, and hub 7 receives nothing.
_HUBS = [(1, "click"), (2, "error"), (3, "purchase"), (4, "signup"), (5, "view"), (7, "audit")]
_TARGETS = [(1, "CLICK", 300), (2, "ERROR", 250), (3, "PURCHASE", 1000), (4, "SIGNUP", 128),
            (6, "REFUND", 1000), (7, "AUDIT", 1000)]

HUBS_SQL = """SELECT CAST(n AS INT) AS n, 'HUB_' || n AS hub_key,
  '{ns}' AS eventhub_namespace, eventhub, 'group' || n AS consumer_group
  FROM (VALUES {rows}) AS v(n, eventhub)""".format(
    ns=NAMESPACE, rows=", ".join(f"('{n}', '{name}')" for n, name in _HUBS))
TARGETS_SQL = """SELECT CAST(n AS INT) AS n, 'TARGET_' || n AS target_key, 'LAKE' AS target_db,
  'RAW' AS target_schema, 'EVENTS_' || t AS target_table, CAST(batch_size AS INT) AS batch_size
  FROM (VALUES {rows}) AS v(n, t, batch_size)""".format(
    rows=", ".join(f"('{n}', '{name}', {size})" for n, name, size in _TARGETS))


def hubs(spark: SparkSession) -> DataFrame:
    return spark.sql(HUBS_SQL)


def targets(spark: SparkSession) -> DataFrame:
    return spark.sql(TARGETS_SQL)


def mapping(spark: SparkSession) -> DataFrame:
    return auto_mapping(hubs(spark), targets(spark))


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches_by_size(event_messages(spark, sf_dir), BATCH)


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(batched(spark, sf_dir).drop("batch_size"), mapping(spark).drop("batch_size"))


def with_invalid_offsets(messages: DataFrame) -> DataFrame:
    """Every 50th message has an offset that is not a number."""
    return messages.withColumn("offset", F.when(F.col("event_id") % 50 == 0, F.lit("invalid"))
                               .otherwise(F.col("offset")))


def log_time():
    """Batch N is recorded N seconds after the log starts."""
    return F.expr(f"timestampadd(SECOND, batch_id, TIMESTAMP_NTZ'{LOG_START}')")


def checkpoint_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_checkpoints(with_invalid_offsets(routed(spark, sf_dir)), log_time(),
                             run_id="replay")


def control_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control log that these batches would have left behind, computed once."""
    return pinned(checkpoint_rows(spark, sf_dir))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch log in which every fifth batch of a hub failed."""
    return batch_log(routed(spark, sf_dir), F.col("batch_id") % 5 != 3)


_ERROR_TEXT = """CASE event_id % 20
  WHEN 0 THEN 'Connection timed out after ' || CAST(event_id % 7 AS STRING) || ' s'
  WHEN 1 THEN 'HTTP 503 Service Unavailable'
  WHEN 2 THEN 'HTTP 429: rate limit reached'
  WHEN 3 THEN 'Table is locked by another session'
  WHEN 4 THEN 'Temporary network issue'
  WHEN 5 THEN 'DNS lookup failed: name resolution'
  WHEN 6 THEN 'Connection pool exhausted'
  WHEN 7 THEN '401 Unauthorized'
  WHEN 8 THEN 'Status 403: access denied for user ' || CAST(user_id AS STRING)
  WHEN 9 THEN 'Schema mismatch in column ' || event_type
  WHEN 10 THEN 'Unique constraint violated'
  WHEN 11 THEN 'Invalid data format in row ' || CAST(event_id AS STRING)
  WHEN 12 THEN 'Quota exceeded for this account'
  WHEN 13 THEN '404 table not found'
  WHEN 14 THEN 'SQL syntax error near SELECT'
  WHEN 15 THEN '400 malformed request'
  WHEN 16 THEN 'Validation failed for batch'
  WHEN 17 THEN 'Failed to retrieve a token: credential expired'
  WHEN 18 THEN 'Lacks permission to listen'
  ELSE 'Something else happened' END"""
_ERROR_TYPE = """CASE event_id % 3 WHEN 0 THEN 'ConnectionError' WHEN 1 THEN 'RuntimeError'
  ELSE 'ValueError' END"""
_ERROR_LOG = f"""SELECT ts, mapping_key, {_ERROR_TYPE} AS error_type, {_ERROR_TEXT} AS error,
  1 + event_id % 300 AS message_count, CAST(1 + event_id % 3 AS INT) AS attempt, event_id
  FROM {{events}} JOIN {{mapping}} ON event_type = eventhub"""


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failure for every event, worded by its id; mapped hubs only."""
    from tidegate.sources.tables import table
    return spark.sql(_ERROR_LOG.format(events="{events}", mapping="{mapping}"),
                     events=table(spark, sf_dir, "events"), mapping=mapping(spark))


# --- the same frames for the oracle ---------------------------------------------------------

MSGS = f"""msgs AS (
  SELECT '{NAMESPACE}' AS eventhub_namespace, event_type AS eventhub,
    CAST(user_id % 4 AS VARCHAR) AS partition_id,
    row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1
      AS sequence_number,
    CAST(event_id AS VARCHAR) AS "offset", ts AS enqueued_time, props AS body,
    '{{"user_id":"' || user_id || '","event_type":"' || event_type || '"}}' AS properties,
    event_id,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS arrival
  FROM events)"""
MAPPING = f"""hubs AS ({HUBS_SQL}), targets AS ({TARGETS_SQL}),
mapping AS (
  SELECT hub_key || '->' || target_key AS mapping_key, h.n AS n, hub_key, target_key,
    eventhub_namespace, eventhub, consumer_group, target_db, target_schema, target_table,
    batch_size
  FROM hubs h JOIN targets t ON h.n = t.n)"""
ROUTED = f"""{MSGS}, {MAPPING},
routed AS (
  SELECT m.*, mapping_key, consumer_group, target_db, target_schema, target_table, batch_size,
    arrival // {BATCH} AS batch_id
  FROM msgs m JOIN mapping p ON m.eventhub = p.eventhub)"""
LOG = f"""{ROUTED},
offsets AS (
  SELECT * REPLACE (CASE WHEN event_id % 50 = 0 THEN 'invalid' ELSE "offset" END AS "offset")
  FROM routed),
log AS (
  SELECT TIMESTAMP '{LOG_START}' + to_seconds(batch_id) AS ts_inserted, eventhub_namespace,
    eventhub, target_db, target_schema, target_table,
    coalesce(TRY_CAST("offset" AS BIGINT), sequence_number) AS waterlevel, partition_id,
    '{{"sequence_number":' || sequence_number || ',"offset_string":"' || "offset"
      || '","fully_qualified_namespace":"' || eventhub_namespace || '","eventhub_name":"'
      || eventhub || '","consumer_group":"' || consumer_group || '","waterlevel_kind":"'
      || CASE WHEN "offset" = 'invalid' THEN 'sequence' ELSE 'offset' END || '"}}' AS metadata,
    'replay' AS run_id, batch_id, sequence_number
  FROM offsets
  QUALIFY row_number() OVER (PARTITION BY eventhub, partition_id, batch_id
                             ORDER BY sequence_number DESC) = 1)"""
BATCHES = f"""{ROUTED},
batches AS (
  SELECT mapping_key, target_table, batch_id, count(*) AS message_count,
    min(enqueued_time) AS started_at, max(enqueued_time) AS finished_at,
    batch_id % 5 <> 3 AS success
  FROM routed GROUP BY mapping_key, target_table, batch_id)"""
ERRORS = f"""{MAPPING}, errors AS ({_ERROR_LOG.format(events='events', mapping='mapping')})"""
