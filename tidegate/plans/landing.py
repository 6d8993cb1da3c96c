"""Queries that turn messages into rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import labels
from tidegate.functions.names import ROUTING_RULES, is_account, is_sql_identifier
from tidegate.functions.text import clean_map, clean_text, iso_timestamp
from tidegate.operators import envelope, quality, replays, routing
from tidegate.plans import frames
from tidegate.plans.frames import MSGS, ROUTED
from tidegate.sources.tables import NAMESPACE, event_messages, table


def envelope_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = envelope.to_envelope(event_messages(spark, sf_dir), keep=["eventhub"])
    return envelope.with_row_id(envelope.land(wrapped)).drop("ingestion_timestamp")


def staged_json_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows staged as JSON text and landed path by path, six columns; every tenth is no JSON and
    comes back as the text that it is, with the reason."""
    text = F.to_json(F.struct(
        F.col("props").alias("event_body"),
        (F.col("user_id") % 4).cast("string").alias("partition_id"),
        F.col("event_id").alias("sequence_number"),
        iso_timestamp("ts").alias("enqueued_time"),
        F.concat(F.lit("{\"type\":\""), F.col("event_type"), F.lit("\"}")).alias("properties"),
        F.concat(F.lit("{\"user\":"), F.col("user_id").cast("string"), F.lit("}"))
        .alias("system_properties")))
    staged = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("#"), text))
        .otherwise(text).alias("staged"))
    return envelope.land_staged(staged).drop("ingestion_timestamp").unionByName(
        envelope.rejected_staged(staged), allowMissingColumns=True)


def null_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = event_messages(spark, sf_dir).withColumn(
        "sequence_number", F.when(F.col("event_id") % 97 != 0, F.col("sequence_number")))
    return envelope.guarded(holes).select("eventhub", "partition_id", "sequence_number", "offset")


def null_guard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = event_messages(spark, sf_dir).withColumn(
        "sequence_number", F.when(F.col("event_id") % 97 != 0, F.col("sequence_number")))
    return envelope.guard_report(holes, ["eventhub", "partition_id"])


def bytes_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as bytes, followed by bytes that are not UTF-8."""
    raw = F.concat(F.encode("text", "utf-8"), F.unhex(F.lit("FFFE41")))
    # Two keys that are not UTF-8 decode alike; the later one counts.
    tags = F.create_map(
        F.encode(F.lit("lang"), "utf-8"), F.concat(F.encode("lang", "utf-8"), F.unhex(F.lit("C3"))),
        F.unhex(F.lit("FF")), F.encode("source", "utf-8"),
        F.unhex(F.lit("FE")), F.encode(F.upper("source"), "utf-8"))
    clean = clean_map(tags)
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean_text(raw).alias("cleaned"),
        F.element_at(clean, "lang").alias("cleaned_lang"),
        F.element_at(clean, "\ufffd").alias("alike"))


def iso_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("src"), F.col("o_orderkey").alias("id"),
        iso_timestamp("o_orderdate").alias("iso"))
    events = table(spark, sf_dir, "events").select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"),
        iso_timestamp("ts").alias("iso"))
    return orders.unionByName(events)


def lineage_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = routing.route(event_messages(spark, sf_dir), frames.mapping(spark))
    blank = F.lit(None).cast("string")
    return rows.select(
        "eventhub", "event_id", "mapping_key",
        labels.row_id().alias("row_id"),
        labels.hub_path().alias("source_path"),
        labels.lane_name("c1").alias("lane"),
        labels.channel_name("production", "us-east", "c1").alias("channel"),
        labels.target_name().alias("target_name"),
        labels.control_name(blank, F.lit(""), blank).alias("control_name"))


def first_message_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.first_messages(event_messages(spark, sf_dir))


def distinct_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replays.lanes(event_messages(spark, sf_dir))


def quarantine_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, suppliers and parts as routing names, good and bad, with broken rules."""
    ns = F.when(F.col("id") % 3 == 0, F.lit("elsewhere.example.net")).otherwise(NAMESPACE)
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("src"), F.col("c_custkey").alias("id"),
        F.col("c_name").alias("eventhub"), F.col("c_mktsegment").alias("hub_key"),
        F.lit("DB$NAME").alias("target_table"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("src"), F.col("s_suppkey").alias("id"),
        F.translate("s_name", "#", "-").alias("eventhub"), F.upper("s_name").alias("hub_key"),
        F.translate("s_name", "#", "-").alias("target_table"))
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("src"), F.col("p_partkey").alias("id"),
        F.translate("p_name", " ", ".").alias("eventhub"), F.col("p_type").alias("hub_key"),
        F.col("p_name").alias("target_table"))
    names = customers.unionByName(suppliers).unionByName(parts)
    blank = F.when(F.col("id") % 5 == 0, F.lit(" \t")).otherwise("g")
    named = names.withColumns({
        "eventhub_namespace": ns, "consumer_group": blank,
        "target_db": F.when(F.col("id") % 7 == 0, F.lit("\n")).otherwise(F.lit(" DB-1 ")),
        "target_schema": F.col("hub_key"), "target_key": F.upper("eventhub"),
        "account": F.concat("eventhub", F.when(F.col("id") % 2 == 0, "!").otherwise(""))})
    rules = {**ROUTING_RULES, "sql_identifier": ("target_table", is_sql_identifier),
             "account": ("account", is_account)}
    return quality.checked(named, rules).select(
        "src", "id", "eventhub", "hub_key", "target_table",
        F.array_join("reasons", ",").alias("reasons"))


QUERIES = {f.__name__: f for f in (
    envelope_landed, staged_json_landed, null_guard, null_guard_report, bytes_clean,
    iso_timestamps, lineage_labels, first_message_per_partition, distinct_lanes,
    quarantine_names)}


def _iso(column: str) -> str:
    return (f"CASE WHEN date_trunc('second', {column}) = {column} "
            f"THEN strftime({column}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00'")


def _broken(name: str, test: str) -> str:
    return f"CASE WHEN NOT coalesce({test}, false) THEN ',{name}' ELSE '' END"


ORACLES = {
    "envelope_landed": f"""WITH {MSGS}
SELECT eventhub, body AS event_body, partition_id, sequence_number, enqueued_time, properties,
  CASE WHEN partition_id <> '3' THEN '{{"offset":"' || "offset" || '","sequence_number":"'
    || sequence_number || '"}}' END AS system_properties,
  partition_id || '_' || sequence_number AS row_id
FROM msgs""",
    "staged_json_landed": f"""WITH typed AS (SELECT event_id, props AS event_body,
    CAST(user_id % 4 AS VARCHAR) AS partition_id, event_id AS sequence_number,
    ts AS enqueued_time, '{{"type":"' || event_type || '"}}' AS properties,
    '{{"user":' || user_id || '}}' AS system_properties, {_iso('ts')} AS iso FROM events)
SELECT * EXCLUDE (iso), NULL AS staged, NULL AS reason FROM typed WHERE event_id % 10 <> 0
UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL,
  '#' || CAST(json_object('event_body', event_body, 'partition_id', partition_id,
    'sequence_number', sequence_number, 'enqueued_time', iso, 'properties', properties,
    'system_properties', system_properties) AS VARCHAR), 'no_json'
FROM typed WHERE event_id % 10 = 0""",
    "null_guard": f"""WITH {MSGS}
SELECT eventhub, partition_id, sequence_number, "offset" FROM msgs WHERE event_id % 97 <> 0""",
    "null_guard_report": f"""WITH {MSGS}
SELECT eventhub, partition_id, count(*) FILTER (event_id % 97 <> 0) AS kept,
  count(*) FILTER (event_id % 97 = 0) AS dropped
FROM msgs GROUP BY eventhub, partition_id""",
    "bytes_clean": """SELECT doc_id, text || chr(65533) || chr(65533) || 'A' AS cleaned,
  lang || chr(65533) AS cleaned_lang, upper(source) AS alike FROM documents""",
    "iso_timestamps": f"""SELECT 'orders' AS src, o_orderkey AS id, {_iso('o_orderdate')} AS iso
FROM orders UNION ALL SELECT 'events', event_id, {_iso('ts')} FROM events""",
    "lineage_labels": f"""WITH {ROUTED}
SELECT eventhub, event_id, mapping_key, partition_id || '_' || sequence_number AS row_id,
  eventhub_namespace || '/' || eventhub AS source_path,
  target_table || '_partition_' || partition_id || '_c1' AS lane,
  eventhub || '-production-us-east-c1' AS channel,
  'LAKE.RAW.' || target_table AS target_name, 'LAKE.RAW.INGESTION_STATUS' AS control_name
FROM routed""",
    "first_message_per_partition": f"""WITH {MSGS}
SELECT eventhub_namespace, eventhub, partition_id, "offset", sequence_number, enqueued_time
FROM msgs QUALIFY row_number() OVER (PARTITION BY eventhub, partition_id ORDER BY arrival) = 1""",
    "distinct_lanes": f"""SELECT '{NAMESPACE}' AS eventhub_namespace, event_type AS eventhub,
  CAST(user_id % 4 AS VARCHAR) AS partition_id, count(*) AS messages
FROM events GROUP BY event_type, user_id % 4""",
    "quarantine_names": f"""WITH named AS (
  SELECT 'customer' AS src, c_custkey AS id, c_name AS eventhub, c_mktsegment AS hub_key,
    'DB$NAME' AS target_table FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, replace(s_name, '#', '-'), upper(s_name),
    replace(s_name, '#', '-') FROM supplier
  UNION ALL SELECT 'part', p_partkey, replace(p_name, ' ', '.'), p_type, p_name FROM part),
checked AS (SELECT *,
  {_broken('namespace', "id % 3 <> 0")}
  || {_broken('eventhub', "regexp_full_match(eventhub, '[a-zA-Z0-9][a-zA-Z0-9._-]*[a-zA-Z0-9]')")}
  || {_broken('consumer_group', "id % 5 <> 0")}
  || {_broken('target_db', "id % 7 <> 0")}
  || {_broken('target_schema', "regexp_full_match(translate(trim(hub_key), '_$-', ''), '[a-zA-Z0-9]+')")}
  || {_broken('target_table', "regexp_full_match(translate(trim(target_table), '_$-', ''), '[a-zA-Z0-9]+')")}
  || {_broken('hub_key', "regexp_full_match(hub_key, '[A-Z0-9_]+')")}
  || {_broken('target_key', "regexp_full_match(upper(eventhub), '[A-Z0-9_]+')")}
  || {_broken('sql_identifier', "regexp_full_match(target_table, '[A-Za-z0-9_$]+')")}
  || {_broken('account', "id % 2 <> 0 AND regexp_full_match(eventhub, '[A-Za-z0-9._-]+')")}
  AS broken
  FROM named)
SELECT src, id, eventhub, hub_key, target_table, substr(broken, 2) AS reasons FROM checked""",
}
