"""Message frames read from plain tables.

A table of events has no partition or sequence; both are derived, as a hub would have
assigned them, from the order in which the rows happened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.operators.ranking import ranked

NAMESPACE = "ns.servicebus.windows.net"
EVENT_PARTITIONS = 4
LINEITEM_PARTITIONS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _system_properties():
    """Transport properties; partition 3 carries an empty map."""
    return F.when(F.col("partition_id") != "3", F.create_map(
        F.lit("offset"), F.col("offset"),
        F.lit("sequence_number"), F.col("sequence_number").cast("string"))
    ).otherwise(F.create_map().cast("map<string,string>"))


def event_messages(spark: SparkSession, sf_dir: str, slot_rows: int | None = None) -> DataFrame:
    """``events`` as hub messages: one hub per event type, four partitions each.

    Besides the message columns there is ``event_id`` and ``arrival``, the place of the
    message in its hub.
    """
    keyed = table(spark, sf_dir, "events").select(
        F.lit(NAMESPACE).alias("eventhub_namespace"),
        F.col("event_type").alias("eventhub"),
        (F.col("user_id") % EVENT_PARTITIONS).cast("string").alias("partition_id"),
        F.col("event_id").cast("string").alias("offset"),
        F.col("ts").alias("enqueued_time"),
        F.col("props").cast("binary").alias("body"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string"),
                     F.lit("event_type"), F.col("event_type")).alias("properties"),
        "event_id")
    numbered = ranked(keyed, {"arrival": ["eventhub"],
                              "sequence_number": ["eventhub", "partition_id"]},
                      order=["enqueued_time", "event_id"],
                      cut_on=["enqueued_time", "event_id"], slot_rows=slot_rows)
    return numbered.select(*[c for c in schema.MESSAGE.names if c != "system_properties"],
                           _system_properties().alias("system_properties"),
                           "event_id", "arrival")


def lineitem_messages(spark: SparkSession, sf_dir: str, slot_rows: int | None = None) -> DataFrame:
    """``lineitem`` as a large hub per return flag, eight partitions each, by ship date."""
    items = table(spark, sf_dir, "lineitem")
    rest = [c for c in items.columns if c not in ("l_shipdate", "l_orderkey", "l_linenumber")]
    order = ["l_shipdate", "l_orderkey", "l_linenumber"] + rest
    keyed = items.select(
        "*", F.concat(F.lit("lineitem_"), F.lower("l_returnflag")).alias("eventhub"),
        (F.col("l_orderkey") % LINEITEM_PARTITIONS).cast("string").alias("partition_id"))
    numbered = ranked(keyed, {"arrival": ["eventhub"],
                              "sequence_number": ["eventhub", "partition_id"]},
                      order=order, cut_on=["l_shipdate", "l_orderkey", "l_linenumber"],
                      slot_rows=slot_rows)
    return numbered.select(
        F.lit(NAMESPACE).alias("eventhub_namespace"), "eventhub", "partition_id",
        "sequence_number", F.col("arrival").cast("string").alias("offset"),
        F.col("l_shipdate").alias("enqueued_time"),
        F.to_json(F.struct("l_orderkey", "l_linenumber", "l_partkey")).cast("binary")
        .alias("body"),
        F.create_map(F.lit("returnflag"), F.col("l_returnflag")).alias("properties"),
        F.create_map(F.lit("linestatus"), F.col("l_linestatus")).alias("system_properties"),
        "arrival")
