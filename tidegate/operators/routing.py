"""Pair hubs with targets and send messages along the pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions import labels
from tidegate.session import small_side

HUB = ["eventhub_namespace", "eventhub"]
TARGET = ["target_db", "target_schema", "target_table"]


def auto_mapping(hubs: DataFrame, targets: DataFrame) -> DataFrame:
    """Pair the hub and the target that carry the same number."""
    return (hubs.join(targets, "n")
            .withColumn("mapping_key", labels.mapping_key())
            .select("mapping_key", "n", "hub_key", "target_key", *HUB, "consumer_group",
                    *TARGET, "batch_size"))


def explicit_mapping(pairs: DataFrame, hubs: DataFrame, targets: DataFrame) -> DataFrame:
    """Resolve pairs of ``hub_key`` and ``target_key`` against both tables."""
    return (pairs.join(hubs.drop("n"), "hub_key").join(targets.drop("n"), "target_key")
            .withColumn("mapping_key", labels.mapping_key())
            .select("mapping_key", "hub_key", "target_key", *HUB, "consumer_group",
                    *TARGET, "batch_size"))


def dangling_pairs(pairs: DataFrame, hubs: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs that name a hub or a target that is not there."""
    found = (pairs
             .join(hubs.select("hub_key", F.lit(True).alias("_h")), "hub_key", "left")
             .join(targets.select("target_key", F.lit(True).alias("_t")), "target_key", "left"))
    missing = F.array_compact(F.array(F.when(F.col("_h").isNull(), F.lit("hub")),
                                      F.when(F.col("_t").isNull(), F.lit("target"))))
    return (found.withColumn("missing", F.array_join(missing, ","))
            .where("missing <> ''").select("hub_key", "target_key", "missing"))


def route(messages: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add mapping and target columns to every message whose hub is mapped."""
    return messages.join(small_side(mapping.drop("n")), HUB)


def unroutable(messages: DataFrame, mapping: DataFrame) -> DataFrame:
    """Messages whose hub has no mapping."""
    return messages.join(small_side(mapping.select(*HUB).distinct()), HUB, "left_anti")


def hub_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy(*HUB).agg(F.count(F.lit(1)).alias("messages"))


def unmapped_report(messages: DataFrame, mapping: DataFrame) -> DataFrame:
    """Hubs seen in the stream without a mapping, and mappings that received nothing."""
    both = hub_counts(messages).join(mapping.select(*HUB, "mapping_key"), HUB, "full")
    finding = (F.when(F.col("mapping_key").isNull(), F.lit("unmapped_hub"))
               .when(F.col("messages").isNull(), F.lit("idle_mapping")))
    return (both.where(F.col("mapping_key").isNull() | F.col("messages").isNull())
            .select(finding.alias("finding"), *HUB, "mapping_key",
                    F.coalesce("messages", F.lit(0)).cast("bigint").alias("messages")))


def unmapped_targets(targets: DataFrame, mapping: DataFrame) -> DataFrame:
    return targets.join(mapping, "target_key", "left_anti")


def mapping_report(messages: DataFrame, mapping: DataFrame) -> DataFrame:
    """Messages routed per mapping and, with no mapping key, messages without a route."""
    seen = hub_counts(messages)
    routed = F.when(F.col("mapping_key").isNotNull(), F.coalesce("messages", F.lit(0)))
    lost = F.when(F.col("mapping_key").isNull(), F.col("messages"))
    return (seen.join(mapping.select(*HUB, "mapping_key"), HUB, "full")
            .select(*HUB, "mapping_key",
                    F.coalesce(routed, F.lit(0)).cast("bigint").alias("routed"),
                    F.coalesce(lost, F.lit(0)).cast("bigint").alias("unroutable"),
                    F.col("mapping_key").isNotNull().alias("valid")))


def configuration_report(messages: DataFrame, hubs: DataFrame, targets: DataFrame,
                         mapping: DataFrame) -> DataFrame:
    """One row: how much is configured, how much of it is used, and whether all is valid."""
    def measure(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("measure"), F.lit(1).cast("bigint").alias("n"))

    sent = mapping_report(messages, mapping).select(F.explode(F.create_map(
        F.lit("routed"), "routed", F.lit("unroutable"), "unroutable")).alias("measure", "n"))
    every = reduce(DataFrame.unionByName, [
        measure(hubs, "hubs_count"), measure(targets, "targets_count"),
        measure(mapping, "mappings_count"),
        measure(hubs.join(mapping, "hub_key", "left_anti"), "unmapped_hubs"),
        measure(unmapped_targets(targets, mapping), "unmapped_targets"), sent])
    names = ["hubs_count", "targets_count", "mappings_count", "unmapped_hubs",
             "unmapped_targets", "routed", "unroutable"]
    totals = every.agg(*[
        F.coalesce(F.sum(F.when(F.col("measure") == name, F.col("n"))), F.lit(0))
        .cast("bigint").alias(name) for name in names])
    return totals.withColumn("valid", (F.col("unroutable") == 0) & (F.col("unmapped_hubs") == 0))


def processing_plan(pending: DataFrame, mapping: DataFrame,
                    max_wait_seconds: int = 300) -> DataFrame:
    """What a run would process: source, target, pending messages and full batches needed."""
    waiting = F.coalesce(F.col("messages"), F.lit(0)).cast("bigint")
    return (mapping.join(hub_counts(pending), HUB, "left")
            .select("mapping_key", labels.hub_path().alias("source"),
                    labels.target_name().alias("target"), "consumer_group", "batch_size",
                    F.lit(max_wait_seconds).alias("max_wait_seconds"),
                    waiting.alias("pending_messages"),
                    F.ceil(waiting / F.col("batch_size")).cast("bigint")
                    .alias("expected_batches")))
