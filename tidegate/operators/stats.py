"""Counters and health, as aggregates over the batch log and the error log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.failure import signature
from tidegate.functions.text import micros


def seconds_between(first: str, last: str) -> Column:
    return (F.max(micros(last)) - F.min(micros(first))) / F.lit(1_000_000.0)


def batch_log(batched: DataFrame, success: Column | None = None,
              keys: list[str] | None = None) -> DataFrame:
    """One row per batch of routed messages; its span stands for its processing time."""
    keys = keys or ["mapping_key", "target_table"]
    log = batched.groupBy(*keys, "batch_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min("enqueued_time").alias("started_at"),
        F.max("enqueued_time").alias("finished_at"))
    return log.withColumn("success", success if success is not None else F.lit(True))


def _processed() -> list[Column]:
    done = F.col("success")
    return [
        F.coalesce(F.sum(F.when(done, F.col("message_count"))), F.lit(0)).cast("bigint")
        .alias("messages_processed"),
        F.count_if(done).alias("batches_processed"),
        F.max(F.when(done, F.col("finished_at"))).alias("last_activity"),
        F.count_if(~done).alias("errors"),
        seconds_between("started_at", "finished_at").alias("runtime_seconds")]


def mapping_stats(log: DataFrame) -> DataFrame:
    """Throughput per mapping; the rate is NULL while nothing has been processed."""
    rate = F.when(F.col("messages_processed") > 0,
                  F.try_divide(F.col("messages_processed").cast("double"), "runtime_seconds"))
    return (log.groupBy("mapping_key").agg(*_processed())
            .withColumn("messages_per_second", rate))


def consumer_stats(batched: DataFrame) -> DataFrame:
    """Messages and batches per hub, and the last sequence per partition of its last batch."""
    lanes = batched.groupBy("eventhub", "batch_id", "partition_id").agg(
        F.max_by("sequence_number", "arrival").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.min("enqueued_time").alias("first_time"), F.max("enqueued_time").alias("last_time"))
    # A batch has at most max_size partitions, so these lists are bounded.
    batches = lanes.groupBy("eventhub", "batch_id").agg(
        F.sum("n").alias("n"), F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("partition_id", "last"))))
        .alias("last_checkpoint"))
    rate = F.try_divide(F.col("messages_received").cast("double"), "runtime_seconds")
    return (batches.groupBy("eventhub").agg(
        F.sum("n").alias("messages_received"), F.count(F.lit(1)).alias("batches_processed"),
        F.max_by("last_checkpoint", "batch_id").alias("last_checkpoint"),
        seconds_between("first_time", "last_time").alias("runtime_seconds"))
        .withColumn("messages_per_second", rate))


def sink_stats(log: DataFrame, channels: DataFrame) -> DataFrame:
    """Rows and batches sent per target, channels opened, failed sends, rate (0 if no time).

    ``channels`` holds ``target_table`` and ``channel`` of the rows that were sent.
    """
    done = F.col("success")
    sent = log.groupBy("target_table").agg(
        F.coalesce(F.sum(F.when(done, F.col("message_count"))), F.lit(0)).cast("bigint")
        .alias("total_messages_sent"),
        F.count_if(done).alias("total_batches_sent"),
        F.count_if(~done).alias("failed_retries"),
        F.max(F.when(done, F.col("finished_at"))).alias("last_ingestion"),
        seconds_between("started_at", "finished_at").alias("runtime_seconds"))
    opened = (channels.select("target_table", "channel").distinct()
              .groupBy("target_table").agg(F.count(F.lit(1)).alias("channels_created")))
    rate = F.when(F.col("runtime_seconds") > 0,
                  F.col("total_messages_sent").cast("double") / F.col("runtime_seconds"))
    return (sent.join(opened, "target_table", "left")
            .withColumn("channels_created", F.coalesce("channels_created", F.lit(0)))
            .withColumn("messages_per_second",
                        F.when(F.col("total_messages_sent") > 0,
                               F.coalesce(rate, F.lit(0.0)))))


def pipeline_rollup(log: DataFrame) -> DataFrame:
    """Detail per mapping and the grand total (``is_total`` = 1) in one pass."""
    return log.rollup("mapping_key").agg(
        F.grouping_id().cast("int").alias("is_total"), *_processed())


def health_rollup(log: DataFrame, errors: DataFrame) -> DataFrame:
    """Condition of each mapping and, with a NULL key, of the whole pipeline.

    A mapping is healthy when its newest batch went through and has no failure after it.
    """
    batches = log.groupBy("mapping_key").agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(~F.col("success")).alias("failed_batches"),
        F.max_by("success", "batch_id").alias("sink_ok"),
        F.max("finished_at").alias("last_seen"))
    failures = errors.groupBy("mapping_key").agg(
        F.count(F.lit(1)).alias("errors"), F.max("ts").alias("last_error_at"))
    each = (batches.join(failures, "mapping_key", "full")
            .select("mapping_key",
                    F.coalesce("batches", F.lit(0)).alias("batches"),
                    F.coalesce("failed_batches", F.lit(0)).alias("failed_batches"),
                    F.coalesce("errors", F.lit(0)).alias("errors"),
                    F.coalesce("sink_ok", F.lit(False)).alias("sink_ok"),
                    F.col("batches").isNotNull().alias("consumer_ok"),
                    F.coalesce(F.col("last_error_at") <= F.col("last_seen"),
                               F.col("last_error_at").isNull()).alias("recovered")))
    return (each.rollup("mapping_key").agg(
        F.grouping_id().cast("int").alias("is_total"),
        F.count(F.lit(1)).alias("mappings"),
        F.sum("batches").alias("batches"),
        F.sum("failed_batches").alias("failed_batches"),
        F.sum("errors").alias("errors"),
        F.bool_and("sink_ok").alias("sink_ok"),
        F.bool_and("consumer_ok").alias("consumer_ok"),
        F.bool_and(F.col("sink_ok") & F.col("consumer_ok") & F.col("recovered"))
        .alias("healthy")))


def error_summary(errors: DataFrame) -> DataFrame:
    """Failures per mapping and message text, with the messages they held up."""
    return errors.groupBy("mapping_key", "error").agg(
        F.count(F.lit(1)).alias("failures"),
        F.sum("message_count").alias("messages"),
        F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))


def health_errors(errors: DataFrame, most: int) -> DataFrame:
    """The ``most`` frequent failures of each mapping and, with a NULL key, of the pipeline.

    Failures are counted by signature before they are ranked, so what is ranked grows with the
    number of different failures, not with the log; each comes with its newest text.
    """
    newest = F.struct("ts", "error")
    signed = errors.withColumn(
        "signature", signature(F.col("error_type"), F.col("error"))).groupBy("mapping_key", "signature").agg(
        F.count(F.lit(1)).alias("failures"), F.max(newest).alias("newest"))
    both = signed.unionByName(signed.groupBy("signature").agg(
        F.sum("failures").alias("failures"), F.max("newest").alias("newest"))
        .withColumn("mapping_key", F.lit(None).cast("string")))
    order = Window.partitionBy("mapping_key").orderBy(F.desc("failures"), "signature")
    return (both.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
            .select("mapping_key", "place", "signature", "failures",
                    F.col("newest.ts").alias("last_at"), F.col("newest.error").alias("last_error")))
