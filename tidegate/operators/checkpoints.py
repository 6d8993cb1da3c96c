"""Waterlevels: written per batch, looked up as the newest row, used to resume."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.functions.text import utc_now
from tidegate.schema import CHECKPOINT_KEY, LANE_KEY, STREAM_KEY
from tidegate.session import small_side


def waterlevel() -> Column:
    """The offset as a number, or the sequence number where the offset is not one."""
    return F.coalesce(F.col("offset").try_cast("bigint"), F.col("sequence_number"))


def waterlevel_kind() -> Column:
    return F.when(F.col("offset").try_cast("bigint").isNotNull(), "offset").otherwise("sequence")


def checkpoint_metadata() -> Column:
    group = F.col("consumer_group")
    return F.to_json(F.struct(
        "sequence_number", F.col("offset").alias("offset_string"),
        F.col("eventhub_namespace").alias("fully_qualified_namespace"),
        F.col("eventhub").alias("eventhub_name"), group,
        waterlevel_kind().alias("waterlevel_kind")), {"ignoreNullFields": "false"})


def highest_messages(batched: DataFrame, keys: list[str], arrival: str = "arrival") -> DataFrame:
    """Position of the highest sequence per key; the first to arrive wins a tie."""
    order = F.struct(F.col("sequence_number"), -F.col(arrival))
    top = F.max_by(F.struct("offset", "sequence_number"), order)
    return batched.groupBy(*keys).agg(top.alias("top")).select(*keys, "top.*")


def batch_checkpoints(batched: DataFrame, ts_inserted: Column | None = None,
                      run_id: str = "batch", arrival: str = "arrival",
                      consumer_group: str | None = None) -> DataFrame:
    """Checkpoint rows: one per partition and batch, for routed messages with ``batch_id``."""
    if "consumer_group" not in batched.columns:
        batched = batched.withColumn("consumer_group", F.lit(consumer_group).cast("string"))
    keys = CHECKPOINT_KEY + ["batch_id", "consumer_group"]
    rows = highest_messages(batched, keys, arrival)
    when = ts_inserted if ts_inserted is not None else utc_now()
    return rows.select(
        when.cast("timestamp_ntz").alias("ts_inserted"), *STREAM_KEY,
        waterlevel().alias("waterlevel"), "partition_id",
        checkpoint_metadata().alias("metadata"), F.lit(run_id).alias("run_id"),
        F.col("batch_id").cast("bigint").alias("batch_id"))


def latest_checkpoints(log: DataFrame, namespace: str | None = None, hub: str | None = None,
                       target: tuple[str, str, str] | None = None,
                       monotone: bool = False) -> DataFrame:
    """The newest row per hub, target and partition, or the highest one if ``monotone``.

    Aggregation instead of a row number: each task first reduces its own rows.
    """
    rows = log.where(F.col("partition_id").isNotNull())
    if namespace is not None:
        rows = rows.where(F.col("eventhub_namespace") == namespace)
    if hub is not None:
        rows = rows.where(F.col("eventhub") == hub)
    if target is not None:
        for column, value in zip(("target_db", "target_schema", "target_table"), target,
                                 strict=True):
            rows = rows.where(F.col(column) == value)
    order = ["waterlevel"] if monotone else []
    newest = F.struct(*order, "ts_inserted", "batch_id", "waterlevel")
    row = F.struct("ts_inserted", "waterlevel", "metadata", "run_id", "batch_id")
    return (rows.groupBy(*CHECKPOINT_KEY).agg(F.max_by(row, newest).alias("row"))
            .select(*CHECKPOINT_KEY, "row.*"))


def upsert_checkpoints(current: DataFrame, updates: DataFrame,
                       monotone: bool = False) -> DataFrame:
    """The control table after ``updates``: replace matching keys, insert the others.

    An update wins over a stored row even when its waterlevel is lower, unless ``monotone``.
    """
    columns = [f.name for f in schema.CHECKPOINT_LOG]
    both = (current.select(columns).withColumn("_new", F.lit(0))
            .unionByName(updates.select(columns).withColumn("_new", F.lit(1))))
    rest = [c for c in columns if c not in CHECKPOINT_KEY]
    lead = ["waterlevel"] if monotone else []
    order = F.struct(*lead, "_new", "ts_inserted", "batch_id", "waterlevel")
    return (both.groupBy(*CHECKPOINT_KEY)
            .agg(F.max_by(F.struct(*rest), order).alias("row"))
            .select(*CHECKPOINT_KEY, "row.*").select(columns))


def stored_sequence() -> Column:
    """The sequence number of a checkpoint, NULL where only an offset was kept."""
    kept = F.get_json_object("metadata", "$.sequence_number").try_cast("bigint")
    kind = F.get_json_object("metadata", "$.waterlevel_kind")
    return F.coalesce(kept, F.when(kind == "sequence", F.col("waterlevel")))


def resume_listing(latest: DataFrame) -> DataFrame:
    """Where each partition of each target resumes: offset as text, and the sequence number."""
    return latest.select(
        *CHECKPOINT_KEY, F.get_json_object("metadata", "$.consumer_group").alias("consumer_group"),
        F.col("waterlevel").cast("string").alias("offset"),
        F.coalesce(stored_sequence(), "waterlevel").alias("sequence_number"))


def resume_messages(messages: DataFrame, latest: DataFrame, start: str = "latest") -> DataFrame:
    """Messages after the stored position of their partition.

    Positions are sequence numbers wherever a checkpoint kept one, and offsets only where it did
    not; the two are never compared with each other. One hub may feed several targets: a message
    is taken if any of them is behind it. Where only an offset was kept, a message whose own
    offset is not a number cannot be placed and is taken, as losing it would be worse.
    ``start`` rules over partitions without a checkpoint: ``earliest`` takes all of their
    messages, ``latest`` none of those that are already there.
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be 'earliest' or 'latest', not {start!r}")
    by_sequence = stored_sequence()
    # The target furthest behind, of those known by sequence and of those known by offset.
    stored = latest.groupBy(*LANE_KEY).agg(
        F.min(by_sequence).alias("_sequence"),
        F.min(F.when(by_sequence.isNull(), F.col("waterlevel"))).alias("_offset"))
    own = F.col("offset").try_cast("bigint")
    behind = (F.coalesce(F.col("sequence_number") > F.col("_sequence"), F.lit(False))
              | (F.col("_offset").isNotNull()
                 & F.coalesce(own > F.col("_offset"), F.lit(True))))
    unknown = F.col("_sequence").isNull() & F.col("_offset").isNull()
    fresh = unknown if start == "earliest" else F.lit(False)
    return (messages.join(small_side(stored), LANE_KEY, "left").where(fresh | behind)
            .drop("_sequence", "_offset"))


def committed_positions(landed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Highest sequence number that is durable in the target, per partition."""
    return landed.groupBy(*(keys or LANE_KEY)).agg(
        F.max("sequence_number").alias("committed_sequence"),
        F.count(F.lit(1)).alias("landed_rows"))


def checkpoint_lag(messages: DataFrame, latest: DataFrame) -> DataFrame:
    """How far each target's checkpoint is behind the messages that exist in each partition.

    A partition without a checkpoint has one row without a target.
    """
    ends = messages.groupBy(*LANE_KEY).agg(
        F.max("sequence_number").alias("end_sequence"), F.count(F.lit(1)).alias("messages"))
    stored = latest.select(*CHECKPOINT_KEY, F.coalesce(stored_sequence(), "waterlevel")
                           .alias("checkpoint_sequence"))
    return (ends.join(stored, LANE_KEY, "left")
            .withColumn("lag", F.col("end_sequence")
                        - F.coalesce("checkpoint_sequence", F.lit(-1))))


def ensure_control_table(spark: SparkSession, path: str) -> bool:
    """Create an empty control log at ``path`` unless one is there; check its columns if so.

    Returns whether it was created.
    """
    try:
        present = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        spark.createDataFrame([], schema.CHECKPOINT_LOG).write.mode("append").parquet(path)
        return True
    missing = set(schema.CHECKPOINT_LOG.names) - set(present.columns)
    if missing:
        raise ValueError(f"{path} is not a control log, it lacks {sorted(missing)}")
    return False


def read_control_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.CHECKPOINT_LOG).parquet(path)


def append_checkpoints(rows: DataFrame, path: str) -> None:
    """Append checkpoint rows, one file per batch. A repeated batch replaces its own rows."""
    (rows.select(schema.CHECKPOINT_LOG.names).repartition("run_id", "batch_id")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id")
     .parquet(path))


def compact_checkpoints(spark: SparkSession, path: str, compacted: str,
                        monotone: bool = False) -> None:
    """Write the latest rows of a log as a new log; readers and writers then switch to it.

    The new log has the folders that :func:`append_checkpoints` writes, so appends go on there.
    """
    latest = latest_checkpoints(read_control_table(spark, path), monotone=monotone)
    (latest.select(schema.CHECKPOINT_LOG.names).repartition("run_id", "batch_id")
     .write.mode("errorifexists").partitionBy("run_id", "batch_id").parquet(compacted))
