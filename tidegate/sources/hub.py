"""Hub streams: reading them, turning them into messages, and where to start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.functions.text import clean_text, last_per_key, utc
from tidegate.operators.checkpoints import stored_sequence


def kafka_hub(spark: SparkSession, servers: str, hubs: list[str],
              starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
              options: dict[str, str] | None = None) -> DataFrame:
    """Stream several hubs through their Kafka endpoint; needs Spark's Kafka connector.

    One source with ``eventhub`` as a column serves all hubs, and Spark reads one task per
    hub partition.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(hubs))
              .option("includeHeaders", "true")
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.options(**(options or {})).load()


def from_kafka(records: DataFrame, namespace: str) -> DataFrame:
    """Kafka records, batch or stream, as messages. Records without a value are dropped."""
    headers = last_per_key(F.transform(
        F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")),
        lambda h: F.struct(clean_text(h["key"]).alias("key"),
                           clean_text(h["value"]).alias("value"))))
    return records.where(F.col("value").isNotNull()).select(
        F.lit(namespace).alias("eventhub_namespace"),
        F.col("topic").alias("eventhub"),
        F.col("partition").cast("string").alias("partition_id"),
        F.col("offset").cast("bigint").alias("sequence_number"),
        F.col("offset").cast("string").alias("offset"),
        utc(F.col("timestamp")).alias("enqueued_time"),
        F.col("value").alias("body"),
        headers.alias("properties"),
        F.create_map(F.lit("offset"), F.col("offset").cast("string"),
                     F.lit("timestamp_type"), F.col("timestampType").cast("string"))
        .alias("system_properties"))


def file_hub(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
             columns: str | None = None) -> DataFrame:
    """Stream a folder of Parquet files with message columns and any extra ``columns`` (DDL)."""
    kinds = schema.MESSAGE
    if columns:
        kinds = type(kinds)(kinds.fields + type(kinds).fromDDL(columns).fields)
    reader = spark.readStream.schema(kinds).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def write_hub(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Store messages as files in order of time, to be streamed back by :func:`file_hub`."""
    by = ["enqueued_time", "partition_id", "sequence_number"]
    ranged = (messages.repartitionByRange(files, *by) if files
              else messages.repartitionByRange(*by))
    ranged.write.mode("errorifexists").parquet(path)


def start_positions(latest: DataFrame, hub_partitions: DataFrame,
                    start: str = "latest") -> DataFrame:
    """Next position per partition: after the checkpoint, else -1 (latest) or -2 (earliest).

    A position counts messages, so it follows the stored sequence number; the waterlevel stands
    in only where a checkpoint kept nothing else. The target furthest behind decides.
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be 'earliest' or 'latest', not {start!r}")
    fresh = -1 if start == "latest" else -2
    stored = latest.groupBy(*schema.LANE_KEY).agg(F.min(F.coalesce(stored_sequence(), "waterlevel")).alias("reached"))
    return (hub_partitions.select(*schema.LANE_KEY).distinct()
            .join(stored, schema.LANE_KEY, "left")
            .select(*schema.LANE_KEY, F.coalesce(F.col("reached") + 1, F.lit(fresh))
                    .cast("bigint").alias("position")))


def _json(keys: Column, values: Column) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(keys, values)))


def starting_offsets(positions: DataFrame) -> str:
    """The ``startingOffsets`` option of the Kafka source for these positions.

    One number per hub partition, so the text is as small as the list of partitions.
    """
    hubs = positions.groupBy("eventhub").agg(
        _json(F.col("partition_id"), F.col("position")).alias("at"))
    row = hubs.agg(F.to_json(_json(F.col("eventhub"), F.col("at"))).alias("json")).first()
    return row.json or "{}"
