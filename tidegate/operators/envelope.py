"""From message to envelope to landed row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.functions import labels
from tidegate.functions.text import clean_text, iso_timestamp, properties_json, utc_now


def _json(messages: DataFrame, column: str) -> Column:
    kind = messages.schema[column].dataType
    of_bytes = "binary" in (kind.keyType.typeName(), kind.valueType.typeName())
    return properties_json(column, of_bytes).alias(column)


def guarded(messages: DataFrame) -> DataFrame:
    """Keep messages that have a sequence number."""
    return messages.where(F.col("sequence_number").isNotNull())


def guard_report(messages: DataFrame, keys: list[str]) -> DataFrame:
    """Messages kept and dropped by :func:`guarded`, per group."""
    return messages.groupBy(keys).agg(
        F.count("sequence_number").alias("kept"),
        F.count_if(F.col("sequence_number").isNull()).alias("dropped"))


def to_envelope(messages: DataFrame, keep: list[str] | None = None,
                stamp: Column | None = None) -> DataFrame:
    """Wrap messages in the seven envelope columns, after any ``keep`` columns.

    ``stamp`` is the ingestion time, by default the start of the query or micro-batch.
    """
    return messages.select(
        *(keep or []),
        clean_text("body").alias("event_body"),
        "partition_id",
        "sequence_number",
        iso_timestamp("enqueued_time").alias("enqueued_time"),
        _json(messages, "properties"),
        _json(messages, "system_properties"),
        iso_timestamp(stamp if stamp is not None else utc_now())
        .alias("ingestion_timestamp"))


def _landing(kept: list[str], value, stamp: Column | None) -> list[Column]:
    """Select list of the target table; ``value`` gives a column of the staged row."""
    typed = [value(f.name, f.dataType.simpleString()).alias(f.name)
             for f in schema.LANDED if f.name != "ingestion_timestamp"]
    when = stamp if stamp is not None else utc_now()
    return [F.col(c) for c in kept] + typed + [when.alias("ingestion_timestamp")]


def land(envelopes: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Cast envelope columns to the types of the target table.

    The client's stamp is replaced by the landing time. Other columns pass through.
    """
    kept = [c for c in envelopes.columns if c not in schema.ENVELOPE.names]
    return envelopes.select(_landing(kept, lambda name, kind: F.col(name).try_cast(kind), stamp))


def _is_object(parsed: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), F.lit(False))


def rejected_staged(staged: DataFrame, column: str = "staged") -> DataFrame:
    """Staged rows that :func:`land_staged` does not land, with their text and the reason."""
    parsed = F.try_parse_json(column)
    return staged.where(~_is_object(parsed)).withColumn(
        "reason", F.when(F.col(column).isNull(), "no_text").when(parsed.isNull(), "no_json")
        .otherwise("no_object"))


def land_staged(staged: DataFrame, column: str = "staged",
                stamp: Column | None = None) -> DataFrame:
    """Land rows staged as JSON text, one path per target column.

    Text that is no JSON object is not landed: :func:`rejected_staged` has it, as it came.
    """
    kept = [c for c in staged.columns if c != column]
    parsed = staged.withColumn(column, F.try_parse_json(column)).where(_is_object(F.col(column)))
    return parsed.select(_landing(
        kept, lambda name, kind: F.try_variant_get(F.col(column), f"$.{name}", kind), stamp))


def to_landed(messages: DataFrame, keep: list[str] | None = None,
              stamp: Column | None = None) -> DataFrame:
    """``land(to_envelope(messages))`` without writing times as text in between."""
    return messages.select(
        *(keep or []),
        clean_text("body").alias("event_body"),
        "partition_id",
        F.col("sequence_number").cast("bigint").alias("sequence_number"),
        F.col("enqueued_time").cast("timestamp_ntz").alias("enqueued_time"),
        _json(messages, "properties"),
        _json(messages, "system_properties"),
        (stamp if stamp is not None else utc_now()).alias("ingestion_timestamp"))


def with_row_id(df: DataFrame) -> DataFrame:
    """Add the id under which a row is appended; unique within hub and partition."""
    return df.withColumn("row_id", labels.row_id())


def first_messages(messages: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The first message seen on each partition."""
    first = F.min_by(F.struct("offset", "sequence_number", "enqueued_time"), arrival)
    return (messages.groupBy(*schema.LANE_KEY).agg(first.alias("first"))
            .select(*schema.LANE_KEY, "first.*"))
