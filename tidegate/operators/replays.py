"""Make redelivered messages harmless."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.schema import LANE_KEY
from tidegate.session import small_side

IDENTITY = LANE_KEY + ["sequence_number"]


def drop_replays(rows: DataFrame, order: str, identity: list[str] | None = None) -> DataFrame:
    """Keep one row per message, the one with the lowest ``order``.

    Copies collapse inside each task before the shuffle, so a message delivered very many
    times does not become one large group.
    """
    identity = identity or IDENTITY
    rest = [c for c in rows.columns if c not in identity]
    return (rows.groupBy(*identity).agg(F.min_by(F.struct(*rest), order).alias("row"))
            .select(*identity, "row.*").select(rows.columns))


def not_yet_landed(rows: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows whose message is not in the target; each lane reads only the slice it needs.

    The range of all lanes together, one row, is pushed to the scan of the target.
    """
    slices = small_side(rows.groupBy(*LANE_KEY).agg(F.min("sequence_number").alias("_from"),
                                                    F.max("sequence_number").alias("_to")))
    span = slices.agg(F.min("_from"), F.max("_to")).first()
    if span[0] is None:
        return rows
    landed = landed.where(F.col("sequence_number").between(*span))
    nearby = (landed.select(*IDENTITY).join(slices, LANE_KEY)
              .where(F.col("sequence_number").between(F.col("_from"), F.col("_to")))
              .select(*IDENTITY))
    return rows.join(nearby, IDENTITY, "left_anti")


def drop_stream_replays(stream: DataFrame, delay: str = "10 minutes",
                        time: str = "enqueued_time") -> DataFrame:
    """Remove copies inside a running stream; state older than ``delay`` is forgotten."""
    return (stream.withColumn("_event_time", F.col(time).cast("timestamp"))
            .withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark(IDENTITY)
            .drop("_event_time"))


def lanes(messages: DataFrame) -> DataFrame:
    """Distinct write lanes with the number of messages on each."""
    return messages.groupBy(*LANE_KEY).agg(F.count(F.lit(1)).alias("messages"))
