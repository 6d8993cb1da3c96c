"""Event time in a stream: windows per lane, and messages with their acknowledgements.

All keep state only up to a watermark, the highest time seen less ``delay``. Rows that are older
than it when they arrive are left out by Spark, which counts them: ``late_rows`` of
``ingest.progress`` and ``ingest.ProgressLog``. A window or an unanswered message comes out once the
watermark has passed it; since only later rows move it, a stream that ends needs :func:`heartbeat`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import instant, utc
from tidegate.schema import LANE_KEY

PULSE = "__heartbeat__"


def heartbeat(rows: DataFrame, time: str, after: str) -> DataFrame:
    """One row of the same columns, in a hub of its own, that much later than the latest.

    Of an empty frame there is none.
    """
    latest = rows.agg(F.max(time).alias("_at")).where(F.col("_at").isNotNull())
    later = F.col("_at") + F.expr(f"INTERVAL {after}")
    text = {*LANE_KEY}
    return latest.select(*[
        (later if f.name == time else F.lit(PULSE) if f.name in text else F.lit(0)
         if f.name == "sequence_number" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in rows.schema])


def _watched(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """Rows with a watermark on ``time``, a UTC time without zone, as an instant."""
    return rows.withColumn(time, instant(time)).withWatermark(time, delay)


def _counted(windows: DataFrame, window: Column, keys: list[str]) -> DataFrame:
    return (windows.groupBy(window.alias("window"), *keys).agg(
        F.count(F.lit(1)).alias("messages"), F.min("sequence_number").alias("first_sequence"),
        F.max("sequence_number").alias("last_sequence"))
        .select(*keys, utc(F.col("window.start")).alias("window_start"),
                utc(F.col("window.end")).alias("window_end"), "messages", "first_sequence",
                "last_sequence"))


def tumbling(messages: DataFrame, width: str, delay: str, keys: list[str] | None = None,
             time: str = "enqueued_time") -> DataFrame:
    """Messages per lane and window of that width. Messages without a time are in no window.

    Tasks aggregate before the exchange, so a busy lane is one row a task and window.
    """
    timed = _watched(messages.where(F.col(time).isNotNull()), time, delay)
    return _counted(timed, F.window(time, width), keys or LANE_KEY)


def sessions(messages: DataFrame, gap: str, delay: str, keys: list[str] | None = None,
             time: str = "enqueued_time") -> DataFrame:
    """Messages per lane and session: a run of messages with less than ``gap`` between two.

    The message rows are first counted per lane and time; with
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` set, tasks join the
    sessions they see before the exchange.
    """
    timed = _watched(messages.where(F.col(time).isNotNull()), time, delay)
    return _counted(timed, F.session_window(time, gap), keys or LANE_KEY)


def with_acknowledgements(messages: DataFrame, acks: DataFrame, within: str, delay: str,
                          time: str = "enqueued_time", acked: str = "acked_at") -> DataFrame:
    """Every message with the time of its acknowledgement, NULL if none came ``within`` the bound.

    ``acks`` has the lane, the sequence number and ``acked``. Both sides have a watermark, so a
    message is kept until its acknowledgement can no longer come, and an acknowledgement until its
    message can no longer. The exchange is on lane and number: no lane is in one task. Several
    acknowledgements of a message give a row each; rows whose lane, number or time is null match
    nothing.
    """
    sent = _watched(messages, time, delay).alias("m")
    known = _watched(acks.select(*LANE_KEY, "sequence_number", acked), acked, delay).alias("a")
    same = [F.col(f"m.{c}") == F.col(f"a.{c}") for c in [*LANE_KEY, "sequence_number"]]
    on = (F.col(f"a.{acked}") >= F.col(f"m.{time}")) & (
        F.col(f"a.{acked}") <= F.col(f"m.{time}") + F.expr(f"INTERVAL {within}"))
    for condition in same:
        on = on & condition
    return sent.join(known, on, "left").select(
        *[utc(F.col(f"m.`{c}`")).alias(c) if c == time else F.col(f"m.`{c}`")
          for c in messages.columns], utc(F.col(f"a.{acked}")).alias(acked))
