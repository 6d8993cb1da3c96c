"""Start, stop and observe ingestion queries."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegate.operators.routing import HUB
from tidegate.session import small_side
from tidegate.streaming.sink import TableSink, prepare

#: How often the age of the open micro-batch is looked at, unless a trigger is given.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}


def start_ingest(messages: DataFrame, mapping: DataFrame, sink: TableSink, checkpoint: str,
                 trigger: dict | None = None, name: str | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 rules: dict | None = None) -> StreamingQuery:
    """Deliver a message stream into the mapped targets.

    ``rules`` are those that the names of a mapping must keep, by default all of them.

    ``trigger={"availableNow": True}`` drains what is there and stops. ``transform`` is the
    user's step on the rows of a batch, applied before they are written.
    """
    counted = messages.observe(
        f"messages_{name or sink.run_id}", F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("sequence_number").isNull()).alias("without_sequence"))
    rows = prepare(counted, mapping, rules)
    if transform is not None:
        rows = rows.transform(transform)
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def start_per_mapping(messages: DataFrame, mapping: DataFrame, keys: list[str],
                      sink_for: Callable[[str], TableSink], checkpoint: str,
                      trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """One query per mapping key: each fails, restarts and keeps its position on its own."""
    queries = {}
    for key in keys:
        folder = re.sub(r"[^A-Za-z0-9_]", "_", key)
        mine = mapping.where(F.col("mapping_key") == key)
        # Messages of other hubs are another query's; none of them is a message without a route.
        own = messages.join(small_side(mine.select(*HUB).distinct()), HUB, "left_semi")
        queries[key] = start_ingest(own, mine, sink_for(key), f"{checkpoint}/{folder}", trigger)
    return queries


def wait_all(queries: dict[str, StreamingQuery], seconds: float | None = None) -> None:
    """Wait for every query; one failure does not stop the others but is raised at the end."""
    deadline = None if seconds is None else time.monotonic() + seconds
    failed: dict[str, Exception] = {}
    for key, query in queries.items():
        try:
            if deadline is None:
                query.awaitTermination()
            else:
                query.awaitTermination(max(0.001, deadline - time.monotonic()))
        except Exception as error:
            failed[key] = error
    if failed:
        raise RuntimeError("failed mappings: " + "; ".join(
            f"{key}: {error}" for key, error in failed.items())) from next(iter(failed.values()))


def stop_gracefully(query: StreamingQuery, seconds: float = 60) -> None:
    """Let the running micro-batch finish, then stop."""
    deadline = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
        time.sleep(0.1)
    query.stop()


PROGRESS = """run_id STRING, batch_id BIGINT, timestamp STRING, input_rows BIGINT,
    rows_per_second DOUBLE, received BIGINT, without_sequence BIGINT,
    late_rows BIGINT"""


def _progress_row(p) -> tuple:
    seen = next((row for name, row in (p["observedMetrics"] or {}).items()
                 if name.startswith("messages_")), None)
    return (str(p["runId"]), int(p["batchId"]), str(p["timestamp"]), int(p["numInputRows"]),
            float(p["processedRowsPerSecond"] or 0.0), int(seen["received"]) if seen else None,
            int(seen["without_sequence"]) if seen else None,
            sum(int(op["numRowsDroppedByWatermark"]) for op in p["stateOperators"] or []))


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The latest micro-batches of a query with their observed counts, one row each.

    Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them; :class:`ProgressLog`
    stores all.
    """
    return spark.createDataFrame([_progress_row(p) for p in query.recentProgress], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Appends every micro-batch of the session's queries to a table, for as long as it is
    registered with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = _progress_row(json.loads(event.progress.json))
        (self.spark.createDataFrame([row], PROGRESS).coalesce(1)
         .write.mode("append").parquet(self.path))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
