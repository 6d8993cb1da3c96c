"""Close size-or-age batches by a timer, also where no further message arrives.

Messages are delivered by the trigger and never wait; this operator tells when a batch of a hub is
complete. Its clock is the time of processing: a batch is created by the micro-batch that brings its
first message, and closes when it is full or ``max_wait`` old. Tasks count their messages per hub
before the exchange, so a busy hub is a few numbers; the state of a hub is four numbers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidegate.operators.batching import MAX_SIZE, MAX_WAIT_SECONDS

# Task functions travel with their code: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "batch_id bigint, held bigint, created bigint, arrived bigint"
#: One row per closed batch: ``first`` and ``last`` count the messages of the hub from 0.
CLOSED = ("batch_id bigint, reason string, messages bigint, first bigint, last bigint, "
          "created_at timestamp, closed_at timestamp")
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _counted(keys: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = None, None
        for batch in batches:
            rows, kinds = pa.Table.from_batches([batch]), batch.schema
            rows = rows.append_column("messages", pa.array([1] * batch.num_rows, pa.int64()))
            if total is not None:
                rows = pa.concat_tables([total, rows])
            total = (rows.group_by(keys).aggregate([("messages", "sum")])
                     .rename_columns([*keys, "messages"]))
        if total is not None:
            yield from total.cast(kinds.append(pa.field("messages", pa.int64()))).to_batches()
    return count


class BatchClock(StatefulProcessor):
    """State of one hub: the open batch, the messages it holds, when it was created (ms), and the
    messages that arrived so far."""

    def __init__(self, keys: list[str], max_size: int, max_wait_ms: int):
        self.keys, self.max_size, self.max_wait_ms = keys, max_size, max_wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE)

    def _closed(self, key, reason: str, batch_id: int, held: int, created: int, arrived: int,
                now: int) -> Row:
        from datetime import datetime, timezone

        def at(ms):
            return datetime.fromtimestamp(ms / 1000, timezone.utc)

        names = [*self.keys, "batch_id", "reason", "messages", "first", "last", "created_at",
                 "closed_at"]
        return Row(*names)(*key, batch_id, reason, held, arrived - held, arrived - 1, at(created),
                           at(now))

    def _timers_off(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        batch_id, held, created, arrived = self.open.get() if self.open.exists() else (0, 0, now, 0)
        if held and now - created >= self.max_wait_ms:      # due, though its timer comes later
            yield self._closed(key, "age", batch_id, held, created, arrived, now)
            batch_id, held = batch_id + 1, 0
        before = batch_id if held else None
        left = sum(row["messages"] for row in rows)
        while left:
            created = created if held else now
            taken = min(left, self.max_size - held)
            held, arrived, left = held + taken, arrived + taken, left - taken
            if held == self.max_size:
                yield self._closed(key, "size", batch_id, held, created, arrived, now)
                batch_id, held = batch_id + 1, 0
        self.open.update((batch_id, held, created, arrived))
        if not held or batch_id != before:
            self._timers_off()
            if held:
                self.handle.registerTimer(created + self.max_wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        if not self.open.exists():
            return
        batch_id, held, created, arrived = self.open.get()
        if held and now - created >= self.max_wait_ms:
            yield self._closed(key, "age", batch_id, held, created, arrived, now)
            self.open.update((batch_id + 1, 0, now, arrived))

    def close(self) -> None:
        pass


def closed_batches(messages: DataFrame, max_size: int = MAX_SIZE,
                   max_wait_seconds: float = MAX_WAIT_SECONDS,
                   keys: list[str] | None = None) -> DataFrame:
    """A stream of the batches that closed, from a stream of messages.

    Every message counts, repeated ones too; messages whose key is null form a hub of their own.
    Start the query with :func:`start_closing`.
    """
    if max_size < 1 or max_wait_seconds <= 0:
        raise ValueError("a batch needs a size of 1 or more and a wait above 0")
    keys = keys or ["eventhub"]
    only = messages.select(*keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in only.schema)
    counts = only.mapInArrow(_counted(keys), f"{kinds}, messages bigint")
    return counts.groupBy(*keys).transformWithState(
        BatchClock(keys, max_size, int(max_wait_seconds * 1000)), f"{kinds}, {CLOSED}",
        outputMode="Update", timeMode="ProcessingTime")


def start_closing(closed: DataFrame, path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Append closed batches to a folder. Timers are looked at with every trigger."""
    spark = closed.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)         # the query keeps the settings it starts with
    try:
        return (closed.writeStream.foreachBatch(_write_to(path)).outputMode("update")
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "1 second"})).start())
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _write_to(path: str):
    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:        # a trigger without a closing leaves no folder; a repeated one its own again
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{path}/micro_batch={batch_id}")
        finally:
            rows.unpersist()
    return write


def read_closed(spark: SparkSession, path: str, keys: str = "eventhub string") -> DataFrame:
    """What :func:`start_closing` has written so far; the folder must exist."""
    return (spark.read.schema(f"{keys}, {CLOSED}, micro_batch bigint").parquet(path)
            .drop("micro_batch"))


def closed_messages(spark: SparkSession, path: str, keys: str = "eventhub string") -> int:
    """How many messages are in closed batches."""
    return read_closed(spark, path, keys).agg(F.coalesce(F.sum("messages"), F.lit(0))).first()[0]
