"""Exact size-or-age batches across the micro-batches of a stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import micros
from tidegate.operators.batching import (MAX_SIZE, MAX_WAIT_SECONDS, assign_batches,
                                         open_batches)
from tidegate.session import scratch


@dataclass
class SizedBatches:
    """``foreachBatch`` callback that numbers size-or-age batches and stores the rows.

    A micro-batch is numbered by the batch operator, so a busy hub is spread over tasks. What
    it leaves open, three numbers per hub, is kept per micro-batch; a replay starts from the
    same state and rewrites the same rows. A micro-batch must not hold messages older than
    those before it. Rows never wait for a batch to fill: the trigger delivers them, the id
    tells which batch they belong to.
    """

    path: str
    state: str
    max_size: int = MAX_SIZE
    max_wait_seconds: float = MAX_WAIT_SECONDS
    keys: list[str] = field(default_factory=lambda: ["eventhub"])
    time: str = "enqueued_time"
    #: The clock that closes the batch of a hub that fell silent; ``None`` leaves it open
    #: until the next message.
    now: Column | None = None

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        opening = self._opening(rows.sparkSession, batch_id)
        rows = rows.persist()       # the boundaries need several passes over the source
        try:
            with scratch(rows.sparkSession):        # a stream runs on: nothing may pile up
                self._number(rows, batch_id, opening)
        finally:
            rows.unpersist()

    def _number(self, rows: DataFrame, batch_id: int, opening: DataFrame | None) -> None:
        numbered = assign_batches(rows, self.max_size, self.max_wait_seconds, self.keys,
                                  self.time, opening=opening)
        folder = f"{self.path}/micro_batch={batch_id}"
        numbered.write.mode("overwrite").parquet(folder)
        written = rows.sparkSession.read.schema(numbered.schema).parquet(folder)
        left = open_batches(written, self.max_size, self.max_wait_seconds, self.keys, self.time,
                            opening)
        left.write.mode("overwrite").parquet(f"{self.state}/micro_batch={batch_id}")

    def _opening(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        if batch_id == 0:
            return None
        try:
            left = spark.read.parquet(f"{self.state}/micro_batch={batch_id - 1}")
        except AnalysisException as error:
            raise RuntimeError(f"state of micro-batch {batch_id - 1} is missing") from error
        if self.now is None:
            return left
        silent = ((F.col("held") > 0)
                  & (micros(self.now) - F.col("created") >= int(self.max_wait_seconds * 1e6)))
        return left.select(
            *self.keys,
            F.when(silent, F.col("batch_id") + 1).otherwise(F.col("batch_id")).alias("batch_id"),
            F.when(silent, F.lit(0)).otherwise(F.col("held")).cast("bigint").alias("held"),
            F.when(silent, micros(self.now)).otherwise(F.col("created")).alias("created"))
