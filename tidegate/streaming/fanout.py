"""One read of a stream for all mappings, each of which lands or fails alone."""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.failure import failure_category, should_retry
from tidegate.session import delete_folder
from tidegate.streaming.sink import LANE_ROWS, TableSink

LEDGER = ("mapping_key string, run_id string, attempt int, state string, category string, "
          "error string, messages long, ts timestamp_ntz, due timestamp_ntz")
LANDED, PARKED = "landed", "parked"
#: Seconds to wait after a failed attempt, doubling from the first.
WAITS = (1, 60)
#: Mappings delivered side by side: one of them has too few lanes in a micro-batch to use a cluster.
AT_ONCE = 4


def _utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


@dataclass
class FanOutSink:
    """``foreachBatch`` callback for prepared rows of many mappings.

    A micro-batch is computed once and delivered by mapping, a few side by side. What became of each is a row of
    the ledger, written after its data: a replay skips mappings that are settled and clears what an
    unsettled one left. The rows of a mapping that fails are parked, with the category of the failure
    and, if that is worth a retry, the time when it is due; the stream goes on. :meth:`retry` delivers
    parked rows that are due. The checkpoint of a lane may pass messages that are parked: they are
    kept, not lost.

    The ledger has a folder for each micro-batch, so a micro-batch reads only its own.
    """

    target: str
    control: str
    ledger: str
    parked: str
    run_id: str = "run"
    lane_rows: int = LANE_ROWS
    #: Called with the mapping, micro-batch and attempt before a delivery; tests raise from it.
    probe: Callable[[str | None, int, int], None] = field(default=lambda key, batch_id, n: None)
    #: The clock of the ledger.
    now: Callable[[], datetime] = field(default=_utc_now)
    _ledger_lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        settled = {(r.mapping_key,) for r in self._own_ledger(spark, batch_id)}
        rows = rows.persist()
        try:
            # As many as there are mappings; null stands for messages without a route.
            keys = [r.mapping_key for r in rows.select("mapping_key").distinct().collect()
                    if (r.mapping_key,) not in settled]
            with ThreadPoolExecutor(AT_ONCE) as pool:
                deliver = inheritable_thread_target(spark)(self._deliver)
                sent = [pool.submit(deliver, rows.where(F.col("mapping_key").eqNullSafe(F.lit(key))),
                                    key, batch_id, 1) for key in keys]
            for one in sent:
                one.result()
        finally:
            rows.unpersist()

    def _deliver(self, rows: DataFrame, key: str | None, batch_id: int, attempt: int) -> bool:
        spark = rows.sparkSession
        messages = rows.count()
        try:
            self.probe(key, batch_id, attempt)
            TableSink(self.target, self.control, run_id=f"{self.run_id}.{key or ''}",
                      lane_rows=self.lane_rows)(rows, batch_id)
        except Exception as error:
            if attempt == 1:
                rows.write.mode("overwrite").parquet(self._place(key, batch_id))
            text = F.lit(str(error))
            kind = failure_category(text, F.lit(type(error).__name__))
            found = spark.range(1).select(kind.alias("category"),
                                          should_retry(kind).alias("again")).first()
            wait = min(WAITS[1], max(WAITS[0], 2 ** (attempt - 1)))
            due = self.now() + timedelta(seconds=wait) if found.again else None
            self._log(spark, batch_id, (key, self.run_id, attempt, PARKED, found.category,
                                        str(error)[:1000], messages, self.now(), due))
            return False
        self._log(spark, batch_id, (key, self.run_id, attempt, LANDED, None, None, messages,
                                    self.now(), None))
        return True

    def _place(self, key: str | None, batch_id: int) -> str:
        return f"{self.parked}/{self.run_id}/batch_id={batch_id}/{(key or '-').encode().hex()}"

    def _log(self, spark: SparkSession, batch_id: int, row: tuple) -> None:
        with self._ledger_lock:     # appends to one folder would remove each other's unfinished files
            (spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append")
             .parquet(f"{self.ledger}/batch_id={batch_id}"))

    def _own_ledger(self, spark: SparkSession, batch_id: int) -> list:
        try:
            rows = spark.read.schema(LEDGER).parquet(f"{self.ledger}/batch_id={batch_id}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return rows.where(F.col("run_id") == self.run_id).select("mapping_key").distinct().collect()

    def retry(self, spark: SparkSession) -> int:
        """Deliver what is parked and due; how many deliveries landed."""
        due = (state(spark, self.ledger).where((F.col("state") == PARKED)
                                               & (F.col("run_id") == self.run_id))
               .where(F.col("due") <= F.lit(self.now()).cast("timestamp_ntz")))
        landed = 0
        for row in due.orderBy("batch_id", "mapping_key").toLocalIterator():
            place = self._place(row.mapping_key, row.batch_id)
            if self._deliver(spark.read.parquet(place), row.mapping_key, row.batch_id,
                             row.attempt + 1):
                landed += 1
                delete_folder(spark, place)
        return landed


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{LEDGER}, batch_id long").parquet(path)


def state(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of the ledger for every run, mapping and micro-batch."""
    rows = read_ledger(spark, path)
    return (rows.groupBy("run_id", "mapping_key", "batch_id")
            .agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (
                "run_id", "mapping_key", "batch_id")]), "attempt").alias("last"))
            .select("run_id", "mapping_key", "batch_id", "last.*"))
