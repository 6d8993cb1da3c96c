"""Append micro-batches to target tables, then record how far they got."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import schema
from tidegate.functions import labels
from tidegate.functions.names import ROUTING_RULES
from tidegate.functions.text import utc_now
from tidegate.operators.checkpoints import append_checkpoints, batch_checkpoints
from tidegate.operators.envelope import to_landed
from tidegate.operators.quality import checked
from tidegate.operators.routing import HUB, TARGET
from tidegate.session import delete_folder, small_side

#: Messages of one partition that stay together in one write task.
LANE_ROWS = 500_000

#: Columns of a target table: the envelope, then where the row came from.
STORED = T.StructType(schema.LANDED.fields + schema.struct(
    row_id="string", offset="string", eventhub_namespace="string", eventhub="string",
    target_db="string", target_schema="string", consumer_group="string", mapping_key="string",
    target_table="string", run_id="string", batch_id="bigint").fields)


#: Stands for the target of messages that cannot be delivered.
NO_TARGET = "__rejected__"
#: A message that could not be delivered: the envelope as far as it goes, and why.
REJECTED = T.StructType(STORED.fields + schema.struct(reasons="string").fields)


def prepare(messages: DataFrame, mapping: DataFrame, rules: dict | None = None) -> DataFrame:
    """The part of the work that runs before the micro-batch: route, check, project.

    Every message comes out. ``reasons`` is empty for those that can be delivered; else it names
    what is wrong: no sequence number, no route, or names of the mapping that break a rule.
    """
    pairs = checked(mapping.drop("n"), ROUTING_RULES if rules is None else rules)
    routed = messages.join(small_side(pairs.drop("valid")), HUB, "left").withColumn(
        "reasons", F.concat(
            F.when(F.col("sequence_number").isNull(), F.array(F.lit("no_sequence")))
            .otherwise(F.array().cast("array<string>")),
            F.coalesce("reasons", F.array(F.lit("unroutable")))))
    return to_landed(
        routed.withColumn("row_id", labels.row_id()),
        keep=["row_id", "offset", "eventhub_namespace", "eventhub", *TARGET,
              "consumer_group", "mapping_key", "reasons"])


def delivered(rows: DataFrame) -> DataFrame:
    """Prepared rows without a reason against them."""
    return rows.where(F.size("reasons") == 0).drop("reasons")


def in_lanes(rows: DataFrame, lane_rows: int = LANE_ROWS, ordered_source: bool = False) -> DataFrame:
    """Bring each source partition together, in order of sequence.

    A busy partition is cut every ``lane_rows`` sequence numbers, so no write task grows with
    it. Sources that already give one task per partition (``ordered_source``) skip the shuffle.
    """
    if not ordered_source:
        rows = rows.repartition("target_table", *schema.LANE_KEY,
                                F.floor(F.col("sequence_number") / lane_rows))
    return rows.sortWithinPartitions("target_table", *schema.LANE_KEY, "sequence_number")


def read_target(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path).where(F.col("target_table") != NO_TARGET)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """What was received but could not be delivered, with the reasons."""
    return (spark.read.schema(REJECTED).parquet(path)
            .where(F.col("target_table") == NO_TARGET).drop("target_table"))


@dataclass
class TableSink:
    """``foreachBatch`` callback: data first, checkpoints second, failures logged and raised.

    Each micro-batch owns the folder ``run_id=.../batch_id=N`` of every target it writes. A
    replay after a crash removes what the first attempt left, in whatever target the mapping then
    named, and writes anew, so nothing is lost or doubled. Messages that cannot be delivered are
    written in the same
    pass, under a target of their own, with their reasons: :func:`read_rejected`.
    """

    target: str
    control: str
    errors: str | None = None
    run_id: str = "run"
    lane_rows: int = LANE_ROWS
    ordered_source: bool = False
    ts_inserted: Column | None = None
    #: Where to log the delivered batches, one row per mapping.
    batches: str | None = None
    #: Called with the step name before each step; tests raise from it.
    probe: object = field(default=lambda step, batch_id: None)
    #: Only the first micro-batch after a start can be a replay.
    _may_replay: bool = field(default=True, repr=False)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        landed = None
        try:
            started = spark.range(1).select(utc_now()).first()[0]
            self.probe("data", batch_id)
            if self._may_replay:
                self._clear(spark, batch_id)
            self._write(rows, batch_id)
            written = self._mine(spark, batch_id)
            if written is not None:
                landed = written.where(F.col("target_table") != NO_TARGET)
            if landed is not None and not landed.isEmpty():
                self.probe("checkpoint", batch_id)
                append_checkpoints(batch_checkpoints(landed, self.ts_inserted, self.run_id,
                                                     arrival="sequence_number"), self.control)
                if self.batches:
                    self._log_batches(landed, batch_id, started)
            self._may_replay = False
        except Exception as error:
            self._may_replay = True
            if self.errors:
                self._log_error(spark, landed, batch_id, error)
            raise

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        bad = F.size("reasons") > 0
        named = rows.withColumns({
            "target_table": F.when(bad, NO_TARGET).otherwise(F.col("target_table")),
            "reasons": F.when(bad, F.array_join("reasons", ",")),
            "run_id": F.lit(self.run_id), "batch_id": F.lit(batch_id).cast("bigint")})
        (in_lanes(named, self.lane_rows, self.ordered_source)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("target_table", "run_id", "batch_id").parquet(self.target))

    def _folders(self, spark: SparkSession, batch_id: int) -> list[str]:
        """The folders of a micro-batch, one for each target it wrote. The targets are listed, not
        the batches in them: the cost does not grow with the age of the target."""
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.target)
        files = root.getFileSystem(conf)
        if not files.exists(root):
            return []
        escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(
            self.run_id)
        places = [jvm.org.apache.hadoop.fs.Path(
            entry.getPath(), f"run_id={escaped}/batch_id={batch_id}")
            for entry in files.listStatus(root)
            if entry.getPath().getName().startswith("target_table=")]
        return [place.toString() for place in places if files.exists(place)]

    def _mine(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The micro-batch's own rows; None if it has none."""
        folders = self._folders(spark, batch_id)
        if not folders:
            return None
        return spark.read.schema(STORED).option("basePath", self.target).parquet(*folders)

    def _clear(self, spark: SparkSession, batch_id: int) -> None:
        """Remove the folders that an earlier attempt at this micro-batch wrote."""
        for folder in self._folders(spark, batch_id):
            delete_folder(spark, folder)

    def _log_batches(self, landed: DataFrame, batch_id: int, started) -> None:
        (landed.groupBy("mapping_key", F.col("eventhub").alias("channel"))
         .agg(F.count(F.lit(1)).alias("message_count"))
         .select("mapping_key", "channel", F.lit(batch_id).cast("bigint").alias("batch_id"),
                 "message_count", F.lit(True).alias("success"),
                 F.lit(started).cast("timestamp_ntz").alias("started_at"),
                 utc_now().alias("finished_at"), F.lit(self.run_id).alias("run_id"))
         .coalesce(1).write.mode("append").parquet(self.batches))

    def _log_error(self, spark: SparkSession, landed: DataFrame | None, batch_id: int,
                   error: Exception) -> None:
        """One row per mapping of the micro-batch, or one without a mapping if no row landed."""
        if landed is None:
            counts = spark.range(1).select(F.lit(None).cast("string").alias("mapping_key"),
                                           F.lit(None).cast("bigint").alias("message_count"))
        else:
            counts = landed.groupBy("mapping_key").agg(F.count(F.lit(1)).alias("message_count"))
        (counts.select(
            utc_now().alias("ts"), "mapping_key", F.lit(type(error).__name__).alias("error_type"),
            F.lit(str(error)).alias("error"), "message_count",
            F.lit(None).cast("int").alias("attempt"),
            F.lit(batch_id).cast("bigint").alias("batch_id"))
         .coalesce(1).write.mode("append").parquet(self.errors))
