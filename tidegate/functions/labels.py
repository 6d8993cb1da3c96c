"""Names and ids that tie a row to where it came from and where it goes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CONTROL_TABLE = "INGESTION_STATUS"
DEFAULT_TARGET_TABLE = "events"


def row_id(partition_id: str = "partition_id", sequence_number: str = "sequence_number",
           index: Column | None = None) -> Column:
    """``<partition>_<sequence>``; ``index`` stands in where a row has no sequence."""
    position = F.col(sequence_number).cast("string")
    if index is not None:
        position = F.coalesce(position, index.cast("string"))
    return F.concat(F.col(partition_id), F.lit("_"), position)


def hub_path() -> Column:
    return F.concat_ws("/", "eventhub_namespace", "eventhub")


def lane_name(suffix: str) -> Column:
    """Name of the ordered write lane of one source partition."""
    return F.concat(F.col("target_table"), F.lit("_partition_"), F.col("partition_id"),
                    F.lit(f"_{suffix}"))


def channel_name(environment: str = "dev", region: str = "default",
                 client: str = "client") -> Column:
    return F.concat_ws("-", F.col("eventhub"), F.lit(environment), F.lit(region), F.lit(client))


def mapping_key() -> Column:
    return F.concat(F.col("hub_key"), F.lit("->"), F.col("target_key"))


def _or_default(value: Column, default: Column) -> Column:
    return F.coalesce(F.when(F.length(value) > 0, value), default)


def target_name() -> Column:
    """``db.schema.table`` of a target; a blank table name becomes ``events``."""
    return F.concat_ws(".", "target_db", "target_schema",
                       _or_default(F.col("target_table"), F.lit(DEFAULT_TARGET_TABLE)))


def control_name(control_db: Column, control_schema: Column, control_table: Column) -> Column:
    """``db.schema.table`` of a control table: explicit parts first, then the target's."""
    return F.concat_ws(".", _or_default(control_db, F.col("target_db")),
                       _or_default(control_schema, F.col("target_schema")),
                       _or_default(control_table, F.lit(DEFAULT_CONTROL_TABLE)))
