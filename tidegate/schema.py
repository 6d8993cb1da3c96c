"""Column types of every frame that is stored or exchanged."""

from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
          "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType()}


def struct(**columns: str) -> T.StructType:
    """A schema from column names and type names; needs no running session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in columns.items()])


#: What a hub delivers, one row per message.
MESSAGE = T.StructType([
    T.StructField("eventhub_namespace", T.StringType()),
    T.StructField("eventhub", T.StringType()),
    T.StructField("partition_id", T.StringType()),
    T.StructField("sequence_number", T.LongType()),
    T.StructField("offset", T.StringType()),
    T.StructField("enqueued_time", T.TimestampNTZType()),
    T.StructField("body", T.BinaryType()),
    T.StructField("properties", _TEXT_MAP),
    T.StructField("system_properties", _TEXT_MAP),
])

#: The seven columns a message is wrapped in, times still as text.
ENVELOPE = struct(
    event_body="string", partition_id="string", sequence_number="bigint", enqueued_time="string",
    properties="string", system_properties="string", ingestion_timestamp="string")

#: A row of a target table.
LANDED = struct(
    event_body="string", partition_id="string", sequence_number="bigint",
    enqueued_time="timestamp_ntz", properties="string", system_properties="string",
    ingestion_timestamp="timestamp_ntz")

#: Columns that name the hub and the target of a checkpoint, besides the partition.
STREAM_KEY = ["eventhub_namespace", "eventhub", "target_db", "target_schema", "target_table"]
CHECKPOINT_KEY = STREAM_KEY + ["partition_id"]
LANE_KEY = ["eventhub_namespace", "eventhub", "partition_id"]

#: Append-only log of waterlevels.
CHECKPOINT_LOG = struct(
    ts_inserted="timestamp_ntz", eventhub_namespace="string", eventhub="string",
    target_db="string", target_schema="string", target_table="string", waterlevel="bigint",
    partition_id="string", metadata="string", run_id="string", batch_id="bigint")

#: One row per processed batch.
BATCH_LOG = struct(
    mapping_key="string", channel="string", batch_id="bigint", message_count="bigint",
    success="boolean", started_at="timestamp_ntz", finished_at="timestamp_ntz")

#: One row per failure.
ERROR_LOG = struct(
    ts="timestamp_ntz", mapping_key="string", error_type="string", error="string",
    message_count="bigint", attempt="int")

HUBS = struct(
    n="int", hub_key="string", eventhub_namespace="string", eventhub="string",
    consumer_group="string")
TARGETS = struct(
    n="int", target_key="string", target_db="string", target_schema="string",
    target_table="string", batch_size="int")
