"""Small message frames for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidegate import schema

NS = "test-namespace.servicebus.windows.net"
START = datetime(2024, 1, 1)


def message(partition="0", sequence=0, offset=None, hub="test-hub", body=b"{}", seconds=None,
            properties=None, system=None, ns=NS):
    when = None if seconds is None else START + timedelta(seconds=seconds)
    return (ns, hub, partition, sequence, str(sequence) if offset is None else offset, when,
            body, properties, system)


def frame(spark, rows):
    return spark.createDataFrame(rows, schema.MESSAGE)


def checkpoint(partition="0", waterlevel=0, second=0, hub="test-hub", table="TEST_TABLE",
               batch=0, metadata=None, run="r"):
    return (START + timedelta(seconds=second), NS, hub, "TEST_DB", "TEST_SCHEMA", table,
            waterlevel, partition, metadata, run, batch)


def log(spark, rows):
    return spark.createDataFrame(rows, schema.CHECKPOINT_LOG)


def target(df, table="TEST_TABLE"):
    return df.withColumns({"target_db": F.lit("TEST_DB"), "target_schema": F.lit("TEST_SCHEMA"),
                           "target_table": F.lit(table)})


def mapping(spark, *hubs):
    rows = [(f"HUB_{i}->TARGET_{i}", f"HUB_{i}", f"TARGET_{i}", NS, hub, "g", "DB", "RAW",
             f"T_{hub}".replace("-", "_"), 1000) for i, hub in enumerate(hubs or ["test-hub"], 1)]
    return spark.createDataFrame(rows, "mapping_key string, hub_key string, target_key string, "
                                 "eventhub_namespace string, eventhub string, consumer_group "
                                 "string, target_db string, target_schema string, target_table "
                                 "string, batch_size int")
