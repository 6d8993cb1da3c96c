"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send the functions of a module to executors as code, so they need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def trim() -> None:
    """Give memory that is free back to the machine: a worker process serves many tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that no other column of the input can clash with ours."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def body(text: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_hash(text: Column) -> Column:
    """128 bits of a text: two hashes with different seeds."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b"))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The key of every row, its id and the hash of its text, beside the row and its text."""
    text = body(F.col(f"`{text_col}`").cast("string"))
    id_ = F.col(f"`{id_col}`").cast("long")
    return df.select(id_.isNull().alias("none"), F.coalesce(id_, F.lit(0).cast("long")).alias("oid"),
                     text_hash(text).alias("h"), text.cast("binary").alias("text"),
                     F.struct("*").alias("row")).select("none", "oid", "h.a", "h.b", "text", "row")
