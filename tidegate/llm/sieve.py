"""A set of keys in a bitmap of fixed size, for rows that need not be exchanged.

Where few rows of a large table have a partner, a join deals out all of them. The bitmap holds a bit
for every hash of a key, so a row whose bit is not set has no partner and stays where it is. Two keys
may share a bit: what passes is a superset, the join that follows is exact. The bitmap is broadcast in
pieces of 4 KB and never has more than ``SLOTS`` bits (4 MB); a set that fills it lets more rows
through, and loses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.session import stored

SLOTS = 1 << 25
_OWN = ["_slot", "_piece", "_bits", "_held"]


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS)) + 1


def split(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` as those whose ``key``, a hash, may be one of the column ``key`` of ``keys``, and those
    whose key surely is not."""
    slot = _slot(F.col("key"))
    bits = F.broadcast(stored(
        keys.groupBy(F.bitmap_bucket_number(slot).alias("_piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits")), "sieve"))
    place = F.bitmap_bit_position("_slot")
    byte = F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))
    held = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
    marked = (rows.withColumn("_slot", _slot(key))
              .withColumn("_piece", F.bitmap_bucket_number("_slot")).join(bits, "_piece", "left")
              .withColumn("_held", F.coalesce(held, F.lit(False))))
    return marked.where("_held").drop(*_OWN), marked.where("not _held").drop(*_OWN)
