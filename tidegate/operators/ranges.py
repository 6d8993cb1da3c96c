"""Which sequence numbers of a lane have landed, as few ranges instead of many rows.

A range is a lane with its ``first`` and ``last`` number, both included. Ranges of one lane are merged
where they overlap or touch, so they can be kept per batch and merged for any set of batches, in any
order. A lane may hold a third of all rows: numbers are cut into cells of ``CELL``, ranges are merged
inside a cell, and only ranges that reach an end of their cell, two for each cell at most, are chained
across cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate import schema

#: Sequence numbers in a cell.
CELL = 1 << 20


def _islands(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges of ``keys`` merged where they overlap or touch."""
    earlier = Window.partitionBy(*keys).orderBy("first", "last")
    before = F.max("last").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.coalesce(F.col("first") > before + 1, F.lit(True)), 1).otherwise(0)
    return (rows.withColumn("begins", begins)
            .withColumn("island", F.sum("begins").over(
                earlier.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*keys, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .drop("island"))


def in_cells(ranges: DataFrame, cell: int = CELL) -> DataFrame:
    """The ranges cut at the ends of cells, with the number of their ``cell``."""
    cells = F.sequence(F.floor(F.col("first") / cell), F.floor(F.col("last") / cell))
    return ranges.withColumn("cell", F.explode(cells)).withColumns({
        "first": F.greatest("first", F.col("cell") * cell),
        "last": F.least("last", (F.col("cell") + 1) * cell - 1)})


def merged(ranges: DataFrame, keys: list[str] | None = None, cell: int = CELL) -> DataFrame:
    """The keys with the fewest ranges that hold the same numbers.

    Ranges with a null number, or that end before they begin, hold nothing.
    """
    keys = schema.LANE_KEY if keys is None else keys
    whole = ranges.where("first <= last").select(*keys, "first", "last").distinct()
    inside = _islands(in_cells(whole, cell), [*keys, "cell"])
    at_edge = ((F.col("first") == F.col("cell") * cell)
               | (F.col("last") == (F.col("cell") + 1) * cell - 1))
    chained = _islands(inside.where(at_edge).drop("cell"), keys)
    return inside.where(~at_edge).drop("cell").unionByName(chained)


def landed_ranges(messages: DataFrame, keys: list[str] | None = None, cell: int = CELL) -> DataFrame:
    """The ranges of the sequence numbers of messages."""
    number = F.col("sequence_number").cast("bigint")
    return merged(messages.withColumns({"first": number, "last": number}), keys, cell)


def gaps(ranges: DataFrame, keys: list[str] | None = None, cell: int = CELL) -> DataFrame:
    """The numbers between merged ranges of a lane that none of them holds, as ranges."""
    keys = schema.LANE_KEY if keys is None else keys
    rows = ranges.withColumn("cell", F.floor(F.col("first") / cell))
    by_cell = Window.partitionBy(*keys).orderBy("cell")
    ends = (rows.groupBy(*keys, "cell").agg(F.max("last").alias("end"))
            .withColumn("carried", F.lag("end").over(by_cell)).drop("end"))
    inside = F.lag("last").over(Window.partitionBy(*keys, "cell").orderBy("first"))
    side = ends.withColumnsRenamed({c: f"_k_{c}" for c in [*keys, "cell"]})
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*keys, "cell"]]
    return (rows.withColumn("inside", inside).join(side, same)
            .select(*keys, (F.coalesce("inside", "carried") + 1).alias("from"),
                    (F.col("first") - 1).alias("to")).where("from is not null")
            .withColumnsRenamed({"from": "first", "to": "last"}))


def outside(messages: DataFrame, ranges: DataFrame, keys: list[str] | None = None,
            cell: int = CELL) -> DataFrame:
    """Messages whose number no range of their lane holds; those without a number among them.

    A message meets the ranges of its cell only, so neither side is compared as a whole.
    """
    keys = schema.LANE_KEY if keys is None else keys
    side = in_cells(ranges.select(*keys, "first", "last"), cell).withColumnsRenamed(
        {c: f"_k_{c}" for c in [*keys, "cell", "first", "last"]})
    number = F.col("sequence_number").cast("bigint")
    held = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    held += [F.floor(number / cell) == F.col("_k_cell"),
             number.between(F.col("_k_first"), F.col("_k_last"))]
    return messages.join(side, held, "left_anti")
