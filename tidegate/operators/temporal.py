"""Joins by time: the state in force when something happened, and the spans that contain it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.text import micros
from tidegate.operators.ranking import slot_columns, slotted

#: Width of a bucket of time in which points and spans meet.
BUCKET_SECONDS = 3600


def as_of(rows: DataFrame, states: DataFrame, keys: list[str], time: str, state_time: str,
          slot_rows: int | None = None) -> DataFrame:
    """Every row with the struct ``state``: of the states with its keys the newest that is not
    younger, null if there is none. Of states of one instant the greatest holds.

    Both sides are united and put in order of time. A group that is too large for a task is cut into
    slots of time; the newest state of the slots before is carried into each by a window over one row
    for each slot. A row without a time has no state; a state without a time never holds.
    """
    state = F.struct(*[F.col(f"`{c}`") for c in states.columns if c not in keys])
    known = (states.where(F.col(state_time).isNotNull())
             .select(*keys, F.col(state_time).alias("_at"), state.alias("_state"))
             .groupBy(*keys, "_at").agg(F.max("_state").alias("_state"))
             .withColumn("_row", F.lit(None).cast(rows.select(F.struct("*")).schema[0].dataType)))
    asked = rows.select(*keys, F.col(time).alias("_at"),
                        F.lit(None).cast(known.schema["_state"].dataType).alias("_state"),
                        F.struct("*").alias("_row"))
    both, _, _ = slotted(known.unionByName(asked), keys, ["_at"], slot_rows)
    slots = slot_columns(both)
    # A state comes before the rows of its own instant.
    in_order = Window.partitionBy(*keys, *slots).orderBy("_at", F.col("_row").isNotNull())
    newest = F.last("_state", True)
    found = newest.over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    if slots:
        ends = both.groupBy(*keys, *slots).agg(F.max_by(
            "_state", F.when(F.col("_state").isNotNull(), F.col("_at"))).alias("_end"))
        before = Window.partitionBy(*keys).orderBy(*slots).rowsBetween(
            Window.unboundedPreceding, -1)
        carried = ends.select(*[F.col(c).alias(f"_k_{c}") for c in [*keys, *slots]],
                               F.last("_end", True).over(before).alias("_carried"))
        same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*keys, *slots]]
        both = both.join(carried, same, "left")
        found = F.coalesce(found, F.col("_carried"))
    return (both.withColumn("_found", F.when(F.col("_at").isNotNull(), found))
            .where("_row is not null").select("_row.*", F.col("_found").alias("state")))


def within(points: DataFrame, spans: DataFrame, keys: list[str], time: str, start: str, end: str,
           bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every point joined with the spans of its keys that contain it, both ends included.

    A span is cut into the buckets of time that it touches and a point lies in one, so they meet by an
    equality; the exact comparison follows. Columns of both sides must differ but for ``keys``.
    """
    width = bucket_seconds * 1_000_000
    cut = spans.where(F.col(start) <= F.col(end)).withColumn("_bucket", F.explode(F.sequence(
        F.floor(micros(start) / width), F.floor(micros(end) / width))))
    placed = points.withColumn("_bucket", F.floor(micros(time) / width))
    return (placed.join(cut, [*keys, "_bucket"])
            .where(F.col(time).between(F.col(start), F.col(end))).drop("_bucket"))
