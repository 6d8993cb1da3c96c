"""Row numbers over groups of any size.

``row_number`` over a hub puts the whole hub in one task. Here a group that is too large
is first cut into slots: pieces of the order range, found from counts alone. The row
number is then the rows in earlier slots plus the row number inside the slot. The cut is a
pure function of the row's own values, so a recomputed task lands in the same slot.
"""

from __future__ import annotations

from functools import reduce
from itertools import count
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.text import micros
from tidegate.session import BROADCAST_MAX_ROWS, broadcast_if_small, pinned

#: Rows one window task should hold at most, and the fewest worth a task of their own.
SLOT_ROWS = 1_000_000
MIN_SLOT_ROWS = 25_000
#: Stands for NULL when a range is cut, so that NULL sorts first here as in a window.
_NULL_RANK = -(1 << 61)


def slot_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_slot")]


def _as_long(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    if kind.startswith("timestamp"):
        value = micros(name)
    elif kind in ("byte", "short", "integer", "long"):
        value = F.col(name).cast("bigint")
    else:
        raise TypeError(f"cannot cut on {name}: {kind}")
    return F.coalesce(value, F.lit(_NULL_RANK))


def _task_rows(df: DataFrame, rows: int) -> int:
    """Rows per slot that give every core work, within the bounds above."""
    share = rows // df.sparkSession.sparkContext.defaultParallelism
    return max(MIN_SLOT_ROWS, min(SLOT_ROWS, share))


def _match(df: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Left join in which NULL keys match each other; the side's keys are dropped."""
    renamed = side.withColumnsRenamed({c: f"_k_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in on])
    return df.join(renamed, same, "left").drop(*[f"_k_{c}" for c in on])


def slotted(df: DataFrame, keys: list[str], cut_on: list[str], slot_rows: int | None = None,
            refine: list[str] | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Cut every group of ``keys`` with over ``slot_rows`` rows into ascending slots.

    Returns the frame with ``_slot*`` columns, the row counts per ``keys``, ``refine`` and
    slot, and how many such counts there are. ``cut_on`` are the leading order columns, times
    or whole numbers. Each round cuts the groups that are still too large on the first column
    that varies inside them, so bursts and even one hot instant are split. Rows equal in all
    of ``cut_on`` stay together. No column is added when no group is too large.
    """
    values = [_as_long(df, c) for c in cut_on]
    lows, highs = ([f"_{end}{i}" for i in range(len(values))] for end in ("lo", "hi"))
    varies = reduce(or_, [F.col(lo) < F.col(hi) for lo, hi in zip(lows, highs, strict=True)])
    for round_no in count():
        slots = slot_columns(df)
        stats = pinned(df.groupBy(*keys, *(refine or []), *slots).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.min(v).alias(c) for v, c in zip(values, lows, strict=True)],
            *[F.max(v).alias(c) for v, c in zip(values, highs, strict=True)]))
        groups = stats.groupBy(*keys, *slots).agg(
            F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_parts"),
            *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs])
        found = groups.agg(F.sum("_rows").alias("rows"), F.sum("_parts").alias("parts"),
                           F.max(F.when(varies, F.col("_rows"))).alias("largest")).first()
        rows = found.rows or 0
        slot_rows = slot_rows or _task_rows(df, rows)
        # A cut puts the ends of a range into different slots, so this comes to an end.
        if (found.largest or 0) <= slot_rows:
            break
        hot = groups.where((F.col("_rows") > slot_rows) & varies)
        if rows // slot_rows <= BROADCAST_MAX_ROWS:     # no more groups than this are hot
            hot = F.broadcast(hot)
        slot = F.lit(0).cast("bigint")
        for value, lo, hi in reversed(list(zip(values, lows, highs, strict=True))):
            width = F.ceil((F.col(hi) - F.col(lo) + 1) / F.ceil(2 * F.col("_rows") / slot_rows))
            cut = F.floor((value - F.col(lo)) / F.greatest(width, F.lit(1)))
            slot = F.when(F.col(lo) < F.col(hi), cut).otherwise(slot)
        df = (_match(df, hot, keys + slots)
              .withColumn(f"_slot{round_no}", F.coalesce(slot, F.lit(0)).cast("bigint"))
              .drop("_rows", "_parts", *lows, *highs))
    return df, stats.drop(*lows, *highs), found.parts or 0


def ranked(df: DataFrame, ranks: dict[str, list[str]], order: list[str], cut_on: list[str],
           slot_rows: int | None = None) -> DataFrame:
    """Add 0-based row numbers in ``order``, one per entry of ``ranks`` (name -> group keys).

    The first entry names the coarsest group; the others must refine it. All of them share
    one shuffle of the rows.
    """
    names = list(ranks)
    coarse = ranks[names[0]]
    refine = list(dict.fromkeys(k for keys in ranks.values() for k in keys if k not in coarse))
    df, counts, parts = slotted(df, coarse, cut_on, slot_rows, refine)
    slots = slot_columns(df)
    if slots:
        # Rows up to and including a slot, less the slot itself.
        through = {n: F.sum("_rows").over(Window.partitionBy(k).orderBy(slots).rangeBetween(
            Window.unboundedPreceding, Window.currentRow)) for n, k in ranks.items()}
        within = {n: F.sum("_rows").over(Window.partitionBy(k + slots)) for n, k in ranks.items()}
        before = counts.select(*coarse, *refine, *slots, *[
            (through[n] - within[n]).alias(f"_before_{n}") for n in names])
        if parts <= BROADCAST_MAX_ROWS:
            before = F.broadcast(before)
        df = _match(df, before, coarse + refine + slots)
    for name, keys in ranks.items():
        # Once the first number is there, it stands for the whole order.
        by = order if name == names[0] else [names[0]]
        inside = F.row_number().over(Window.partitionBy(keys + slots).orderBy(by)) - 1
        start = F.col(f"_before_{name}") if slots else F.lit(0)
        df = df.withColumn(name, (start + inside).cast("bigint"))
    return df.drop(*[f"_before_{n}" for n in names], *slots)


def _with_rank(df: DataFrame, name: str) -> DataFrame:
    """Add ``_rank_<name>``, whole numbers in the order of a text column; NULL stays NULL.

    Distinct values are sorted by ranges, so no task holds them all; ranks may have gaps.
    """
    rank = f"_rank_{name}"
    values = df.where(F.col(name).isNotNull()).select(name).distinct()
    ranks = pinned(values.repartitionByRange(name).sortWithinPartitions(name)
                   .withColumn(rank, F.monotonically_increasing_id()))
    return df.join(broadcast_if_small(ranks), name, "left")


def with_arrival(messages: DataFrame, keys: list[str], time: str = "enqueued_time",
                 tie: list[str] | None = None, slot_rows: int | None = None) -> DataFrame:
    """Number messages 0, 1, 2, ... per hub in order of time, then of ``tie``.

    Messages of one instant, or without a time, are cut on the ties, text included.
    """
    tie = tie or ["partition_id", "sequence_number"]
    numeric = ("byte", "short", "integer", "long", "timestamp", "timestamp_ntz")
    df, cut_on = messages, [time]
    for name in tie:
        if messages.schema[name].dataType.typeName() in numeric:
            cut_on.append(name)
        else:
            df = _with_rank(df, name)
            cut_on.append(f"_rank_{name}")
    out = ranked(df, {"arrival": keys}, [time] + tie, cut_on, slot_rows)
    return out.select(*messages.columns, "arrival")
