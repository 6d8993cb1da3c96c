"""Group messages into size-or-age batches.

A batch takes messages in order of arrival and closes with the message that fills it, or
with the first one that arrives when the batch is ``max_wait_seconds`` old. The next batch
is created at that moment. Batch ids count up from 0 per hub.

By size alone the id is ``arrival div max_size``. With an age bound each boundary depends on
the one before it. The chain is still worked out in parallel: a hub is cut into chunks of
consecutive messages, every chunk is summed up by where each possible first boundary inside
it leads, and those summaries are composed like a running total.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.text import micros
from tidegate.operators.ranking import with_arrival
from tidegate.session import pinned, small_side, stored

# Task functions travel with their code: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_SIZE = 1000
MAX_WAIT_SECONDS = 300
NO_WAIT = 1 << 60
#: Messages that a Python task holds; a busier hub gives more tasks, not larger ones.
CHUNK_ROWS = 200_000
#: Chunk summaries composed by one task.
FAN_IN = 256


def batches_by_size(messages: DataFrame, max_size: int | str = MAX_SIZE) -> DataFrame:
    """Add ``batch_id`` to messages that carry ``arrival``. No shuffle.

    ``max_size`` is a number or the column that holds it, so each target can have its own.
    """
    size = F.col(max_size) if isinstance(max_size, str) else F.lit(max_size)
    return messages.withColumn("batch_id", F.floor(F.col("arrival") / size).cast("bigint"))


def assign_batches(messages: DataFrame, max_size: int = MAX_SIZE,
                   max_wait_seconds: float | None = MAX_WAIT_SECONDS,
                   keys: list[str] | None = None, time: str = "enqueued_time",
                   tie: list[str] | None = None, slot_rows: int | None = None,
                   chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN,
                   opening: DataFrame | None = None) -> DataFrame:
    """Add ``arrival`` (if missing) and ``batch_id`` per hub.

    Arrival must follow ``time``; where it does not, this raises. ``max_wait_seconds=None`` leaves out the age bound.
    ``opening`` holds batches that earlier messages left open: the keys, ``batch_id``, the
    messages ``held`` and the time of creation ``created`` in microseconds.
    """
    keys = keys or ["eventhub"]
    if "arrival" not in messages.columns:
        messages = with_arrival(messages, keys, time, tie, slot_rows)
    if max_wait_seconds is None and opening is None:
        return batches_by_size(messages, max_size)
    max_wait = NO_WAIT if max_wait_seconds is None else int(max_wait_seconds * 1_000_000)
    chunk_rows = max(chunk_rows, max_size + 1)
    marks = batch_marks(messages.select(*keys, "arrival", micros(time).alias("_t")), keys,
                        max_size, max_wait, chunk_rows, fan_in, opening)
    return _spread(messages, marks, keys, chunk_rows)


def _spread(messages: DataFrame, marks: DataFrame, keys: list[str],
            chunk_rows: int) -> DataFrame:
    """Carry the batch id from each mark to the messages that follow it in its chunk."""
    chunk = F.floor(F.col("arrival") / chunk_rows)
    both = messages.withColumn("_mark", F.lit(None).cast("bigint")).unionByName(
        marks.withColumnRenamed("batch_id", "_mark"), allowMissingColumns=True)
    both = both.withColumn("_is_mark", F.col("_mark").isNotNull()).withColumn("_chunk", chunk)
    following = (Window.partitionBy(*keys, "_chunk")
                 .orderBy("arrival", F.col("_is_mark").desc())
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (both.withColumn("batch_id", F.last("_mark", ignorenulls=True).over(following))
            .where(~F.col("_is_mark")).drop("_mark", "_is_mark", "_chunk"))


# --- boundaries ----------------------------------------------------------------------------
# A batch that starts at message s was created when message s-1 arrived, so s alone decides
# where it ends. Let next(s) be the start that follows. next(s) <= s + max_size, so the first
# start inside a chunk has an offset of max_size at most: a chunk is a function from that entry
# offset to the entry offset of the following chunk and the number of batches between.


def _next_starts(arrival: np.ndarray, t: np.ndarray, lo: int, hi: int, max_size: int,
                 max_wait: int) -> np.ndarray:
    """``next(s)`` for starts ``lo <= s < hi``, given times from ``lo-1`` (or 0) onwards."""
    base = int(arrival[0])
    starts = np.arange(lo, hi, dtype=np.int64)
    created = t[np.maximum(starts - 1, 0) - base]
    aged = base + np.searchsorted(t, created + max_wait, side="left")
    closing = np.minimum(starts + max_size - 1, np.maximum(aged, starts))
    return np.minimum(closing, int(arrival[-1])) + 1


def _chunk_summary(keys: list[str], max_size: int, max_wait: int, chunk_rows: int):
    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("arrival")
        chunk = int(rows["_chunk"].iloc[0])
        arrival, t = rows["arrival"].to_numpy(), rows["_t"].to_numpy()
        if (np.diff(t) < 0).any():
            raise ValueError("times fall while arrival rises: batches by age need them in order")
        lo = chunk * chunk_rows
        hi = min(lo + chunk_rows, int(arrival[-1]) + 1)
        if hi <= lo:
            return pd.DataFrame()
        # Follow every start out of the chunk at once, doubling the jump length each time.
        target = _next_starts(arrival, t, lo, hi, max_size, max_wait) - lo
        size = hi - lo
        made = np.ones(size, dtype=np.int64)
        while True:
            inside = np.flatnonzero(target < size)
            if not inside.size:
                break
            via = target[inside]
            made[inside] += made[via]
            target[inside] = target[via]
        entries = min(max_size + 1, size)
        return pd.DataFrame([{
            **{k: rows[k].iloc[0] for k in keys}, "_node": chunk,
            "_exit": target[:entries] - chunk_rows, "_made": made[:entries]}])
    return summarise


def _compose(keys: list[str], fan_in: int):
    def compose(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("_node")
        at = np.arange(len(parts["_exit"].iloc[0]))
        made = np.zeros(len(at), dtype=np.int64)
        for exits, counts in zip(parts["_exit"], parts["_made"], strict=True):
            alive = at < len(exits)
            made[alive] += counts[at[alive]]
            at = np.where(alive, exits[np.where(alive, at, 0)], at)
        return pd.DataFrame([{**{k: parts[k].iloc[0] for k in keys},
                              "_node": int(parts["_node"].iloc[0]) // fan_in,
                              "_exit": at, "_made": made}])
    return compose


def _descend(keys: list[str]):
    def descend(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("_node")
        at, batch = int(parts["_at"].iloc[0]), int(parts["_batch"].iloc[0])
        rows = []
        for node, exits, counts in zip(parts["_node"], parts["_exit"], parts["_made"],
                                       strict=True):
            rows.append((node, at, batch))
            if at < len(exits):
                batch += int(counts[at])
                at = int(exits[at])
        found = pd.DataFrame(rows, columns=["_node", "_at", "_batch"])
        for k in keys:
            found[k] = parts[k].iloc[0]
        return found
    return descend


def _chunk_marks(keys: list[str], max_size: int, max_wait: int, chunk_rows: int):
    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("arrival")
        chunk = int(rows["_chunk"].iloc[0])
        arrival, t = rows["arrival"].to_numpy(), rows["_t"].to_numpy()
        if (np.diff(t) < 0).any():
            raise ValueError("times fall while arrival rises: batches by age need them in order")
        lo = chunk * chunk_rows
        hi = min(lo + chunk_rows, int(arrival[-1]) + 1)
        if hi <= lo:
            return pd.DataFrame()
        target = _next_starts(arrival, t, lo, hi, max_size, max_wait)
        at, batch = lo + int(rows["_at"].iloc[0]), int(rows["_batch"].iloc[0])
        starts = []
        while at < hi:
            starts.append(at)
            at = int(target[at - lo])
        ids = list(range(batch, batch + len(starts)))
        if not starts or starts[0] > lo:    # the batch left open by the chunk before
            starts.insert(0, lo)
            ids.insert(0, batch - 1)
        found = pd.DataFrame({"arrival": starts, "batch_id": ids})
        for k in keys:
            found[k] = rows[k].iloc[0]
        return found
    return mark


def batch_marks(arrivals: DataFrame, keys: list[str], max_size: int, max_wait: int,
                chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN,
                opening: DataFrame | None = None) -> DataFrame:
    """The first message of every batch, and the batch open at the start of every chunk.

    ``arrivals`` holds the keys, ``arrival`` and the time ``_t`` in microseconds. Tasks hold
    one chunk plus the ``max_size`` messages after it, or ``fan_in`` summaries.
    """
    key_ddl = ", ".join(f"`{k}` {arrivals.schema[k].dataType.simpleString()}" for k in keys)
    place = F.col("arrival") % chunk_rows
    chunk = F.floor(F.col("arrival") / chunk_rows)
    chunks = F.array_compact(F.array(
        chunk,
        F.when((place < max_size) & (chunk > 0), chunk - 1),
        F.when(place == chunk_rows - 1, chunk + 1)))
    pieces = stored(arrivals.withColumn("_chunk", F.explode(chunks)), "chunks")

    summary = f"{key_ddl}, _node bigint, _exit array<bigint>, _made array<bigint>"
    levels = [pinned(pieces.groupBy(*keys, "_chunk").applyInPandas(
        _chunk_summary(keys, max_size, max_wait, chunk_rows), summary))]
    parent = F.floor(F.col("_node") / fan_in).alias("_parent")
    while levels[-1].where(F.col("_node") > 0).count() > 0:
        levels.append(pinned(levels[-1].groupBy(*keys, parent).applyInPandas(
            _compose(keys, fan_in), summary)))

    zero = F.lit(0).cast("bigint")
    entry = levels.pop().select(*keys, "_node")
    if opening is None:
        entry = entry.withColumns({"_at": zero, "_batch": zero})
    else:
        first = _first_starts(arrivals, keys, max_size, max_wait, opening)
        entry = (entry.join(first, keys, "left")
                 .withColumns({c: F.coalesce(c, zero) for c in ("_at", "_batch")}))
    while levels:
        inner = levels.pop().withColumn("_parent", parent)
        outer = entry.withColumnRenamed("_node", "_parent")
        entry = pinned(inner.join(outer, [*keys, "_parent"]).groupBy(*keys, "_parent")
                       .applyInPandas(_descend(keys),
                                      f"_node bigint, _at bigint, _batch bigint, {key_ddl}"))
    return (pieces.join(entry.withColumnRenamed("_node", "_chunk"), [*keys, "_chunk"])
            .groupBy(*keys, "_chunk").applyInPandas(
                _chunk_marks(keys, max_size, max_wait, chunk_rows),
                f"arrival bigint, batch_id bigint, {key_ddl}"))


def _first_starts(arrivals: DataFrame, keys: list[str], max_size: int, max_wait: int,
                  opening: DataFrame) -> DataFrame:
    """Where the first new batch starts after the one left open, and its id."""
    opening = small_side(opening.select(*keys, "batch_id", "held", "created"))
    aged = (arrivals.join(opening, keys)
            .where(F.col("_t") >= F.col("created") + max_wait)
            .groupBy(*keys).agg(F.min("arrival").alias("_aged")))
    return (opening.join(aged, keys, "left")
            .select(*keys, F.least(max_size - F.col("held"), F.col("_aged") + 1)
                    .cast("bigint").alias("_at"),
                    (F.col("batch_id") + 1).alias("_batch")))


def open_batches(batched: DataFrame, max_size: int, max_wait_seconds: float | None,
                 keys: list[str] | None = None, time: str = "enqueued_time",
                 opening: DataFrame | None = None) -> DataFrame:
    """The batches that ``batched`` leaves open, in the form ``assign_batches`` takes."""
    keys = keys or ["eventhub"]
    max_wait = NO_WAIT if max_wait_seconds is None else int(max_wait_seconds * 1_000_000)
    sizes = batched.groupBy(*keys, "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(micros(time)).alias("first_t"),
        F.max(micros(time)).alias("last_t"))
    # The newest batch was created when the one before it closed.
    newest = sizes.groupBy(*keys).agg(F.max("batch_id").alias("newest"))
    ends = sizes.join(small_side(newest), keys).where(F.col("batch_id") >= F.col("newest") - 1)
    is_newest = F.col("batch_id") == F.col("newest")
    state = ends.groupBy(*keys).agg(
        F.max("newest").alias("batch_id"), F.max(F.when(is_newest, F.col("n"))).alias("held"),
        F.max(F.when(is_newest, F.col("last_t"))).alias("last_t"),
        F.coalesce(F.max(F.when(~is_newest, F.col("last_t"))),
                   F.min("first_t")).alias("created"))
    if opening is not None:
        before = opening.select(*keys, F.col("batch_id").alias("_b"), F.col("held").alias("_h"),
                                F.col("created").alias("_c"))
        same = F.col("_b") == F.coalesce("batch_id", "_b")
        state = state.join(before, keys, "full").select(
            *keys, F.coalesce("batch_id", "_b").alias("batch_id"),
            (F.coalesce("held", F.lit(0)) + F.when(same, F.col("_h")).otherwise(0))
            .alias("held"), F.coalesce("last_t", "_c").alias("last_t"),
            F.when(same, F.col("_c")).otherwise(F.col("created")).alias("created"))
    closed = ((F.col("held") >= max_size)
              | ((F.col("held") > 0) & (F.col("last_t") - F.col("created") >= max_wait)))
    return state.select(
        *keys, F.when(closed, F.col("batch_id") + 1).otherwise(F.col("batch_id")).alias("batch_id"),
        F.when(closed, F.lit(0)).otherwise(F.col("held")).cast("bigint").alias("held"),
        F.when(closed, F.col("last_t")).otherwise(F.col("created")).alias("created"))


# --- summaries -----------------------------------------------------------------------------


def batch_summary(batched: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Size, span and partitions of every batch."""
    keys = keys or ["eventhub"]
    return batched.groupBy(*keys, "batch_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.array_sort(F.collect_set("partition_id")).alias("partitions"),
        F.min("arrival").alias("first_arrival"),
        F.max("arrival").alias("last_arrival"),
        F.min("enqueued_time").alias("first_enqueued"),
        F.max("enqueued_time").alias("last_enqueued"))


def last_arrived_sequence(batched: DataFrame, keys: list[str] | None = None,
                          arrival: str = "arrival") -> DataFrame:
    """Sequence number of the message that arrived last on each partition of a batch.

    On input that is out of order this is not the highest one.
    """
    keys = keys or ["eventhub", "batch_id"]
    return batched.groupBy(*keys, "partition_id").agg(
        F.max_by("sequence_number", arrival).alias("last_sequence"))
