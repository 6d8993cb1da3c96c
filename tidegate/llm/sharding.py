"""Histogram sort: find splitters by counting exact bytes below probes, then exchange once.

The sort key of a row is (hash of its text, hash of its id). Equal texts are neighbours in that
order, so they share a shard unless their group alone is too large for the tolerance; then the
group is cut by the hash of the id. Each round counts the bytes between probes inside the
intervals that still hold an unmet splitter, one narrow aggregation over all rows, and the driver
sees at most ``shards * FAN`` sums. When every splitter is met the rows are exchanged once, in
key order, and numbered inside their shard.

Defined results: a null text counts as empty, a null id is a key like any other, rows alike in id
and text have one key and stay together, an empty table gives an empty result. Other columns of
the input are not read unless ``carry`` asks for the whole row, which then is one struct column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.common import body
from tidegate.session import stored

#: Bytes of a row besides its text.
ROW_BYTES = 8
#: Keys are hashes in [0, KEYS).
KEYS = 1 << 62
#: Parts into which a round cuts an interval.
FAN = 256


@dataclass
class Search:
    """Where one splitter lies: below ``lo`` are ``below_lo`` bytes, below ``hi`` ``below_hi``.

    ``group`` is None while the interval is one of text hashes, and else the text hash whose
    rows are cut by id hash.
    """

    target: float
    lo: int
    hi: int
    below_lo: int
    below_hi: int
    group: int | None = None
    found: tuple[int, int] | None = None

    def edge(self, at: int) -> tuple[int, int]:
        if self.group is None:
            return (at, 0)
        return (self.group + 1, 0) if at == KEYS else (self.group, at)

    def settle(self, tolerance: float) -> None:
        """Take an end of the interval if it is near enough or nothing lies between."""
        low, high = self.target - self.below_lo, self.below_hi - self.target
        if min(low, high) > tolerance and self.hi - self.lo == 1 and self.group is None:
            self.group, self.lo, self.hi = self.lo, 0, KEYS
        elif min(low, high) <= tolerance or self.hi - self.lo == 1:
            self.found = self.edge(self.lo if low <= high else self.hi)


def hashed(column: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(column), 2)


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          carry: bool = False) -> DataFrame:
    """Size, checksum and sort key of every row."""
    text = body(F.col(f"`{text_col}`").cast("string"))
    id_ = F.col(f"`{id_col}`").cast("long")
    columns = [id_.alias("doc_id"),
               (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
               F.crc32(text.cast("binary")).alias("text_crc32"),
               hashed(text).alias("text_key"), hashed(id_).alias("id_key")]
    return df.select(*columns, *([F.struct("*").alias("row")] if carry else []))


def _round(keys: DataFrame, searches: list[Search]) -> None:
    """Count the bytes between probes in every open interval and narrow each search."""
    spans = sorted({(s.group is not None, s.group or 0, s.lo, s.hi) for s in searches})
    part = F.lit(None).cast("struct<span:int,cell:bigint>")
    steps = []
    for i, (inside, group, lo, hi) in enumerate(spans):
        step = -(-(hi - lo) // FAN)
        steps.append(step)
        key = F.col("id_key" if inside else "text_key")
        here = (key >= lo) & (key < hi)
        if inside:
            here = here & (F.col("text_key") == group)
        cell = F.expr(f"({'id_key' if inside else 'text_key'} - {lo}L) div {step}L")
        part = F.when(here, F.struct(F.lit(i).alias("span"), cell.alias("cell"))).otherwise(part)
    counted = (keys.select(part.alias("part"), "size").where("part is not null")
               .groupBy("part").agg(F.sum("size").alias("bytes")).collect())
    cells: dict[int, list[tuple[int, int]]] = {}
    for row in counted:
        cells.setdefault(row.part.span, []).append((row.part.cell, row.bytes))
    for search in searches:
        span = spans.index((search.group is not None, search.group or 0, search.lo, search.hi))
        lo, hi, step = search.lo, search.hi, steps[span]
        below = search.below_lo
        for cell, size in sorted(cells.get(span, [])):
            if below + size >= search.target:
                search.lo, search.hi = lo + cell * step, min(hi, lo + (cell + 1) * step)
                search.below_lo, search.below_hi = below, below + size
                break
            below += size


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """``shards - 1`` keys that cut the bytes evenly, each within ``tolerance`` of a mean shard
    or, where single keys are larger than that, at the nearest edge of a key."""
    total = keys.agg(F.sum("size").alias("bytes")).first().bytes
    if not total:
        return []
    searches = [Search(total * i / shards, 0, KEYS, 0, total) for i in range(1, shards)]
    allowed = tolerance * total / shards
    while True:
        for search in searches:
            if search.found is None:
                search.settle(allowed)
        searching = [s for s in searches if s.found is None]
        if not searching:
            return sorted(s.found for s in searches)
        _round(keys, searching)


def shard_of(cuts: list[tuple[int, int]]) -> Column:
    """How many splitters are at or below the key of the row."""
    beyond = [(F.col("text_key") > h) | ((F.col("text_key") == h) & (F.col("id_key") >= k))
              for h, k in cuts]
    return sum((c.cast("int") for c in beyond), F.lit(0)).cast("int")


def histogram_sort(df: DataFrame, shards: int = 24, tolerance: float = 0.02,
                   id_col: str = "doc_id", text_col: str = "text",
                   carry: bool = False) -> DataFrame:
    """Every row with its shard and its place in it, shards of nearly equal bytes.

    Groups of equal texts up to ``2 * tolerance`` of a shard are never cut.
    """
    keys = stored(keyed(df, id_col, text_col), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    rows = keyed(df, id_col, text_col, carry) if carry else keys
    order = ["shard", "text_key", "id_key", "doc_id"]
    placed = stored(
        rows.withColumn("shard", shard_of(cuts)).repartitionByRange(*order)
        .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
        .withColumns({"part": F.shiftright("at", 33), "at": F.expr("at & 8589934591L")}),
        "shard-rows")
    before = (Window.partitionBy("shard").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    # One row for each partition of the exchange and shard in it: partitions + shards at most.
    runs = (placed.groupBy("shard", "part").agg(F.min("at").alias("first"),
                                               F.count(F.lit(1)).alias("n"))
            .select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0))
                                      - F.col("first")).alias("shift")))
    return (placed.join(F.broadcast(runs), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("at") + F.col("shift")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), *(["row"] if carry else [])))
