"""A stored hub as a partitioned stream: positions per partition, start positions, limits.

:func:`store_hub` appends messages in segments of consecutive sequence numbers and then one small
index file, which makes the append visible as a whole. :func:`stored_hub` streams them back: a
position is the next sequence number of a hub partition, a task reads one stretch of one partition
in order, and a trigger takes at most so many numbers.

A partition is a log: an append holds numbers above all that are stored. One that does not is
refused when the stream sees it, since the stream may have passed those numbers already.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidegate.schema import LANE_KEY, MESSAGE

# The reader travels with its code: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sequence numbers of one partition in a file, and in a task.
SEGMENT = 500_000
#: Messages in a row group: what a stretch reads besides its own. A trigger takes a small stretch of a long
#: segment, and without this bound each of them would read the whole segment again.
GROUP_ROWS = 5_000
LATEST, EARLIEST = -1, -2
_SEPARATOR = "/"


def store_hub(messages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Append messages to a stored hub; all of them appear at once, when the index is there.

    A message without hub, partition or sequence number has no place in a hub and is an error.
    """
    append = uuid.uuid4().hex
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c))
                                 for c in [*LANE_KEY, "sequence_number"]])
    placed = messages.select(*MESSAGE.names).withColumns({
        "segment": F.when(missing != "", F.raise_error(F.concat(F.lit("message without "), missing)))
        .otherwise(F.floor(F.col("sequence_number") / segment)).cast("bigint"),
        "lane": F.md5(F.to_json(F.struct(*LANE_KEY)))})      # names need no escapes then
    folders = ["lane", "segment"]
    (placed.repartition(*folders).sortWithinPartitions(*folders, "sequence_number")
     .write.option("parquet.block.row.count.limit", GROUP_ROWS)
     .partitionBy(*folders).parquet(f"{path}/data/{append}"))
    written = messages.sparkSession.read.schema(placed.schema).parquet(f"{path}/data/{append}")
    (written.groupBy(*LANE_KEY, *folders)
     .agg(F.min("sequence_number").alias("first"), F.max("sequence_number").alias("last"),
          F.count(F.lit(1)).alias("messages"))
     .withColumn("append", F.lit(append)).coalesce(1).write.parquet(f"{path}/index/{append}"))


def stored_hub(spark: SparkSession, path: str, starting_offsets: str = "earliest",
               max_messages_per_trigger: int | None = None, positions: str | None = None,
               max_messages_per_task: int = SEGMENT) -> DataFrame:
    """Stream a stored hub as messages.

    ``starting_offsets`` is ``earliest``, ``latest`` or the text of ``hub.starting_offsets``; a
    partition that it does not name is read from its first message. It counts for a new query
    only. A limit counts sequence numbers and is shared out so that short backlogs are served
    first; it needs a folder ``positions`` of the query's own, from which a restarted query learns
    where it stood.
    """
    if max_messages_per_trigger is not None and not (positions and max_messages_per_trigger > 0):
        raise ValueError("a limit must be positive and needs a folder for positions")
    spark.dataSource.register(StoredHub)
    reader = (spark.readStream.format(StoredHub.name()).option("root", path)
              .option("start", starting_offsets).option("task", max_messages_per_task))
    if positions:
        reader = reader.option("positions", positions)
    if max_messages_per_trigger is not None:
        reader = reader.option("limit", max_messages_per_trigger)
    return reader.load()


def shares(backlogs: dict[str, int], limit: int) -> dict[str, int]:
    """How many of ``limit`` each partition gets: all get alike, but none more than it has."""
    left, given = limit, {}
    waiting = sorted((n, lane) for lane, n in backlogs.items() if n > 0)
    for place, (n, lane) in enumerate(waiting):
        given[lane] = min(n, left // (len(waiting) - place))
        left -= given[lane]
    for n, lane in reversed(waiting):       # what does not go round goes to the longest
        if left and given[lane] < n:
            given[lane] += 1
            left -= 1
    return given


def lane_of(namespace: str, hub: str, partition: str) -> str:
    return _SEPARATOR.join(quote(part, safe="") for part in (namespace, hub, partition))


class Stretch(InputPartition):
    """Numbers ``low`` to below ``high`` of one partition, and the folders that hold them."""

    def __init__(self, lane: tuple[str, str, str], low: int, high: int, folders: list[str]):
        super().__init__((lane, low, high))
        self.lane, self.low, self.high, self.folders = lane, low, high, folders


class StoredHub(DataSource):
    """Data source ``tidegate_hub``."""

    @classmethod
    def name(cls) -> str:
        return "tidegate_hub"

    def schema(self):
        return MESSAGE

    def streamReader(self, schema) -> StoredHubReader:
        return StoredHubReader(dict(self.options))


class StoredHubReader(DataSourceStreamReader):
    """Offsets are the next sequence number of each partition."""

    def __init__(self, options: dict[str, str]):
        self.root, self.start = options["root"], options.get("start", "earliest")
        self.limit = int(options["limit"]) if options.get("limit") else None
        self.task, self.positions = int(options.get("task", SEGMENT)), options.get("positions")
        self.seen: set[str] = set()
        #: Lane -> (names, [(first, last, folder), ...] in order).
        self.lanes: dict[str, tuple[tuple[str, str, str], list[tuple[int, int, str]]]] = {}
        #: Where the query began, and the end of its last batch.
        self.begin: dict[str, int] | None = None
        self.at: dict[str, int] | None = None

    # --- what is stored ---------------------------------------------------------------------

    def _refresh(self) -> None:
        """Read the index files of appends that were not there before."""
        fs, root = pafs.FileSystem.from_uri(self.root)
        found = fs.get_file_info(pafs.FileSelector(f"{root}/index", allow_not_found=True))
        for append in found:
            if append.base_name in self.seen or append.type != pafs.FileType.Directory:
                continue
            parts = [f.path for f in fs.get_file_info(pafs.FileSelector(append.path))
                     if f.base_name.startswith("part-")]
            if not any(f.base_name == "_SUCCESS"
                       for f in fs.get_file_info(pafs.FileSelector(append.path))):
                continue
            for part in parts:
                self._add(pq.read_table(part, filesystem=fs).to_pylist())
            self.seen.add(append.base_name)

    def _add(self, rows: list[dict]) -> None:
        for row in sorted(rows, key=lambda r: r["first"]):
            names = (row["eventhub_namespace"], row["eventhub"], row["partition_id"])
            _, pieces = self.lanes.setdefault(lane_of(*names), (names, []))
            folder = f"data/{row['append']}/lane={row['lane']}/segment={row['segment']}"
            pieces.append((row["first"], row["last"], folder))
            pieces.sort()

    def _ends(self) -> dict[str, int]:
        return {lane: max(last for _, last, _ in pieces) + 1
                for lane, (_, pieces) in self.lanes.items()}

    def _first(self, lane: str) -> int:
        return self.lanes[lane][1][0][0]

    # --- offsets ----------------------------------------------------------------------------

    def _begin(self) -> dict[str, int]:
        """Where a new query starts. Spark asks for the latest offset first, so whichever is asked
        for first decides; with a folder for positions that holds for a restart, too."""
        if self.begin is None:
            self.begin = self._read("begin")
        if self.begin is None:
            ends = self._ends()
            named = json.loads(self.start) if self.start not in ("earliest", "latest") else {}
            other = LATEST if self.start == "latest" else EARLIEST
            self.begin = {}
            for lane, (names, _) in self.lanes.items():
                at = int(named.get(names[1], {}).get(names[2], other))
                self.begin[lane] = (ends[lane] if at == LATEST
                                    else self._first(lane) if at == EARLIEST else at)
            self._write("begin", self.begin)
        return self.begin

    def initialOffset(self) -> dict:
        self._refresh()
        return self._begin()

    def latestOffset(self) -> dict:
        self._refresh()
        if self.at is None:
            self.at = self._read("reached") or self._begin()
        at = {lane: self.at.get(lane, self._first(lane)) for lane in self.lanes}
        backlogs = {lane: max(0, end - at[lane]) for lane, end in self._ends().items()}
        given = backlogs if self.limit is None else shares(backlogs, self.limit)
        return {lane: at[lane] + given.get(lane, 0) for lane in at}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self._refresh()
        # The end of a batch is kept before it runs, and a batch that is run again comes here
        # again: what a restarted query reads is never behind it.
        self.at = dict(end)
        self._write("reached", end)
        planned = []
        for lane, high in end.items():
            if lane not in self.lanes:
                raise ValueError(f"the stored hub no longer holds {lane}")
            names, pieces = self.lanes[lane]
            low = start.get(lane, self._first(lane))
            if low < high and low < self._first(lane):
                raise ValueError(f"messages {low} to {self._first(lane) - 1} of {lane} are gone")
            before = -1
            for first, last, folder in pieces:
                if first <= before:
                    raise ValueError(f"{folder} holds numbers below {before + 1}, as others do")
                before = last
            for at in range(low, high, self.task):
                to = min(high, at + self.task)
                folders = [f for first, last, f in pieces if first < to and last >= at]
                if folders:
                    planned.append(Stretch(names, at, to, folders))
        # Spark wants a task even for a stretch of numbers that nobody holds.
        return planned or [Stretch(("", "", ""), 0, 0, [])]

    def commit(self, end: dict) -> None:
        pass

    def _write(self, name: str, at: dict[str, int]) -> None:
        if not self.positions:
            return
        fs, folder = pafs.FileSystem.from_uri(self.positions)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{name}.next") as out:
            out.write(json.dumps(at).encode())
        fs.move(f"{folder}/{name}.next", f"{folder}/{name}.json")

    def _read(self, name: str) -> dict[str, int] | None:
        if not self.positions:
            return None
        fs, folder = pafs.FileSystem.from_uri(self.positions)
        if fs.get_file_info(f"{folder}/{name}.json").type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(f"{folder}/{name}.json") as kept:
            return json.loads(kept.read())

    # --- rows -------------------------------------------------------------------------------

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        """The messages of a stretch in order, a batch at a time; other row groups are skipped."""
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, root = pafs.FileSystem.from_uri(self.root)
        kinds = to_arrow_schema(MESSAGE)
        number = ds.field("sequence_number")
        for folder in partition.folders:
            files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(f"{root}/{folder}"))
                           if f.base_name.startswith("part-"))
            rows = ds.dataset(files, filesystem=fs, format="parquet").scanner(
                columns=MESSAGE.names, batch_size=10_000, batch_readahead=2, fragment_readahead=1,
                filter=(number >= partition.low) & (number < partition.high))
            for batch in rows.to_batches():
                if batch.num_rows:
                    yield from pa.Table.from_batches([batch]).cast(kinds).to_batches()
