"""Session settings and the few places where Spark state leaves the plan."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Largest side that is ever hinted as broadcast, in rows and in bytes.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session that names none gets a temporary folder. A cluster must name one.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    if not path:
        path = context.getCheckpointDir()
        if path:
            path = os.path.dirname(path.rstrip("/"))
    if not path:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="tidegate-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call has used."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _GIVEN.append(path)
    if getattr(_SCOPE, "paths", None) is not None:
        _SCOPE.paths.append(path)
    return path


def pinned(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and store it reliably, so later jobs do not repeat its lineage.

    In a :func:`scratch` block it is a table that goes with the block.
    """
    if getattr(_SCOPE, "paths", None) is not None:
        return stored(df, "pinned")
    return _checkpointed(df)


def _checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: The folders given out in the current :func:`scratch` block of a thread.
_SCOPE = threading.local()
#: Folders that :func:`fresh_dir` has given out and :func:`release` has not deleted.
_GIVEN: list[str] = []
#: Small frames without an input file that were pinned, by application and plan.
_PINNED: dict[tuple[str, int], list[tuple[DataFrame, DataFrame]]] = {}


#: Where the frames of :func:`stored` lie.
_STORED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    if path in _GIVEN:
        _GIVEN.remove(path)


def release(spark: SparkSession) -> None:
    """Delete all that was stored so far. Frames that read it can no longer be computed."""
    while _GIVEN:
        delete_folder(spark, _GIVEN[-1])
    _PINNED.clear()


def discard(*frames: DataFrame) -> None:
    """Delete what :func:`stored` wrote for these frames, once nothing reads them any more."""
    for df in frames:
        path = _STORED.pop(df, None)
        if path:
            delete_folder(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Delete what was stored inside the block when it ends, but for folders whose names begin
    with one of ``kept``. What others stored meanwhile in other threads is not touched."""
    mine, outer = [], getattr(_SCOPE, "paths", None)
    _SCOPE.paths = mine
    try:
        yield
    finally:
        _SCOPE.paths = outer
        for path in mine:
            if path.rsplit("/", 1)[-1].startswith(kept or ("//",)):
                if outer is not None:
                    outer.append(path)
            elif path in _GIVEN:
                delete_folder(spark, path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of a query of this session as soon as it ends.

    Otherwise they stay until the driver happens to collect its garbage, and the disk holds those of
    many queries. For blocks that compute each frame once: another run of it shuffles again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame of any size to the shared folder and read it back, column by column.

    It stays there until :func:`release`, as the frame returned may be computed at any time.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _STORED[back] = path
    return back


def broadcast_if_small(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a stored join side as broadcast only when it is measured to be small.

    Beyond the bounds it is returned without a hint: the join then shuffles, and adaptive
    skew handling splits a hot key.
    """
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
                 for c in side.columns), F.lit(0))
    size = side.agg(F.count(F.lit(1)).alias("n"),
                      F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    if size.n <= max_rows and size.b <= max_bytes:
        return F.broadcast(side)
    return side


def small_side(df: DataFrame) -> DataFrame:
    """Compute a join side once, then broadcast it if it turns out small.

    A side that reads no file, such as a mapping given as rows, is computed once per session.
    """
    if df.isStreaming or df.inputFiles():
        return broadcast_if_small(pinned(df))
    known = _PINNED.setdefault((df.sparkSession.sparkContext.applicationId, df.semanticHash()), [])
    for plan, side in known:
        if plan.columns == df.columns and plan.sameSemantics(df):
            return side
    side = broadcast_if_small(_checkpointed(df))     # kept beyond any block
    known.append((df, side))
    return side
