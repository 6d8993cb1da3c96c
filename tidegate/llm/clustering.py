"""Centroid clustering of whole-number vectors by Lloyd rounds with geometric drift tightening.

A vector keeps an upper bound of the distance to its centroid and a lower bound of the distance to
every other. When centroids move, the upper bound grows by the drift of its own. The lower bound
need not shrink by the largest drift: the vectors of a cluster lie in a sphere about its old
centroid, and in the plane through that centre, the other centroid's old place p and its new place q
a vector x nears q by |x-p| - |x-q| <= |q-p| * cos(angle at the middle of p and q between x and the
direction of the move). The largest cosine that a point of the sphere can have bounds the loss; it is
zero for a sphere that lies wholly behind the move. Only a vector whose bounds overlap is ambiguous:
its own distance is taken exactly first, then it is scanned against all centroids.

A round is one pass over the vectors with their bounds, written to the shared folder. Sums of the
clusters change by the vectors that moved, so only those are summed again after the first round.
The driver holds centroids, sums and bounds of clusters: ``clusters`` x ``size`` numbers.

Defined results: a vector that is null, of another length, or with a null or non-finite component is
left out; a component beyond +-2^27 after scaling counts as that, so that distances fit a long; a
null id is clustered but never chosen as a first centroid (its hash is null); repeated rows are
vectors of their own, rows of equal hash are taken in the order of their components; equal distances
go to the smaller number; fewer vectors than clusters give as many clusters; an empty table gives an
empty result; an inertia beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import ship
from tidegate.session import discard, stored

ship(__name__)

#: Largest component. 2^27 keeps a squared distance of 64 components in a long.
LIMIT = 1 << 27
#: Products of floats are exact below this sum of squares.
EXACT = 1 << 53
#: Bounds are floats: they must differ by more than this share to count.
SLACK = 1e-9
STATE = ("vec_id long, cells array<int>, cluster int, before int, upper double, lower double, "
         "scanned boolean")


def scaled(df: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """vec_id and cells, floor(scale * x) of the vectors of ``size`` finite components."""
    vector = F.col(f"`{vector_col}`")
    usable = (F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                                 & (F.abs(x.cast("double")) < float("inf")))

    def cell(x: Column) -> Column:
        whole = F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-2.0 * LIMIT)),
                                F.lit(2.0 * LIMIT)))
        return F.least(F.greatest(whole, F.lit(-LIMIT)), F.lit(LIMIT)).cast("int")

    return df.where(F.coalesce(usable, F.lit(False))).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.transform(vector, cell).alias("cells"))


def first_centroids(rows: DataFrame, clusters: int, size: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in that order."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    chosen = (rows.select(key.alias("key"), "cells").where("key is not null")
              .orderBy("key", "cells").limit(clusters).collect())
    return np.array([r.cells for r in chosen], np.int64).reshape(len(chosen), size)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of vectors to centroids, exact."""
    peak = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * peak * peak * x.shape[1] < EXACT:
        x, centroids = x.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ centroids.T)
                + (centroids * centroids).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For clusters i and j: by how much the distance from a vector of i, within ``radius`` of old
    centroid i, to centroid j can have shrunk at most."""
    old, new = old.astype(float), new.astype(float)
    move = new - old
    drift = np.sqrt((move * move).sum(1))
    middle = old[:, None, :] - ((old + new) / 2)[None, :, :]        # i, j, component
    away = np.sqrt((middle * middle).sum(2))
    along = (middle * move[None, :, :]).sum(2)
    reach = radius[:, None] * (1 + SLACK)
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip(along / (away * drift[None, :]), -1, 1))
        angle = np.maximum(0, angle - np.arcsin(np.clip(reach / away, 0, 1)))
    tight = drift[None, :] * np.maximum(0, np.cos(angle))
    # Inside the sphere's reach every direction is possible.
    loss = np.where((away > reach) & (drift[None, :] > 0), tight, drift[None, :])
    np.fill_diagonal(loss, 0)
    return loss * (1 + SLACK)


def reassign(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray, upper: np.ndarray,
             lower: np.ndarray):
    """New cluster, bounds, and which vectors were scanned against all centroids."""
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    scan = np.flatnonzero(~(upper * (1 + SLACK) < lower * (1 - SLACK)))
    own = ((x[scan] - centroids[cluster[scan]]) ** 2).sum(1)
    upper[scan] = np.sqrt(own.astype(float)) * (1 + SLACK)
    scan = scan[~(upper[scan] * (1 + SLACK) < lower[scan] * (1 - SLACK))]
    scanned = np.zeros(len(x), bool)
    scanned[scan] = True
    if len(scan):
        cluster[scan], upper[scan], lower[scan] = nearest(x[scan], centroids)
    return cluster, upper, lower, scanned


def nearest(x: np.ndarray, centroids: np.ndarray):
    """Nearest centroid and bounds by a full scan."""
    all_ = distances(x, centroids)
    cluster = all_.argmin(1)
    at = np.arange(len(x))
    best = all_[at, cluster].astype(float)
    others = all_.astype(float)
    others[at, cluster] = np.inf
    return (cluster, np.sqrt(best) * (1 + SLACK), np.sqrt(others.min(1)) * (1 - SLACK))


def _matrix(cells: pa.ListArray) -> np.ndarray:
    flat = cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(cells), -1) if len(cells) else np.zeros((0, 0), np.int64)


def _pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, drift, loss = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("cells"))
            if drift is None:
                cluster, upper, lower = nearest(x, centroids)
                before, scanned = np.full(len(x), -1), np.ones(len(x), bool)
            else:
                before, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False)
                                        for c in ("cluster", "upper", "lower"))
                cluster, upper, lower, scanned = reassign(
                    x, centroids, before, upper + drift[before] * (1 + SLACK),
                    lower - loss[before])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cells"), pa.array(cluster, pa.int32()),
                 pa.array(before, pa.int32()), pa.array(upper), pa.array(lower),
                 pa.array(scanned)],
                ["vec_id", "cells", "cluster", "before", "upper", "lower", "scanned"])
    return run


def _changes(state: DataFrame, size: int) -> list:
    """Per cluster: by how much its number of vectors and its sums change."""
    sides = F.array(F.struct(F.col("cluster").alias("cluster"), F.lit(1).cast("long").alias("sign")),
                    F.struct(F.col("before").alias("cluster"), F.lit(-1).cast("long").alias("sign")))
    moved = (state.where("cluster <> before").select("cells", F.explode(sides).alias("side"))
             .select("cells", "side.cluster", "side.sign").where("cluster >= 0"))
    return moved.groupBy("cluster").agg(
        F.sum("sign").alias("n"),
        F.array(*[F.sum(F.col("cells")[i] * F.col("sign")) for i in range(size)]).alias("sums")
    ).collect()


class Clustering:
    """The result of :func:`cluster`: final centroids, the stored vectors with their cluster, and
    for each round how many vectors were scanned against all centroids."""

    def __init__(self, centroids: np.ndarray, vectors: DataFrame, scanned: list[int]):
        self.centroids, self.vectors, self.scanned = centroids, vectors, scanned


def cluster(rows: DataFrame, size: int, clusters: int, rounds: int) -> Clustering:
    """Clusters vectors of :func:`scaled`; ``rounds`` of moving centroids, then a last assignment."""
    spark = rows.sparkSession
    centroids = first_centroids(rows, clusters, size)
    k = len(centroids)
    if not k:
        empty = spark.createDataFrame([], STATE)
        return Clustering(centroids, empty, [])
    sums, counts, scanned = np.zeros((k, size), object), np.zeros(k, object), []
    state, drift, loss = rows, None, None
    for number in range(rounds + 1):
        shared = spark.sparkContext.broadcast((centroids, drift, loss))
        after = stored(state.mapInArrow(_pass(shared), STATE), f"clusters-{number}")
        if number:
            discard(state)
        state = after
        facts = state.groupBy("cluster").agg(F.max("upper").alias("radius"),
                                             F.sum(F.col("scanned").cast("long")).alias("scanned")
                                             ).collect()
        scanned.append(sum(r.scanned for r in facts))
        if number == rounds:
            break
        for row in _changes(state, size):
            counts[row.cluster] += row.n
            sums[row.cluster] += np.array(row.sums, object)
        moved = centroids.copy()
        for i in range(k):
            if counts[i]:
                moved[i] = [int(s // counts[i]) for s in sums[i]]
        radius = np.zeros(k)
        for row in facts:
            radius[row.cluster] = row.radius
        drift = np.sqrt(((moved - centroids).astype(float) ** 2).sum(1)) * (1 + SLACK)
        loss = loosening(centroids, moved, radius).max(1)
        centroids = moved
    return Clustering(centroids, state, scanned)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance (squared), inertia of the cluster and of all, and the digest of
    the centroid."""
    spark = found.vectors.sparkSession
    k = len(found.centroids)
    schema = "cluster int, centre array<long>, centroid_sha256 string"
    centres = spark.createDataFrame(
        [(i, list(map(int, c)), digest(c)) for i, c in enumerate(found.centroids)], schema)
    square = F.aggregate(F.zip_with("cells", "centre", lambda x, c: (x - c) * (x - c)),
                         F.lit(0).cast("long"), lambda s, x: s + x)
    rows = (found.vectors.join(F.broadcast(centres), "cluster")         # k rows
            .select("vec_id", "cluster", square.alias("distance"), "centroid_sha256"))
    total = rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r.cluster: int(r.s) for r in total}

    def fitting(n: int) -> int | None:
        return n if n < 1 << 63 else None

    sums = spark.createDataFrame(
        [(i, fitting(inertia.get(i, 0)), fitting(sum(inertia.values()))) for i in range(k)],
        "cluster int, cluster_inertia long, inertia long")
    return (rows.join(F.broadcast(sums), "cluster")                     # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                    "centroid_sha256"))
