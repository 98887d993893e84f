"""Centroid clustering of whole-number vectors: Lloyd rounds with geometrically tightened bounds.

Every vector carries its cluster, an upper bound of the distance to its centroid and a lower bound
of the distance to all others. When centroids move, the upper bound grows by its own centroid's
drift. The lower one need not shrink by the largest drift: all vectors of a cluster lie in a sphere
around its old centroid, and a centroid that moves from ``a`` to ``b`` comes closer to any point of the
sphere by ``|x - a| - |x - b|`` at most. Points where that is ``t`` or more lie inside a branch of a
hyperbola with foci ``a`` and ``b``, hence inside the cone of its asymptotes, whose half angle has the
cosine ``t / |b - a|``. In the plane through ``a``, ``b`` and the sphere's centre, the smallest angle phi at which
the sphere is seen from the middle of ``a`` and ``b`` so bounds the approach by ``|b - a| * cos(phi)``. Vectors
whose bounds (or half the distance to the nearest other centroid) leave no doubt stay; for the
others the own distance is computed, and if there still is doubt, all of them, exactly.

Distances and sums are whole numbers, ties go to the smaller cluster, and centroids are the exact
floor of the mean. Each round is a written table; the one before is deleted. Sums follow from the
vectors that changed cluster, added up in tasks: one row a task and cluster is shuffled.

Cases: vectors that are null, of another length than ``dims``, or hold null or non-finite
components are left out, as are those with a component so large that a distance would not fit in a
long (``limit``; 524,288 for 64 components); rows that repeat are vectors each; a row without
``vec_id`` is never a first centroid; with fewer vectors than ``k`` there are fewer centroids, with no
centroid the results are null; an empty table gives an empty result; other columns play no part.
"""

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.integer_vectors import EXACT, as_matrix, exact_products, integer_rows
from shelfwise.session import delete_path, materialize, scratch_path

KIND = "<i4"
MARGIN = 1e-9  # of the numbers compared; far above what rounding can do
STATE = "vec_id long, x binary, cluster int, before int, upper double, lower double"


def limit(dims: int) -> int:
    """Components below it have squared distances below 2**62."""
    return min(math.isqrt(2 ** 62 // dims) // 2, 2 ** 30)


def squared_distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances from all rows to all centres."""
    largest = max(np.abs(rows).max(initial=0), np.abs(centres).max(initial=0))
    if 4.0 * rows.shape[1] * float(largest) ** 2 < EXACT:
        a, b = rows.astype(np.float64), centres.astype(np.float64)
        out = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
        return out.astype(np.int64)
    return np.stack([((rows - centre) ** 2).sum(1) for centre in centres], 1)


def approach(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, by how much another centroid can have come closer to a vector in its
    sphere: the largest of the planar bounds over the other centroids."""
    a, b = old.astype(np.float64), new.astype(np.float64)
    drift = np.sqrt(((b - a) ** 2).sum(1))
    ahead = (b - a) / np.where(drift > 0, drift, 1)[:, None]
    out = np.zeros(len(a))
    for i, size in enumerate(radius):
        offset = a[i] - (a + b) / 2  # of the sphere, seen from the middle of each move
        away = np.sqrt((offset ** 2).sum(1))
        seen = away > size
        safe = np.where(seen, away, 1)
        cosine = np.clip((offset * ahead).sum(1) / safe, -1, 1)
        angle = np.arccos(cosine) - np.arcsin(np.where(seen, size / safe, 1))
        share = np.where(seen & (angle > 0), np.maximum(np.cos(np.maximum(angle, 0)), 0), 1)
        bound = drift * np.minimum(share + MARGIN, 1)
        bound[i] = 0
        out[i] = bound.max()
    return out


class Move:
    """The centroids of a round, and what their last move did to the bounds."""

    def __init__(self, centres, old=None, radius=None):
        self.centres = centres
        apart = np.sqrt(squared_distances(centres, centres).astype(np.float64))
        np.fill_diagonal(apart, np.inf)
        self.half = apart.min(1) / 2
        self.first = old is None
        if old is not None:
            self.drift = np.sqrt(((centres - old).astype(np.float64) ** 2).sum(1))
            self.loosen = approach(old, centres, radius)

    def settle(self, rows, cluster, upper, lower):
        """New clusters and bounds, and how many rows were compared with all centroids."""
        if self.first:
            doubt = np.arange(len(rows))
            cluster, upper, lower = (np.zeros(len(rows), t) for t in (np.int32, float, float))
        else:
            cluster = cluster.copy()
            upper, lower = upper + self.drift[cluster], lower - self.loosen[cluster]
            doubt = self.doubtful(np.arange(len(rows)), cluster, upper, lower)
            gap = rows[doubt] - self.centres[cluster[doubt]]
            upper[doubt] = np.sqrt((gap ** 2).sum(1).astype(np.float64))
            doubt = self.doubtful(doubt, cluster, upper, lower)
        if len(doubt):
            far = squared_distances(rows[doubt], self.centres)
            best = far.argmin(1)  # the first of equal ones
            cluster[doubt] = best
            upper[doubt] = np.sqrt(far[np.arange(len(best)), best].astype(np.float64))
            rest = far.astype(np.float64)
            rest[np.arange(len(best)), best] = np.inf
            lower[doubt] = np.sqrt(rest.min(1))
        return cluster, upper, lower, len(doubt)

    def doubtful(self, at, cluster, upper, lower):
        edge = np.maximum(lower[at], self.half[cluster[at]])
        return at[~(upper[at] + MARGIN * (1 + upper[at] + np.abs(lower[at])) < edge)]


def settled(batches, move: Move, dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = as_matrix(batch.column("x"), dims, KIND)
        if move.first:
            before, bounds = np.full(len(rows), -1, np.int32), (None, None)
        else:
            before = batch.column("cluster").to_numpy()
            bounds = batch.column("upper").to_numpy(), batch.column("lower").to_numpy()
        cluster, upper, lower, _ = move.settle(rows, before, *bounds)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("x"), *map(pa.array, (
                cluster.astype(np.int32), before, upper, lower))],
            names=["vec_id", "x", "cluster", "before", "upper", "lower"])


def changes(batches, k: int, dims: int) -> Iterator[pa.RecordBatch]:
    """Of a task, for each cluster: vectors and sums gained, and the radius that holds all."""
    count, radius = np.zeros(k, np.int64), np.zeros(k)
    sums = np.zeros((k, dims), object)
    for batch in batches:
        cluster, before = (batch.column(name).to_numpy() for name in ("cluster", "before"))
        np.maximum.at(radius, cluster, batch.column("upper").to_numpy())
        moved = np.flatnonzero(cluster != before)
        rows = as_matrix(batch.column("x").take(pa.array(moved)), dims, KIND)
        sign = (cluster[moved, None] == np.arange(k)).astype(np.int64)
        sign -= before[moved, None] == np.arange(k)
        count += sign.sum(0)
        sums = sums + exact_products(sign, rows).astype(object)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(k, dtype=np.int32)), pa.array(count), pa.array(radius),
         pa.array(sums.tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "radius", "sums"])


def gained(state: DataFrame, k: int, dims: int):
    """``changes`` of all tasks together: counts, sums and radii, a row a cluster."""
    parts = state.mapInArrow(partial(changes, k=k, dims=dims),
                             "cluster int, n long, radius double, sums array<long>")
    columns = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    rows = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"), *columns).collect()  # k rows
    count, radius, sums = [0] * k, np.zeros(k), [[0] * dims for _ in range(k)]
    for row in rows:
        count[row.cluster], radius[row.cluster] = row.n, row.radius
        sums[row.cluster] = [int(row[f"s{i}"]) for i in range(dims)]
    return count, sums, radius


def first_centres(vectors: DataFrame, k: int, dims: int, salt: str) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.where("vec_id IS NOT NULL").select(digest.alias("digest"), "x").orderBy(
        "digest", "x").limit(k).collect()
    return np.array([np.frombuffer(row.x, KIND) for row in rows], np.int64).reshape(-1, dims)


def own_distance(batches, centres, dims) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cluster = batch.column("cluster")
        gap = as_matrix(batch.column("x"), dims, KIND) - centres[cluster.to_numpy()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), cluster, pa.array((gap ** 2).sum(1))],
            names=["vec_id", "cluster", "distance"])


def cluster(embeddings: DataFrame, k=40, rounds=5, dims=64, salt="2:") -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` of each vector that takes part."""
    spark = embeddings.sparkSession
    vectors = materialize(embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    ).mapInArrow(partial(integer_rows, dims=dims, limit=limit(dims), kind=KIND),
                 "vec_id long, x binary"), "integer-vectors")
    centres = first_centres(vectors, k, dims, salt)
    if not len(centres):
        return vectors.selectExpr(
            "vec_id", "CAST(NULL AS INT) AS cluster", "CAST(NULL AS LONG) AS distance",
            "CAST(NULL AS LONG) AS cluster_inertia", "CAST(NULL AS LONG) AS inertia",
            "CAST(NULL AS STRING) AS centroid_sha256")
    k = len(centres)
    counts, sums = [0] * k, [[0] * dims for _ in range(k)]
    state, path, move = vectors, None, Move(centres)
    for number in range(rounds + 1):
        before, path = path, scratch_path(spark, f"clusters-{number}")
        state = materialize(
            state.mapInArrow(partial(settled, move=move, dims=dims), STATE), "clusters", path)
        if before:
            delete_path(spark, before)  # its successor is whole
        if number < rounds:
            count, gain, radius = gained(state, k, dims)
            counts = [a + b for a, b in zip(counts, count)]
            sums = [[a + b for a, b in zip(*rows)] for rows in zip(sums, gain)]
            new = np.array([[s // n for s in row] if n else old.tolist()
                            for row, n, old in zip(sums, counts, centres)], np.int64)
            move, centres = Move(new, centres, radius), new
    digests = [(i, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
               for i, row in enumerate(centres.tolist())]
    found = materialize(state.mapInArrow(
        partial(own_distance, centres=centres, dims=dims),
        "vec_id long, cluster int, distance long"), "distances")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = found.groupBy("cluster").agg(total.alias("own"))
    all_of_it = inertia.agg(F.sum("own")).first()[0] or 0
    of_cluster = spark.createDataFrame(digests, "cluster int, centroid_sha256 string").join(
        inertia, "cluster").select(
        "cluster", F.col("own").try_cast("long").alias("cluster_inertia"),
        F.lit(all_of_it).cast("decimal(38,0)").try_cast("long").alias("inertia"),
        "centroid_sha256")
    return found.join(F.broadcast(of_cluster), "cluster").select(  # k rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
