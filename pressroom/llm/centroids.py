"""Exact centroid clustering with Ptolemaic lower bounds.

For any four points, d(x,c) * d(p,s) >= |d(x,p) * d(c,s) - d(x,s) * d(c,p)| (Ptolemy). A few pivots stay fixed, and each vector's
distances to them are computed once and stored with it. In each round a task computes the centroids' distances to the pivots and takes the
largest bound over all pivot pairs for every vector and centroid. Bounds are rounded down by more than the error of their floating-point steps, so a
centroid is left out only where it is certainly farther than the best one known; the others are compared by exact integer distances.

Vectors stay where they are stored. A task sums its vectors per cluster, and only these sums meet, so a cluster with a third of all vectors is a few rows
more, not a hot task. The driver holds the centroids, `k` vectors, and a bounded sample for the choice of pivots.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.vectors import as_longs, distance_kind, matrix, scaled, whole
from pressroom.session import materialize

PIVOTS = 6
SAMPLE = 64
SLACK = 2.0 ** -46  # relative, above the sum of rounding errors of a bound's few operations
RUN = 8192


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to the vector y."""
    kind = distance_kind(x, y[None, :])
    apart = x.astype(kind) - y.astype(kind)
    return (apart * apart).sum(axis=1)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from one another: each next one has the largest distance to those before."""
    taken = [0] if len(sample) else []
    near = squared(sample, sample[0]) if taken else None
    while taken and len(taken) < count and (far := int(near.argmax())) is not None and near[far] > 0:
        taken.append(far)
        near = np.minimum(near, squared(sample, sample[far]))
    return sample[taken]


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squared(x, p).astype(np.float64)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(x), 0))


def lower_bounds(own: np.ndarray, theirs: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances, vectors by centroids, from both sides' distances to the pivots and those between the pivots."""
    most = np.zeros((len(own), len(theirs)))
    for a in range(len(between)):
        for b in range(a):
            x, y = np.outer(own[:, a], theirs[:, b]), np.outer(own[:, b], theirs[:, a])
            np.maximum(most, (np.abs(x - y) - SLACK * (x + y)) / between[a, b], out=most)
    return most * most * (1 - SLACK)


def assign(x: np.ndarray, own: np.ndarray, centroids: np.ndarray, pivots: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (the smaller number of equally near ones), its squared distance, and how many distances were computed."""
    cluster, distance, compared = [], [], 0
    theirs = to_pivots(centroids, pivots)
    for i in range(0, len(x), RUN):
        some = x[i:i + RUN]
        bounds = lower_bounds(own[i:i + RUN], theirs, between)
        first = bounds.argmin(axis=1)
        nearest, least = np.full(len(some), -1), None
        for j in [None, *range(len(centroids))]:
            if j is None:  # the most promising centroid of each vector sets what the others must reach
                least = np.zeros(len(some), distance_kind(some, centroids))
                for c in np.unique(first):
                    at = np.flatnonzero(first == c)
                    least[at], nearest[at] = squared(some[at], centroids[c]), c
                compared += len(some)
                continue
            at = np.flatnonzero((bounds[:, j] <= least.astype(np.float64)) & (first != j))
            if len(at):
                apart = squared(some[at], centroids[j])
                better = (apart < least[at]) | ((apart == least[at]) & (j < nearest[at]))
                least[at[better]], nearest[at[better]] = apart[better], j
                compared += len(at)
        cluster.append(nearest)
        distance.append(least)
    return np.concatenate(cluster) if cluster else np.zeros(0, np.int64), np.concatenate(distance) if distance else np.zeros(0, np.int64), compared


def _with_pivots(pivots: np.ndarray):
    def made(batches):
        for batch in batches:
            own = to_pivots(matrix(batch.column("_v"), pivots.shape[1]), pivots)
            columns = [batch.column("_id"), batch.column("_v"), pa.array(list(own), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_v", "_to_pivots"])

    return made


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    between = to_pivots(pivots, pivots)

    def each(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("_v"))
                own = matrix(batch.column("_to_pivots")) if len(pivots) else np.zeros((len(x), 0))
                yield batch, x, *assign(x, own, centroids, pivots, between)[:2]

    return each


def _summed(centroids: np.ndarray, pivots: np.ndarray):
    each = _assigned(centroids, pivots)

    def made(batches):
        """How many vectors of a task each cluster has, and their sum."""
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, object)
        for _, x, cluster, _ in each(batches):
            x = x if largest_sum_fits(x) else x.astype(object)
            for c in np.unique(cluster):
                mine = x[cluster == c]
                counts[c] += len(mine)
                sums[c] += mine.sum(axis=0).astype(object)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(counts[held], pa.int64()), pa.array([[Decimal(int(v)) for v in sums[c]] for c in held], pa.list_(pa.decimal128(38, 0)))],
            names=["_cluster", "_n", "_sums"],
        )

    return made


def largest_sum_fits(x: np.ndarray) -> bool:
    return not len(x) or max(int(x.max()), -int(x.min())) * len(x) < 1 << 63


def _named(centroids: np.ndarray, pivots: np.ndarray):
    each = _assigned(centroids, pivots)

    def made(batches):
        for batch, _, cluster, distance in each(batches):
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(cluster, pa.int32()), pa.array(as_longs(distance), pa.int64())], names=["_id", "cluster", "distance"])

    return made


def moved(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of each cluster's vectors; an empty cluster keeps its centroid."""
    sums = stored.mapInArrow(_summed(centroids, pivots), "_cluster int, _n long, _sums array<decimal(38,0)>")
    each = sums.select("_cluster", "_n", F.posexplode("_sums").alias("_at", "_sum")).groupBy("_cluster", "_at").agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"))
    out = centroids.copy()
    for r in each.collect():  # a row per centroid and component
        out[r["_cluster"], r["_at"]] = int(r["_sum"]) // r["_n"]
    return out


def cluster(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64,
            seed: str = "1", n_pivots: int = PIVOTS) -> DataFrame:
    """One row per kept vector: _id, cluster, distance (squared), cluster_inertia, inertia, centroid (components).

    Kept are rows with exactly `dims` components, none null or non-finite; components become floor(scale * x). The first centroids are the k
    kept vectors with the smallest sha256 of `<seed>:<id>`, in that order (equal ids: by components; null ids last). Each round assigns all
    vectors to the nearest centroid, ties to the smaller number, then moves each non-empty centroid to the floored mean. Fewer vectors than k are as
    many centroids. Repeated rows are vectors of their own. Distances and sums beyond a long are the largest long. Other columns are not read; an empty
    table gives no rows. Pivots come from the SAMPLE vectors with the smallest hash under another seed and change no result.
    """
    spark = rows.sparkSession
    taken = rows.select(F.col(id).cast("long").alias("_id"), F.col(vector).alias("_vector"))
    kept = taken.filter((F.size("_vector") == dims) & whole(F.col("_vector"))).select("_id", scaled(F.col("_vector"), scale).alias("_v"))
    order = lambda name: F.sha2(F.concat(F.lit(f"{name}:"), F.col("_id").cast("string")), 256).asc_nulls_last()
    ends = [kept.orderBy(order(name), "_v").limit(n).select("_v").collect() for name, n in ((seed, k), (f"pivot {seed}", SAMPLE))]
    first, sample = (np.array([r[0] for r in found], np.int64).reshape(-1, dims) for found in ends)
    schema = "_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(first):
        return spark.createDataFrame([], schema)
    pivots = choose_pivots(sample, n_pivots)
    stored = materialize(kept.mapInArrow(_with_pivots(pivots), "_id long, _v array<long>, _to_pivots array<double>"), "centroid-vectors")
    centroids = first
    for _ in range(rounds):
        centroids = moved(stored, centroids, pivots)
    named = materialize(stored.mapInArrow(_named(centroids, pivots), "_id long, cluster int, distance long"), "centroid-named")
    inertia = {r[0]: int(r[1]) for r in named.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # at most k rows
    most = (1 << 63) - 1
    facts = [(c, min(most, n), min(most, sum(inertia.values())), [int(v) for v in centroids[c]]) for c, n in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return named.join(F.broadcast(facts), "cluster").select("_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
