"""Centroid clustering in whole numbers, with n-simplex bounds in front of the exact comparison.

A few pivots are chosen once. The distances of a vector to them fix its apex over the simplex of the pivots: the part
that lies in the pivots' span, and the height above it. For two apexes the Euclidean distance with the heights on one
side is a lower bound of the vectors' distance, with the heights on opposite sides an upper one. The apexes of all
vectors are computed once and stored beside them; a round computes those of its centroids. For each vector the centroid
with the smallest upper bound is compared exactly, and so is every centroid whose lower bound does not exceed that
distance. The bounds are doubles with a margin; comparisons, sums and means are integers.

Only centroids (``k`` x ``dims`` numbers) pass through the driver. Sums are combined per task and then by Spark, so a
cluster that holds most vectors is no single task's work.

Vectors of another length, with null or non-finite components, or null, take no part. Components are held within +-2^24
after scaling. Rows are clustered one by one: repeated rows count repeatedly, may start as several equal centroids, and
go to the smaller number; a null id counts as an empty one in the order of the starts. With fewer rows than ``k`` every
row starts a centroid. Tables without rows give no rows. Further columns are carried along by ``cluster``; columns of
the names it adds are replaced. Inertia that exceeds a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import write_stage
from ratescope.llm.vectors import is_whole, matrix, quantised

K = 40
ROUNDS = 5
DIMS = 64
PIVOTS = 24
#: A pivot is taken while it stands this share of the pivots' spread above the span of those before.
_LEAST_HEIGHT = 0.05
#: Share of the squared lengths by which bounds may be off, far above the rounding of doubles over such a simplex.
_MARGIN = 1e-7
_CHUNK = 2_048
_ADDED = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def start_order(id_column: Column, seed: int = 2) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)


@dataclass(frozen=True)
class Pivots:
    """Points whose distances place a vector: the first one, and the others' coordinates over it (lower triangular)."""

    points: np.ndarray
    base: np.ndarray

    @classmethod
    def chosen(cls, points: np.ndarray, most: int = PIVOTS) -> "Pivots":
        """At most ``most`` of ``points``, each the one farthest above the span of those before."""
        offsets = points.astype(np.float64) - points[0]
        rest, chosen, axes = offsets.copy(), [0], []
        spread = np.sqrt((offsets**2).sum(axis=1).max())
        while len(chosen) < most:
            heights = np.sqrt((rest**2).sum(axis=1))
            best = int(heights.argmax())
            if heights[best] <= _LEAST_HEIGHT * spread or heights[best] == 0:
                break
            axis = rest[best] / heights[best]
            rest -= np.outer(rest @ axis, axis)
            chosen.append(best)
            axes.append(axis)
        base = offsets[chosen[1:]] @ np.array(axes).T if axes else np.zeros((0, 0))
        return cls(points[chosen].astype(np.float64), np.tril(base))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates in the pivots' span and the height above it, from the distances to the pivots alone."""
        x = vectors.astype(np.float64)
        squared = np.empty((len(x), len(self.points)))
        for i, p in enumerate(self.points):
            away = x - p
            squared[:, i] = np.einsum("ij,ij->i", away, away)
        out = np.zeros((len(x), len(self.points)))
        for i, edge in enumerate(self.base):
            # |x - p0|^2 - |x - pi|^2 = 2 y.pi - |pi|^2 gives the coordinates one after another.
            right = (squared[:, 0] - squared[:, i + 1] + edge @ edge) / 2
            out[:, i] = (right - out[:, :i] @ edge[:i]) / edge[i]
        inside = np.einsum("ij,ij->i", out, out)
        out[:, -1] = np.sqrt(np.maximum(squared[:, 0] - inside, 0.0))
        return out


@dataclass(frozen=True)
class Centroids:
    """Centroids of a round with their apexes."""

    vectors: np.ndarray
    apexes: np.ndarray

    @classmethod
    def over(cls, vectors: np.ndarray, pivots: Pivots) -> "Centroids":
        return cls(vectors.astype(np.int64), pivots.apexes(vectors))

    def nearest(self, vectors: np.ndarray, apexes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid, the squared distance, and how many exact comparisons that took."""
        numbers, distances, compared = [], [], 0
        for at in range(0, len(vectors), _CHUNK):
            x, a = vectors[at:at + _CHUNK].astype(np.int64), apexes[at:at + _CHUNK]
            lengths = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", self.apexes, self.apexes)
            low = lengths - 2 * (a @ self.apexes.T)
            high = low + 4 * np.outer(a[:, -1], self.apexes[:, -1])
            rows = np.arange(len(x))
            first = high.argmin(axis=1)
            exact = np.full(low.shape, np.iinfo(np.int64).max)
            away = x - self.vectors[first]
            exact[rows, first] = best = np.einsum("ij,ij->i", away, away)
            open_ = low <= best[:, None] + _MARGIN * lengths + 1
            open_[rows, first] = False
            who, which = np.nonzero(open_)
            away = x[who] - self.vectors[which]
            exact[who, which] = np.einsum("ij,ij->i", away, away)
            chosen = exact.argmin(axis=1)  # the first of equal ones
            numbers.append(chosen)
            distances.append(exact[rows, chosen])
            compared += len(x) + len(who)
        if not numbers:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        return np.concatenate(numbers), np.concatenate(distances), compared


def _partial_sums(centroids, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Centroids = centroids.value
        sums, counts = np.zeros((len(held.vectors), dims), np.int64), np.zeros(len(held.vectors), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dims)
            numbers, _, _ = held.nearest(x, matrix(batch.column(1), held.apexes.shape[1]))
            for c in np.unique(numbers):
                mine = x[numbers == c]
                sums[c] += mine.sum(axis=0, dtype=np.int64)
                counts[c] += len(mine)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(used, pa.int32()), "n": pa.array(counts[used]), "sums": pa.array(list(sums[used]), pa.list_(pa.int64()))}
        )

    return run


def _moved(vectors: DataFrame, held: Centroids, dims: int) -> np.ndarray:
    """The next round's centroids: floor of the mean; an empty one stays."""
    shared = vectors.sparkSession.sparkContext.broadcast(held)
    partial = vectors.select("_cc_q", "_cc_apex").mapInArrow(_partial_sums(shared, dims), "cluster int, n bigint, sums array<bigint>")
    totals = (
        partial.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("part").alias("total"))
    )
    moved = held.vectors.copy()
    for row in totals.collect():  # at most k x dims
        moved[row["cluster"], row["place"]] = row["total"] // row["n"]
    shared.unpersist()
    return moved


def fit(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS,
    scale: int = 256, seed: int = 2, pivots: int = PIVOTS,
) -> tuple[DataFrame, Centroids | None]:
    """The rows that take part, with their integers and apexes (``_cc_q``, ``_cc_apex``), and the last centroids.

    There are no centroids where no row takes part.
    """
    whole = df.where(is_whole(F.col(vector_column), dims)).withColumn("_cc_q", quantised(F.col(vector_column), scale))
    order = start_order(F.col(id_column), seed).alias("_cc_order")
    starts = np.array([r["_cc_q"] for r in whole.select(order, "_cc_q").orderBy("_cc_order", "_cc_q").limit(k).collect()], dtype=np.int64)
    if not len(starts):
        return whole.withColumn("_cc_apex", F.array().cast("array<double>")), None
    spread = Pivots.chosen(starts, pivots)
    shared = df.sparkSession.sparkContext.broadcast(spread)

    @F.arrow_udf("array<double>")
    def apex(q: pa.Array) -> pa.Array:
        found = shared.value.apexes(matrix(q, dims))
        return pa.ListArray.from_arrays(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32), found.ravel())

    vectors = write_stage(whole.withColumn("_cc_apex", apex("_cc_q")), "cluster-vectors")
    held = Centroids.over(starts, spread)
    for _ in range(rounds):
        held = Centroids.over(_moved(vectors, held, dims), spread)
    return vectors, held


def cluster(df: DataFrame, **options) -> DataFrame:
    """``df`` without the rows that take no part, with cluster, distance, cluster_inertia, inertia and centroid_sha256.

    ``options`` are those of ``fit``.
    """
    spark = df.sparkSession
    vectors, held = fit(df.drop(*_ADDED), **options)
    if held is None:
        missing = [F.lit(None).cast(t).alias(c) for c, t in zip(_ADDED, ("int", "bigint", "bigint", "bigint", "string"))]
        return vectors.drop("_cc_q", "_cc_apex").select("*", *missing).where(F.lit(False))
    dims = held.vectors.shape[1]
    shared = spark.sparkContext.broadcast(held)

    @F.arrow_udf("struct<cluster: int, distance: bigint>")
    def assign(q: pa.Array, apex: pa.Array) -> pa.Array:
        numbers, distances, _ = shared.value.nearest(matrix(q, dims), matrix(apex, shared.value.apexes.shape[1]))
        return pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(distances, pa.int64())], ["cluster", "distance"])

    found = vectors.withColumn("_cc", assign("_cc_q", "_cc_apex")).drop("_cc_q", "_cc_apex")
    placed = write_stage(found.select(*[F.col(f"`{c}`") for c in found.columns if c != "_cc"], "_cc.cluster", "_cc.distance"), "cluster-placed")
    per_cluster = placed.groupBy("cluster").agg(F.try_sum("distance").alias("inertia")).collect()  # at most k rows
    known = {r["cluster"]: r["inertia"] for r in per_cluster}
    total = None if None in known.values() or sum(known.values()) >= 1 << 63 else sum(known.values())
    told = [
        (c, known.get(c), total, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(held.vectors.tolist())
    ]
    facts = spark.createDataFrame(told, "_cc_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(facts), F.col("cluster") == F.col("_cc_cluster")).drop("_cc_cluster")
