"""Exact integer k-means whose centroids are filtered by n-simplex projection.

The distances of every vector to a few pivots are computed once and stored as
apex coordinates: with the pivots as the base of a simplex, a vector is its apex, given
by coordinates in the base and an altitude above it. For two apexes the Euclidean
distance of their coordinates is a lower bound of the vectors' distance, and the same
with the altitudes added instead of subtracted is an upper bound. In each round a
centroid whose lower bound exceeds a vector's least upper bound is out; those that are
left are compared by their exact integer distances. A slack covers the bounds' rounding,
so it can only let more centroids through.

Vectors stay where they are: a round is one scan of the stored rows, whose tasks send
one sum per centroid and component; the driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import stored
from quill.llm.vectors import doubles, integer_rows, sums

#: Pivots of the simplex at most, and the vectors they are chosen from.
PIVOTS = 16
SAMPLE = 512
#: A pivot counts if it stands this share of the sample's spread above the others' base.
ALTITUDE = 0.05
#: Slack of the bounds as a share of the distances to the first pivot.
SLACK = 1e-5


@dataclass
class Base:
    """Pivots, and the lower triangle of their own coordinates (first pivot at 0)."""

    pivots: np.ndarray
    triangle: np.ndarray
    squares: np.ndarray

    def apex(self, x: np.ndarray) -> np.ndarray:
        """Coordinates in the base, then the altitude, then the distance to the first pivot,
        all from the distances to the pivots."""
        x = x.astype(float)
        d = np.stack([((x - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)
        w = (d[:, :1] + self.squares - d[:, 1:]) / 2
        y = np.zeros_like(w)
        for i in range(w.shape[1]):
            y[:, i] = (w[:, i] - y[:, :i] @ self.triangle[i, :i]) / self.triangle[i, i]
        altitude = np.sqrt(np.maximum(d[:, 0] - (y**2).sum(axis=1), 0))
        return np.concatenate([y, altitude[:, None], np.sqrt(d[:, :1])], axis=1)


def base(sample: np.ndarray, most: int = PIVOTS) -> Base:
    """Pivots of the sample, each the vector farthest above the base of those before."""
    x = sample.astype(float)
    rest = x - x[0]
    chosen, rows, first = [0], [], None
    # The directions only choose the pivots: coordinates come from distances.
    while len(chosen) < most:
        height = np.sqrt((rest**2).sum(axis=1))
        far = int(height.argmax())
        first = height[far] if first is None else first
        if height[far] <= ALTITUDE * first or height[far] == 0:
            break
        axis = rest[far] / height[far]
        rows.append(axis)
        rest = rest - np.outer(rest @ axis, axis)
        chosen.append(far)
    p = x[chosen]
    axes = np.array(rows).reshape(-1, x.shape[1])
    triangle = np.tril((p[1:] - p[0]) @ axes.T)
    return Base(p, triangle, ((p[1:] - p[0]) ** 2).sum(axis=1))


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between the apexes ``a`` and ``b``."""
    flat = ((a[:, None, :-2] - b[None, :, :-2]) ** 2).sum(axis=2)
    h, g = a[:, None, -2], b[None, :, -2]
    slack = SLACK * (a[:, None, -1] + b[None, :, -1]) + 1e-6
    return np.sqrt(flat + (h - g) ** 2) - slack, np.sqrt(flat + (h + g) ** 2) + slack


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray, all_distances: bool) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, its squared distance) of every row of ``x``, ties to the smaller
    number. Distances of rows with one centroid left are computed only if asked for."""
    low, high = bounds(apexes, centres)
    left = low <= high.min(axis=1)[:, None]
    if not all_distances:
        alone = left.sum(axis=1) == 1
        left &= ~alone[:, None]
    d = np.full(left.shape, np.iinfo(np.int64).max)
    for c in range(len(centroids)):
        at = np.flatnonzero(left[:, c])
        d[at, c] = ((x[at] - centroids[c]) ** 2).sum(axis=1)
    who = d.argmin(axis=1)
    if not all_distances:
        who[alone] = (low <= high.min(axis=1)[:, None])[alone].argmax(axis=1)
    return who, d[np.arange(len(x)), who]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _starts(rows: DataFrame, scale: float, length: int, seed: int) -> list[list[int]]:
    """The ``SAMPLE`` vectors of smallest hash; a null id comes last, equal ids by vector."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in integer_rows(batch.column("x"), scale, length):
                yield pa.RecordBatch.from_arrays([batch.column("h").take(pa.array(at)), pa.array(x.tolist(), pa.list_(pa.int64()))], names=["h", "v"])

    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    few = rows.select(h.alias("h"), "x").mapInArrow(whole, "h string, v array<long>")
    return [r["v"] for r in few.orderBy(F.col("h").asc_nulls_last(), "v").limit(SAMPLE).collect()]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, length: int = 64, scale: float = 1024, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: exact
    k-means of the vectors with ``length`` components, none of them null or non-finite, as
    integers floor(scale * x).

    Centroids start as the ``k`` vectors of smallest sha256 of ``seed:vec_id`` (fewer
    vectors: fewer centroids; equal ids in the order of their vectors; a null id last).
    A round assigns every vector to the nearest centroid, ties to the smaller number, then
    moves every centroid that has vectors to their componentwise floor(sum / count).

    Every row counts, repeated ids and null ids too. Distances are 64-bit: a component
    beyond ``vectors.limit`` raises. Empty tables give no rows; other columns are ignored."""
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), doubles(vector_col).alias("x"))
    sample = np.array(_starts(rows, scale, length, seed), np.int64)
    if not len(sample):
        return spark.createDataFrame([], schema)
    simplex = base(sample)
    centroids = sample[:k].copy()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in integer_rows(batch.column("x"), scale, length):
                apex = simplex.apex(x)
                flat = lambda m, kind: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1]), pa.int32()), pa.array(m.ravel(), kind))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), flat(x, pa.int32()), flat(apex, pa.float64())],
                                                 names=["vec_id", "v", "apex"])

    held = stored(rows.mapInArrow(project, "vec_id long, v array<int>, apex array<double>"), "apexes")

    def assigned(batch: pa.RecordBatch, centroids: np.ndarray, all_distances: bool):
        x = _matrix(batch.column("v")).astype(np.int64)
        return x, *nearest(x, _matrix(batch.column("apex")), centroids, simplex.apex(centroids), all_distances)

    for _ in range(rounds):
        def total(batches: Iterator[pa.RecordBatch], centroids=centroids) -> Iterator[pa.RecordBatch]:
            # For each centroid the sums of its vectors' components, then their number.
            out = np.zeros((len(centroids), length + 1), np.int64)
            for batch in batches:
                if batch.num_rows:
                    x, who, _ = assigned(batch, centroids, False)
                    for c in range(len(centroids)):
                        out[c, :-1] += x[who == c].sum(axis=0)
                    out[:, -1] += np.bincount(who, minlength=len(centroids))
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(out.ravel()[at])], names=["slot", "value"])

        found = sums(held.select("v", "apex").mapInArrow(total, "slot int, value long"))
        moved = centroids.copy()
        for c in range(len(centroids)):
            if n := found.get(c * (length + 1) + length, 0):
                moved[c] = [found.get(c * (length + 1) + i, 0) // n for i in range(length)]
        if (moved == centroids).all():
            break  # every later round gives the same
        centroids = moved

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, who, d = assigned(batch, centroids, True)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(d)], names=["vec_id", "cluster", "distance"])

    out = stored(held.mapInArrow(final, "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: int(r["d"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    own = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return out.select("vec_id", "cluster", "distance", own([inertia.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
                      F.lit(sum(inertia.values())).cast("long").alias("inertia"), own(digest).alias("centroid_sha256"))
