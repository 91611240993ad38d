"""k-means. Points stay distributed; only the k centroids reach the driver."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.joins import broadcast_if_small


def points_of(df: DataFrame, id_column: str, features: list[str]) -> DataFrame:
    """Rows as points ``(id, x)``, with the chosen columns as coordinates."""
    return df.select(F.col(id_column).alias("id"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))


def coordinates(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """Points of a batch as rows. A missing point or coordinate, or one of another length, is an error."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    dim = int(lengths[0]) if dim is None and len(lengths) else dim or 0
    if column.null_count or (lengths != dim).any():
        raise ValueError(f"every point needs {dim} coordinates")
    flat = column.flatten()
    if flat.null_count or (flat_values := flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)).size != len(column) * dim:
        raise ValueError("a coordinate is missing")
    return flat_values.reshape(-1, dim)


def feature_bounds(points: DataFrame) -> tuple[list[float], list[float]]:
    """Minimum and maximum per dimension, in one pass; a task returns one row."""

    def fold(batches):
        low = high = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = coordinates(batch.column("x"), None if low is None else len(low))
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v.tolist()], pa.list_(pa.float64())) for v in (low, high)], ["low", "high"])

    chosen = points.select(F.col("x").cast("array<double>").alias("x"))
    folded = chosen.mapInArrow(fold, "low array<double>, high array<double>")
    zipped = folded.select(F.posexplode(F.arrays_zip("low", "high")).alias("dim", "v"))
    rows = zipped.groupBy("dim").agg(F.min("v.low").alias("low"), F.max("v.high").alias("high"), F.count("*").alias("n")).orderBy("dim").collect()
    if not rows:
        raise ValueError("no points")
    if len({row["n"] for row in rows}) > 1:
        raise ValueError("every point needs the same number of coordinates")
    return [row["low"] for row in rows], [row["high"] for row in rows]


def init_centroids(bounds: tuple[list[float], list[float]], k: int, seed: int | None = None) -> list[list[float]]:
    """``k`` points in the bounding box: uniform for a ``seed``, else evenly spaced along its diagonal."""
    low, high = bounds
    if k < 1:
        raise ValueError("k must be positive")
    if seed is None:
        return [[lo + (hi - lo) * (i + 0.5) / k for lo, hi in zip(low, high)] for i in range(k)]
    rng = random.Random(seed)
    return [[lo + (hi - lo) * rng.random() for lo, hi in zip(low, high)] for _ in range(k)]


def _nearest_in(centroids: list[list[float]]):
    """Coordinates, nearest centroid and distance of the points of an Arrow batch."""
    table = np.array(centroids, dtype=np.float64)

    def nearest(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = coordinates(batch.column("x"), table.shape[1])
        best, cluster = np.full(len(x), np.inf), np.zeros(len(x), dtype=np.int64)
        for i, centroid in enumerate(table):
            distance = np.sqrt(((x - centroid) ** 2).sum(axis=1))
            closer = distance < best
            best[closer], cluster[closer] = distance[closer], i
        return x, cluster, best

    return nearest


def assign(points: DataFrame, centroids: list[list[float]]) -> DataFrame:
    """Nearest centroid of each point ``(id, x)``; the first of equally near ones. No join."""
    nearest = _nearest_in(centroids)

    def assigned(batches):
        for batch in batches:
            _, cluster, distance = nearest(batch)
            columns = [batch.column("id"), batch.column("x"), pa.array(cluster), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "x", "cluster", "distance"])

    id_type = points.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, x array<double>, cluster long, distance double"
    return points.select("id", F.col("x").cast("array<double>").alias("x")).mapInArrow(assigned, schema)


def update_centroids(points: DataFrame, centroids: list[list[float]]) -> list[list[float]]:
    """Mean of the points nearest to each centroid; one without points stays where it is.

    A task returns one sum per cluster and dimension; k x dimensions values are collected.
    """
    nearest = _nearest_in(centroids)
    shape = (len(centroids), len(centroids[0]))

    def sums(batches):
        total, count = np.zeros(shape), np.zeros(shape[0], dtype=np.int64)
        for batch in batches:
            x, cluster, _ = nearest(batch)
            for d in range(shape[1]):
                total[:, d] += np.bincount(cluster, weights=x[:, d], minlength=shape[0])
            count += np.bincount(cluster, minlength=shape[0])
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.float64()))],
            ["cluster", "n", "total"],
        )

    chosen = points.select(F.col("x").cast("array<double>").alias("x"))
    partial = chosen.mapInArrow(sums, "cluster long, n long, total array<double>")
    values = partial.select("cluster", "n", F.posexplode("total").alias("dim", "value"))
    means = values.groupBy("cluster", "dim").agg((F.sum("value") / F.sum("n")).alias("mean"))
    updated = [list(c) for c in centroids]
    for row in means.collect():
        updated[row["cluster"]][row["dim"]] = row["mean"]
    return updated


def kmeans(
    points: DataFrame, centroids: list[list[float]], max_rounds: int | None = None, tolerance: float = 1e-9
) -> tuple[DataFrame, list[list[float]]]:
    """Assign and update until no centroid moves by more than ``tolerance``, which is there for rounding only.

    It is a share of the size of a coordinate, where that is above 1: sums in
    changing order round by such shares. A missing point or coordinate, and
    points of different lengths, are an error.

    Returns the points assigned to the final centroids, and these. ``points``
    should be a stored table, as every round reads it. There is no bound on the
    rounds unless ``max_rounds`` sets one; a run that reaches it raises an error.
    """
    rounds = 0
    while True:
        updated = update_centroids(points, centroids)
        moved = max(abs(a - b) / max(1.0, abs(a)) for old, new in zip(centroids, updated) for a, b in zip(old, new))
        centroids = updated
        if moved <= tolerance:
            return assign(points, centroids), centroids
        rounds += 1
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"centroids still move by {moved} after {rounds} rounds")


def clustering_cost(assigned: DataFrame) -> DataFrame:
    """Sum of the (not squared) distances to the own centroid."""
    return assigned.agg(F.sum("distance").alias("cost"))


def cluster_report(assigned: DataFrame, centroids: list[list[float]]) -> DataFrame:
    """Members of each cluster with its centroid, in order."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(centroids)]
    table = assigned.sparkSession.createDataFrame(rows, "cluster long, centroid array<double>")
    joined = assigned.join(broadcast_if_small(table), "cluster")
    return joined.select(*assigned.columns, "centroid").orderBy("cluster", "id")
