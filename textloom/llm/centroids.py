"""Centroid clustering in integers: each vector finds its centroid by a tournament of bisecting planes."""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize

CENTROIDS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SALT = "2"
#: Bytes that the planes of all pairs of centroids may take in a task.
PLANE_BYTES = 256 << 20
STEP_ROWS = 4096
LIMB = 32
LONG_MAX = (1 << 63) - 1

SUMS = "cluster int, dim int, limb int, value long"
ASSIGNED = "vec_id long, cluster int, distance long"


class Planes(NamedTuple):
    """Centroids, and for each pair ``i < j`` of them, in row ``j * (j - 1) / 2 + i``, the plane that bisects it.

    ``normals @ x > thresholds`` holds where ``j`` is nearer; on the plane and
    before it ``i`` wins.
    """

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray


def _fits(largest: int, dim: int) -> bool:
    """Whether products of vectors of such components, with twice their differences, stay within 64 bits."""
    return 8 * dim * (largest + 1) ** 2 < 1 << 62


def _integers(values: list[list[int]], dim: int) -> np.ndarray:
    largest = max((abs(v) for row in values for v in row), default=0)
    return np.array(values, dtype=np.int64 if _fits(largest, dim) else object).reshape(-1, dim)


def bisecting_planes(centroids: list[list[int]]) -> Planes:
    """The planes of all pairs; their size is checked, as it grows with the square of the number of centroids."""
    k, dim = len(centroids), len(centroids[0])
    if k * (k - 1) // 2 * (dim + 1) * 8 > PLANE_BYTES:
        raise ValueError(f"the planes between {k} centroids of {dim} dimensions take more than {PLANE_BYTES} bytes")
    c = _integers(centroids, dim)
    normals = [np.empty((0, dim), c.dtype), *[2 * (c[j] - c[:j]) for j in range(1, k)]]
    length = (c * c).sum(axis=1)
    thresholds = [np.empty(0, c.dtype), *[length[j] - length[:j] for j in range(1, k)]]
    return Planes(c, np.concatenate(normals), np.concatenate(thresholds))


def tournament(planes: Planes, x: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, the smaller number among equally near ones, by ``k - 1`` sign tests.

    The winner so far meets the next number. Nearness with the smaller number
    first is an order, so who wins all its tests wins overall.
    """
    winner = np.zeros(len(x), np.int64)
    for j in range(1, len(planes.centroids)):
        row = j * (j - 1) // 2 + winner
        side = (x * planes.normals[row]).sum(axis=1)
        winner[(side > planes.thresholds[row]).astype(bool)] = j
    return winner


def _floor_scaled(value: float, scale: int) -> int:
    return math.floor(Fraction(value) * scale)


def quantized(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``; as Python integers where 64 bits would not hold the products of later steps."""
    largest = float(np.abs(x).max()) if x.size else 0.0
    if largest * scale < 1 << 62 and _fits(int(largest * scale) + 1, x.shape[1]):
        return np.floor(x * scale).astype(np.int64)
    exact = [[_floor_scaled(v, scale) for v in row] for row in x.tolist()]
    return np.array(exact, dtype=object).reshape(x.shape)


def _batches(batches, dim: int, scale: int):
    """Ids and integer vectors, some thousand rows at a time."""
    for batch in batches:
        for lo in range(0, len(batch), STEP_ROWS):
            part = batch.slice(lo, STEP_ROWS)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            yield part.column("vec_id"), quantized(x.reshape(-1, dim), scale)


def _nearest(planes: Planes, x: np.ndarray) -> tuple[np.ndarray, Planes, np.ndarray]:
    """The tournament in the wider type of the two sides."""
    if x.dtype != planes.centroids.dtype:
        x, planes = x.astype(object), Planes(*[a.astype(object) for a in planes])
    return tournament(planes, x), planes, x


def limbs(value: int) -> list[int]:
    """Digits of ``LIMB`` bits, lowest first; the last one has the sign. Sums of digits stay far below 64 bits."""
    out = []
    while not -(1 << (LIMB - 1)) <= value < 1 << (LIMB - 1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def sums_by_cluster(points: DataFrame, planes: Planes, scale: int) -> list[tuple[int, list[int]]]:
    """Per cluster the number of its vectors and their exact componentwise sum, added up in each task first."""
    k, dim = planes.centroids.shape
    shared = points.sparkSession.sparkContext.broadcast(planes)

    def add(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), object)
        for _, x in _batches(batches, dim, scale):
            winner, _, x = _nearest(shared.value, x)
            count += np.bincount(winner, minlength=k)
            order = np.argsort(winner, kind="stable")
            at = np.flatnonzero(np.diff(winner[order], prepend=-1))
            if len(at):
                total[winner[order[at]]] += np.add.reduceat(x[order], at, axis=0)
        rows = []
        for c in np.flatnonzero(count).tolist():
            values = [int(count[c]), *[int(v) for v in total[c]]]
            rows += [(c, d, i, digit) for d, v in enumerate(values) for i, digit in enumerate(limbs(v))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            ["cluster", "dim", "limb", "value"],
        )

    found = points.mapInArrow(add, SUMS).groupBy("cluster", "dim", "limb").agg(F.sum("value").alias("value"))
    sums = [[0] * (dim + 1) for _ in range(k)]
    for row in found.collect():  # a few numbers per centroid and dimension
        sums[row["cluster"]][row["dim"]] += row["value"] << (LIMB * row["limb"])
    shared.destroy()
    return [(s[0], s[1:]) for s in sums]


def sound_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """``(vec_id, x)``: vectors with an id and exactly ``dim`` components, none null or non-finite, as doubles."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL")
    infinite = F.lit(float("inf"))
    return rows.where(F.size("x") == dim).where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite)))


def first_centroids(points: DataFrame, k: int, salt: str, scale: int) -> list[list[int]]:
    """The vectors with the ``k`` smallest digests of ``salt:vec_id``; rows of one id in the order of their components."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = points.select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k).collect()
    return [[_floor_scaled(v, scale) for v in r["x"]] for r in rows]


def centroid_clusters(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dim: int = DIMENSIONS,
    scale: int = SCALE,
    salt: str = SALT,
) -> DataFrame:
    """Clusters of ``vectors (vec_id, embedding)``: ``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``.

    Components become ``floor(scale * x)``; everything after that is exact.
    A vector's centroid is found by a tournament: for each pair of centroids the
    plane between them is known, and one sign test removes one of the two. Each
    round reads the vectors once; a task sends its sums per cluster, so what is
    shuffled and what the driver holds depends on ``k`` and ``dim`` alone. A
    cluster without vectors keeps its centroid.

    Vectors of another length, with a null or a non-finite component or without
    vec_id take no part. Every other row counts, repeated ones too. With fewer
    than ``k`` rows each is a centroid; an empty table gives an empty one. A
    distance, or a sum of distances, that 64 bits cannot hold is null. Other
    columns are not looked at.
    """
    spark = vectors.sparkSession
    points = materialize(sound_vectors(vectors, dim), "integer-vectors")
    centroids = first_centroids(points, k, salt, scale)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        sums = sums_by_cluster(points, bisecting_planes(centroids), scale)
        centroids = [[s // n for s in total] if n else c for c, (n, total) in zip(centroids, sums)]
    shared = spark.sparkContext.broadcast(bisecting_planes(centroids))

    def assign(batches):
        for ids, x in _batches(batches, dim, scale):
            winner, planes, x = _nearest(shared.value, x)
            off = x - planes.centroids[winner]
            distance = [d if d <= LONG_MAX else None for d in (off * off).sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(winner.astype(np.int32)), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"]
            )

    assigned = materialize(points.mapInArrow(assign, ASSIGNED), "assigned")
    exact = F.col("distance").cast("decimal(38,0)")
    totals = assigned.groupBy("cluster").agg(F.sum(exact).alias("total"), F.count_if(F.col("distance").isNull()).alias("unknown"))
    found = {r["cluster"]: None if r["unknown"] else int(r["total"]) for r in totals.collect()}  # a row per centroid

    def held(value: int | None) -> int | None:
        return value if value is not None and value <= LONG_MAX else None

    whole = held(None if None in found.values() else sum(found.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, held(total), whole, digest[c]) for c, total in sorted(found.items())]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of_cluster), "cluster").select(*[name.split()[0] for name in schema.split(", ")])
