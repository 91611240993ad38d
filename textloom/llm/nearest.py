"""Approximate nearest neighbours: a forest of random-projection trees with one priority queue for all trees."""

from __future__ import annotations

import heapq
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.blocks import of_group
from textloom.session import materialize

TREES = 24
#: Vectors that the hyperplanes are fitted on, on average; all vectors are indexed.
SAMPLE = 50_000
#: Sample vectors of a leaf.
LEAF = 256
#: Least candidates per query, counted with repetitions in several trees.
CANDIDATES = 60_000
#: The budget is raised until so many queries, on average, find this share of their true neighbours.
JUDGED = 64
LEAST_RECALL = 0.95
#: Vectors, and queries, of one task's share of a leaf.
SHARE_VECTORS = 4096
SHARE_QUERIES = 1024
SEED = 9


class Tree(NamedTuple):
    """Inner nodes in rows: hyperplane, offset, and children (negative: leaf ``-child - 1``)."""

    planes: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int


def grow_tree(points: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """Split at the median of a random projection until at most ``leaf`` points are left."""
    planes, offsets, children = [], [], []
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            w = rng.standard_normal(points.shape[1])
            w /= np.linalg.norm(w)
            x = points[rows] @ w
            middle = float(np.median(x))
            left = x <= middle
            if left.any() and not left.all():
                node = len(planes)
                planes.append(w)
                offsets.append(middle)
                children.append([0, 0])
                children[node] = [grow(rows[left]), grow(rows[~left])]
                return node
        leaves += 1
        return -leaves

    root = grow(np.arange(len(points)))
    if root < 0:
        return Tree(np.zeros((0, points.shape[1])), np.zeros(0), np.zeros((0, 2), np.int64), 1)
    return Tree(np.array(planes), np.array(offsets), np.array(children), leaves)


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of every point."""
    at = np.full(len(points), 0 if len(tree.planes) else -1)
    while (inner := np.flatnonzero(at >= 0)).size:
        node = at[inner]
        right = np.einsum("ij,ij->i", points[inner], tree.planes[node]) > tree.offsets[node]
        at[inner] = tree.children[node, right.astype(int)]
    return -at - 1


def probe_order(trees: list[Tree], query: np.ndarray):
    """All leaves as ``(tree, leaf)``, nearest first over all trees.

    The queue is ordered by the smallest margin by which a subtree lies on the
    query's side of the planes above it.
    """
    margins = [t.planes @ query - t.offsets for t in trees]
    queue = [(-math.inf, k, 0 if len(t.planes) else -1) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    while queue:
        far, k, node = heapq.heappop(queue)
        if node < 0:
            yield k, -node - 1
            continue
        margin = margins[k][node]
        left, right = trees[k].children[node].tolist()
        heapq.heappush(queue, (max(far, margin), k, left))
        heapq.heappush(queue, (max(far, -margin), k, right))


def probe(trees: list[Tree], sizes: list[np.ndarray], query: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Leaves to search, nearest first over all trees, until they hold ``wanted`` vectors."""
    found, held = [], 0
    for k, leaf in probe_order(trees, query):
        if held >= wanted:
            break
        found.append((k, leaf))
        held += int(sizes[k][leaf])
    return found


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more coordinate that makes all lengths equal, so that the largest inner product is the nearest point."""
    rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def _matrix(column, dim: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([np.empty(0), *[c.flatten().to_numpy(zero_copy_only=False) for c in chunks]])
    return flat.astype(np.float64, copy=False).reshape(-1, dim)


def _best(table: pa.Table, k: int, dim: int) -> pa.Table:
    """The best ``k`` vectors for each query of a leaf's share."""
    is_query = table.column("is_query").to_numpy().astype(bool)
    key = table.column("key").to_numpy()
    x = _matrix(table.column("x"), dim)
    queries, vectors, ids = x[is_query], x[~is_query], key[~is_query]
    asked = key[is_query]
    out_query, out_id, out_score = [], [], []
    if len(vectors):
        order = np.argsort(ids, kind="stable")
        vectors, ids = vectors[order], ids[order]
        n = min(len(ids), k)
        # A product of matrices rounds in its own way; all that may tie with the k-th are looked at exactly.
        rounding = 1e-12 * np.sqrt((queries * queries).sum(axis=1) * (vectors * vectors).sum(axis=1).max())
        for lo in range(0, len(queries), 256):
            s = queries[lo : lo + 256] @ vectors.T
            least = np.partition(s, len(ids) - n, axis=1)[:, len(ids) - n] - 2 * rounding[lo : lo + 256]
            for i in range(len(s)):
                row = np.flatnonzero(s[i] >= least[i])
                exact = (vectors[row] * queries[lo + i]).sum(axis=1)
                best = np.argsort(-exact, kind="stable")[:k]
                out_query.append(np.full(len(best), asked[lo + i]))
                out_id.append(ids[row[best]])
                out_score.append(exact[best])
    return pa.table(
        {
            "query": pa.array(np.concatenate([np.empty(0, np.int64), *out_query])),
            "key": pa.array(np.concatenate([np.empty(0, np.int64), *out_id])),
            "score": pa.array(np.concatenate([np.empty(0), *out_score])),
        }
    )


def _draw(share: float, seed: int):
    """Whether a ``key`` is drawn into a sample of this share."""
    return F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < min(1.0, share)


def true_neighbours(points: DataFrame, keys: np.ndarray, x: np.ndarray, k: int) -> DataFrame:
    """``(query, key)``: the ``k`` points of the largest inner product with each of these few points, by brute force."""
    shared = points.sparkSession.sparkContext.broadcast((keys, x))
    dim = x.shape[1]

    def best(batches):
        keys, x = shared.value
        for batch in batches:
            own = batch.column("key").to_numpy()
            scores = x @ _matrix(batch.column("x"), dim).T
            scores[keys[:, None] == own[None, :]] = -np.inf
            n = min(k, len(own))
            top = np.argpartition(-scores, n - 1, axis=1)[:, :n] if n else np.empty((len(keys), 0), np.int64)
            score = np.take_along_axis(scores, top, axis=1).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(keys, n)), pa.array(own[top.ravel()]), pa.array(score)], ["query", "key", "score"]
            )

    found = points.select("key", "x").mapInArrow(best, "query long, key long, score double").where(F.col("query") != F.col("key"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query", "key")


def budget(trees: list[Tree], sizes: list[np.ndarray], queries: dict[int, np.ndarray], places: dict[int, list], recall: float) -> int:
    """The fewest candidates per query with which ``queries`` find this share of their true neighbours, on average.

    ``places`` has, for each query, the ``(tree, leaf)`` pairs of each neighbour. A
    neighbour is found as soon as the first of its leaves is taken.
    """
    need, weight = [], []
    for query, x in queries.items():
        neighbours = places.get(query, [])
        waiting = {}
        for number, leaves in enumerate(neighbours):
            for place in leaves:
                waiting.setdefault(place, []).append(number)
        held, missing = 0, set(range(len(neighbours)))
        for tree, leaf in probe_order(trees, x):
            if not missing:
                break
            for number in missing.intersection(waiting.get((tree, leaf), ())):
                missing.remove(number)
                need.append(held + 1)
                weight.append(1 / len(neighbours))
            held += int(sizes[tree][leaf])
    if not need:
        return 0
    order = np.argsort(need, kind="stable")
    reached = np.cumsum(np.array(weight)[order])
    return int(need[order[np.searchsorted(reached, recall * reached[-1] - 1e-9)]])


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)``: vectors in double precision that have a direction, all of one dimension.

    Left out: null ids, null, empty and zero vectors, those with a null or a
    non-finite component, and those of another dimension than most (the larger of
    equally frequent ones).
    """
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL AND size(x) > 0")
    infinite = F.lit(float("inf"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite))
    rows = rows.where(sound & F.exists("x", lambda v: v != 0))
    dims = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1)
    found = dims.first()
    return rows.where(F.size("x") == (found["dim"] if found else 0))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    candidates: int = CANDIDATES,
    seed: int = SEED,
    least_recall: float = LEAST_RECALL,
    judged: int = JUDGED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each id of ``queries (vec_id)`` the ``k`` vectors of the largest inner
    product found in ``vectors (vec_id, embedding)``, without itself; ties to the smaller id.

    Equal vectors are one point, which stands for the ``k + 1`` smallest of its
    ids: no others can be among the first ``k``. The hyperplanes are fitted on a
    bounded sample of points; all points are dealt out to their leaf of each tree.
    Each query takes leaves from one priority queue over all trees until they hold
    enough vectors, and is ranked by exact products there. Enough are at least
    ``candidates``, and as many as about ``judged`` of the queries need, on
    average, to find ``least_recall`` of their neighbours, which brute force over
    all points names. If that is as many as there are points, with repetitions,
    one tree is searched whole instead, and the result is exact. Large leaves are
    dealt out in shares, so no task holds more than a bounded number of vectors
    and queries.

    See ``valid_vectors`` for what takes no part, as vector or as query. Rows of
    one vec_id and equal vectors are one; of unequal ones the result may hold
    the id twice. Fewer candidates than ``k`` give fewer rows; empty tables none.
    """
    spark = vectors.sparkSession
    sound = materialize(valid_vectors(vectors).distinct(), "vectors")
    head = sound.select(F.size("x").alias("dim")).limit(1).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if head is None:
        return spark.createDataFrame([], schema)
    dim = head["dim"]
    points = materialize(
        sound.groupBy("x").agg(F.min("vec_id").alias("key"), F.count("*").alias("copies")), "points"
    )
    # The ids of a point: the smallest ones suffice.
    single = points.where("copies = 1").select("key", F.col("key").alias("vec_id"))
    shared_points = points.where("copies > 1").select("key", "x")
    place = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    repeated = sound.join(shared_points, "x").select("key", "vec_id")
    members = single.unionByName(repeated.withColumn("place", place).where(F.col("place") <= k + 1).drop("place"))
    members = materialize(members, "members")

    stats = points.agg(F.count("*").alias("n"), F.max(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)).alias("longest")).first()
    longest = math.sqrt(stats["longest"])
    drawn = points.where(_draw(sample / stats["n"], seed)).orderBy("key").select("x").toArrow()
    fitted = _lifted(_matrix(drawn.column("x"), dim), longest)
    rng = np.random.default_rng(seed)
    forest = [grow_tree(fitted, leaf, rng) for _ in range(trees)]
    shared = spark.sparkContext.broadcast(forest)

    def place_points(batches):
        for batch in batches:
            lifted = _lifted(_matrix(batch.column("x"), dim), longest)
            leaves = [leaf_of(t, lifted) for t in shared.value]
            for number, own in enumerate(leaves):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), number, np.int32)), pa.array(own.astype(np.int32)), batch.column("key")], ["tree", "leaf", "key"]
                )

    index = materialize(points.select("key", "x").mapInArrow(place_points, "tree int, leaf int, key long"), "leaves")
    # As many rows as the sample lets the trees have leaves.
    sizes = [np.zeros(t.leaves, np.int64) for t in forest]
    counted = index.groupBy("tree", "leaf").count()
    for row in counted.collect():
        sizes[row["tree"]][row["leaf"]] = row["count"]
    shared_sizes = spark.sparkContext.broadcast(sizes)

    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    wanted = materialize(sound.join(asked, "vec_id").join(points.select("x", "key"), "x").select("vec_id", "key"), "queries")
    asked_points = wanted.select("key").distinct().count()
    query_points = points.join(wanted.select("key").distinct(), "key", "left_semi").select("key", "x")
    few = query_points.where(_draw(judged / max(1, asked_points), seed + 1)).orderBy("key").limit(4 * judged).toArrow()
    if not few.num_rows:  # of few queries the draw may take none
        few = query_points.orderBy("key").limit(judged).toArrow()
    if few.num_rows:
        keys, x = few.column("key").to_numpy(), _matrix(few.column("x"), dim)
        near = materialize(true_neighbours(points, keys, x, k), "true-neighbours")
        leaves_of: dict[tuple[int, int], list] = {}
        # Rows: judged queries x k x trees.
        for row in index.join(F.broadcast(near), "key").collect():
            leaves_of.setdefault((row["query"], row["key"]), []).append((row["tree"], row["leaf"]))
        places: dict[int, list] = {}
        for (query, _), leaves in sorted(leaves_of.items()):
            places.setdefault(query, []).append(leaves)
        flat = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        needed = budget(forest, sizes, dict(zip(keys.tolist(), flat)), places, least_recall)
    else:
        needed = 0
    whole = needed > candidates and needed >= stats["n"]
    candidates = max(candidates, needed)

    def probe_leaves(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            flat = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
            for key, q in zip(batch.column("key").to_pylist(), flat):
                found = [(0, leaf) for leaf in range(shared.value[0].leaves)] if whole else probe(shared.value, shared_sizes.value, q, candidates)
                hits = np.array(found, np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hits[:, 0]), pa.array(hits[:, 1]), pa.array(np.full(len(hits), key))], ["tree", "leaf", "key"]
                )

    cores = spark.sparkContext.defaultParallelism
    dealt_queries = query_points.repartition(cores * 4, "key")
    probes = materialize(dealt_queries.mapInArrow(probe_leaves, "tree int, leaf int, key long"), "probes")
    leaf_keys = ["tree", "leaf"]
    loads = counted.withColumnRenamed("count", "n_vectors").join(probes.groupBy(*leaf_keys).agg(F.count("*").alias("n_queries")), leaf_keys)
    shares = loads.select(
        *leaf_keys,
        F.ceil(F.col("n_vectors") / SHARE_VECTORS).cast("int").alias("v_shares"),
        F.ceil(F.col("n_queries") / SHARE_QUERIES).cast("int").alias("q_shares"),
    )
    salt = F.xxhash64("key", F.lit("share"))
    of_vectors = index.join(shares, leaf_keys).select(
        *leaf_keys,
        F.pmod(salt, F.col("v_shares")).cast("int").alias("v"),
        F.explode(F.sequence(F.lit(0), F.col("q_shares") - 1)).alias("q"),
        "key",
        F.lit(False).alias("is_query"),
    )
    of_queries = probes.join(shares, leaf_keys).select(
        *leaf_keys,
        F.explode(F.sequence(F.lit(0), F.col("v_shares") - 1)).alias("v"),
        F.pmod(salt, F.col("q_shares")).cast("int").alias("q"),
        "key",
        F.lit(True).alias("is_query"),
    )
    cells = of_vectors.unionByName(of_queries).join(points.select("key", "x"), "key").groupBy(*leaf_keys, "v", "q")
    # A point can be its query's own, so one more than k.
    found = cells.applyInArrow(of_group(_best, k=k + 1, dim=dim), "query long, key long, score double")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    first = found.distinct().withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k + 1).drop("place")
    first = materialize(first, "nearest-points")

    rows = first.join(members, "key").select("query", "vec_id", "score")
    per_query = wanted.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query")).join(rows, "query")
    per_query = per_query.where("vec_id != query_id").select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        per_query.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
