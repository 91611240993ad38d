import math
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from textloom.operators import clustering, similar
from textloom.operators import postings as ops
from textloom.plans.index import build_index


def test_cosines_of_the_micro_collection(index):
    found = {(r["target"], r["doc_id"]): r["similarity"] for r in similar.similarities(index, [0, 3], "tf").collect()}
    assert found[(0, 1)] == pytest.approx(1 / math.sqrt(10))
    assert found[(0, 2)] == 0.0 and found[(0, 3)] == 0.0
    assert found[(0, 0)] == 1.0
    # A document without words is similar to nothing, itself included.
    assert [found[(3, d)] for d in range(4)] == [0.0] * 4


@pytest.mark.parametrize("rep", ["bin", "tf", "tfidf"])
def test_cosines_equal_brute_force(spark, new_path, rep):
    rng = random.Random(3)
    texts = {d: rng.choices("abcdefgh", k=rng.randint(1, 20)) for d in range(30)}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id BIGINT, text STRING")
    index = build_index(ops.stack_fields(docs, ["text"]), new_path("cosine"))

    def vector(words):
        df = {t: sum(t in w for w in texts.values()) for t in set(words)}
        weight = {"bin": lambda t: 1, "tf": words.count, "tfidf": lambda t: words.count(t) * 30 / df[t]}[rep]
        return {t: weight(t) for t in set(words)}

    vectors = {d: vector(w) for d, w in texts.items()}

    def cosine(a, b):
        dot = sum(a[t] * b.get(t, 0) for t in a)
        return dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    for r in similar.similarities(index, [4, 9], rep).collect():
        assert r["similarity"] == pytest.approx(cosine(vectors[r["target"]], vectors[r["doc_id"]]), abs=1e-8)
        assert 0 <= r["similarity"] <= 1


def test_most_similar_come_first(index):
    best = similar.similar_docs(index, [0], "tf", 2).orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"]) for r in best] == [(1, 0), (2, 1)]


def test_large_target_side_gives_the_same(index, monkeypatch):
    expected = sorted(similar.similarities(index, [0], "tfidf").collect())
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 0)
    assert sorted(similar.similarities(index, [0], "tfidf").collect()) == expected


@pytest.fixture(scope="module")
def points(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [10.0, 0.0]), (3, [11.0, 0.0]), (4, [5.5, 0.0])]
    return spark.createDataFrame(rows, "id BIGINT, x ARRAY<DOUBLE>")


def test_bounds_are_per_dimension(spark):
    points = spark.createDataFrame([(0, [5.0, -1.0]), (1, [7.0, 3.0])], "id BIGINT, x ARRAY<DOUBLE>")
    assert clustering.feature_bounds(points) == ([5.0, -1.0], [7.0, 3.0])
    with pytest.raises(ValueError):
        clustering.feature_bounds(points.limit(0))


def test_start_is_inside_the_bounds_and_repeatable():
    bounds = ([0.0, -5.0], [4.0, 5.0])
    assert clustering.init_centroids(bounds, 2) == [[1.0, -2.5], [3.0, 2.5]]
    seeded = clustering.init_centroids(bounds, 5, seed=1)
    assert seeded == clustering.init_centroids(bounds, 5, seed=1)
    assert all(0 <= x <= 4 and -5 <= y <= 5 for x, y in seeded)


def test_first_of_equally_near_centroids_wins(points):
    assigned = {r["id"]: r["cluster"] for r in clustering.assign(points, [[0.5, 0.0], [10.5, 0.0]]).collect()}
    assert assigned == {0: 0, 1: 0, 2: 1, 3: 1, 4: 0}


def test_empty_cluster_keeps_its_centroid(points):
    start = [[0.0, 0.0], [10.0, 0.0], [0.0, 1000.0]]
    assigned, centroids = clustering.kmeans(points, start)
    assert centroids[2] == [0.0, 1000.0]
    assert assigned.where("cluster = 2").count() == 0
    # The point 5.5 is nearer to 10 than to 0.
    assert centroids[:2] == [[0.5, 0.0], [pytest.approx((10 + 11 + 5.5) / 3), 0.0]]


def test_squared_cost_does_not_rise(spark):
    rng = random.Random(9)
    rows = [(i, [rng.random(), rng.random()]) for i in range(100)]
    points = spark.createDataFrame(rows, "id BIGINT, x ARRAY<DOUBLE>")
    centroids = clustering.init_centroids(clustering.feature_bounds(points), 4, seed=2)
    costs = []
    for _ in range(5):
        assigned = clustering.assign(points, centroids)
        costs.append(sum(r["distance"] ** 2 for r in assigned.collect()))
        centroids = clustering.update_centroids(assigned, centroids)
    assert all(later <= earlier + 1e-9 for earlier, later in zip(costs, costs[1:]))


def test_cost_and_report(points):
    assigned, centroids = clustering.kmeans(points, [[0.0, 0.0], [10.0, 0.0]])
    distances = [r["distance"] for r in assigned.collect()]
    assert clustering.clustering_cost(assigned).first()["cost"] == pytest.approx(sum(distances))
    report = clustering.cluster_report(assigned, centroids).collect()
    assert [(r["cluster"], r["id"]) for r in report] == [(0, 0), (0, 1), (1, 2), (1, 3), (1, 4)]
    assert report[-1]["centroid"] == centroids[1] == [pytest.approx((10 + 11 + 5.5) / 3), 0.0]


def test_many_rounds_run_to_the_end_or_raise(spark):
    # A chain of points that the centroids cross one by one.
    points = spark.createDataFrame([(i, [float(1.3**i)]) for i in range(40)], "id BIGINT, x ARRAY<DOUBLE>")
    start = [[0.0], [1.0], [2.0]]
    assigned, centroids = clustering.kmeans(points, start)
    again = clustering.update_centroids(points, centroids)
    assert [c[0] for c in again] == pytest.approx([c[0] for c in centroids], abs=1e-9)
    with pytest.raises(RuntimeError, match="still move"):
        clustering.kmeans(points, start, max_rounds=1)
    assert len(clustering.init_centroids(([0.0] * 60_000, [1.0] * 60_000), 2)) == 2


@pytest.mark.parametrize("block_terms", [2_000_000, 40])
def test_many_targets_equal_single_ones(spark, new_path, monkeypatch, block_terms):
    monkeypatch.setattr(similar, "BLOCK_TERMS", block_terms)
    rng = random.Random(4)
    rows = [(d, " ".join(["the"] * rng.randint(0, 3) + rng.choices([f"w{i}" for i in range(30)], k=rng.randint(0, 12)))) for d in range(60)]
    rows += [(60, ""), (61, "alone"), (62, rows[5][1])]
    index = build_index(ops.stack_fields(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), ["text"]), new_path("many"))
    ids = [0, 5, 7, 60, 61, 62]
    targets = spark.createDataFrame([(i,) for i in [*ids, 5, 999]], "doc_id BIGINT")
    for rep in ("tf", "tfidf"):
        want = sorted(map(tuple, similar.similar_docs(index, ids, rep, 6).collect()))
        got = sorted(map(tuple, similar.similar_docs_many(index, targets, rep, 6).select("target", "rank", "doc_id", "similarity").collect()))
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-8)
    assert similar.similar_docs_many(index, targets.limit(0), "tf", 6).collect() == []


def test_similarity_that_rounds_to_zero_gives_way_to_smaller_ids(spark, new_path):
    rows = [(d, f"other{d}") for d in range(4)] + [(90, "the " + "x " * 50_000), (91, "the " + "y " * 50_000)]
    index = build_index(ops.stack_fields(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), ["text"]), new_path("zero"))
    targets = spark.createDataFrame([(90,)], "doc_id BIGINT")
    got = [tuple(r) for r in similar.similar_docs_many(index, targets, "tf", 2).orderBy("rank").collect()]
    assert got == [(90, 1, 90, 1.0), (90, 2, 0, 0.0)] == sorted(map(tuple, similar.similar_docs(index, [90], "tf", 2).collect()))


@pytest.mark.parametrize("columns", [0, 12, 400])
@pytest.mark.parametrize("many", [0.0, 0.125, 2.0])
@pytest.mark.parametrize("rare_weight", [1.0, 50.0])
def test_blocks_of_targets_find_what_brute_force_finds(monkeypatch, columns, many, rare_weight):
    monkeypatch.setattr(similar, "MANY_SHARE", many)
    monkeypatch.setattr(similar, "STEP_DOCS", 37)
    monkeypatch.setattr(similar, "PIECE", 200)
    monkeypatch.setattr(similar, "MATRIX_TARGETS", 5)
    rng, docs, terms, n = np.random.default_rng(3), 200, 400, 4
    chance = 1 / np.arange(1, terms + 1)
    dense = (rng.random((docs, terms)) < chance) * rng.integers(1, 4, (docs, terms)) * np.where(np.arange(terms) < 12, 1.0, rare_weight)
    dense[50:60] = dense[40]  # copies tie
    dense[70, 5:] = 0
    dense[:, 0] += dense.sum(axis=1) == 0
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    lists = [np.flatnonzero(row) for row in dense]
    # The first term of a vector comes twice, with half its weight each time.
    entries = [(np.append(at, at[0]), np.concatenate([[row[at[0]] / 2], row[at[1:]], [row[at[0]] / 2]])) for at, row in zip(lists, dense)]
    ids = np.arange(docs) * 3
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([t for t, _ in entries]), pa.array([w for _, w in entries])], ["doc_id", "terms", "weights"])
    wanted = [2, 40, 55, 59, 70, 71, 150, 199]
    asked = similar.arrange_targets([batch.take(pa.array(wanted))], columns)
    shared = SimpleNamespace(value=asked)
    (out,) = similar._nearest(shared, n)(iter([batch.slice(0, 130), batch.slice(130)]))
    got = sorted(zip(*(out[c].to_pylist() for c in ("query_id", "doc_id", "score"))))
    want = []
    for t in wanted:
        score = np.round(dense @ dense[t], 9)
        best = [d for d in np.lexsort((ids, -score))[:n] if score[d] > 0]
        want += [(3 * t, 3 * d, score[d]) for d in best]
    want.sort()
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], abs=2e-9)


def test_pairs_out_of_reach_are_not_summed_up(monkeypatch):
    """Common words of small weight alone do not make a pair worth adding up."""
    rng, docs = np.random.default_rng(5), 400
    terms = [np.concatenate([np.arange(20), 20 + rng.integers(0, 200, 6)]) for _ in range(docs)]
    weights = np.concatenate([np.full(20, 0.01), np.full(6, 0.4)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(docs)), pa.array(terms), pa.array([weights] * docs)], ["doc_id", "terms", "weights"])
    asked = similar.arrange_targets([batch.slice(0, 50)], 20)
    least = np.full(50, 0.3)
    target, _, total = similar._near(asked, 5, least, *similar._flat(batch)[1:])
    assert len(target) < 50 * docs / 20 and (total >= 0.3 - 1e-8).all()
    assert set(range(50)) == set(target.tolist())  # each finds itself


def test_a_document_of_common_words_does_not_bring_the_others_in_reach(monkeypatch):
    """What common words can add is told for each pair and group of terms."""
    rng, docs, columns = np.random.default_rng(6), 120, 64
    monkeypatch.setattr(similar, "GROUPS", 8)
    own = [np.append(rng.integers(0, columns, 5), columns + rng.integers(0, 150, 6)) for _ in range(docs)]
    weights = [np.append(np.full(5, 0.05), np.full(6, 0.4)) for _ in range(docs)]
    # One has nothing but common words, of the first group; another one those of the last.
    own[0], own[1] = np.arange(8), np.arange(columns - 8, columns)
    weights[0] = weights[1] = np.full(8, 8**-0.5)
    batch = pa.RecordBatch.from_arrays([pa.array(range(docs)), pa.array(own), pa.array(weights)], ["doc_id", "terms", "weights"])
    asked = similar.arrange_targets([batch], columns)
    assert asked.norms.shape == (docs, 8) and asked.norms[0, 1:].sum() == 0 == asked.norms[1, :-1].sum()
    dense = np.zeros((docs, columns + 150))
    for row, at, w in zip(dense, own, weights):
        np.add.at(row, at, w)
    calls, expand = [], similar._expand
    monkeypatch.setattr(similar, "_expand", lambda first, count: calls.append(len(count)) or expand(first, count))
    target, doc, total = similar._near(asked, 5, np.full(docs, 0.3), *similar._flat(batch)[1:])
    whole = dense @ dense.T
    assert sorted(zip(target.tolist(), doc.tolist())) == sorted(zip(*(a.tolist() for a in np.nonzero(whole >= 0.3 - similar.MARGIN))))
    assert total == pytest.approx(whole[target, doc])
    # Pairs that were added up one by one, and targets that met all documents.
    assert sum(calls) < 0.1 * docs * docs


def test_ragged_and_missing_points_are_errors(spark):
    whole = [(0, [1.0, 2.0]), (1, [3.0, 4.0])]
    for bad in ([(2, [1.0, 2.0, 3.0]), (3, [1.0])], [(2, None)], [(2, [1.0, None])], [(2, [])]):
        points = spark.createDataFrame(whole + bad, "id BIGINT, x ARRAY<DOUBLE>").coalesce(1)
        for step in (clustering.feature_bounds, lambda p: clustering.assign(p, [[0.0, 0.0]]).collect(), lambda p: clustering.update_centroids(p, [[0.0, 0.0]])):
            with pytest.raises(Exception, match="coordinate"):
                step(points)


def test_large_coordinates_come_to_an_end(spark):
    rows = [(i, [1e12 + 0.1 * i, 0.3 * i]) for i in range(50)]
    points = spark.createDataFrame(rows, "id BIGINT, x ARRAY<DOUBLE>").repartition(5)
    _, centroids = clustering.kmeans(points, clustering.init_centroids(clustering.feature_bounds(points), 3), max_rounds=60)
    assert len(centroids) == 3
