import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import evaluation, ranking
from textloom.operators import postings as ops
from textloom.plans import sweep as plans
from textloom.plans.index import build_index

TEXTS = {0: "red red blue", 1: "blue green", 2: "green green green", 3: ""}


def brute_force(texts, query, model, lam):
    words = {d: t.split() for d, t in texts.items()}
    total = sum(len(w) for w in words.values())
    n_docs = sum(1 for w in words.values() if w)
    scores = {}
    for term, qtf in Counter(query.split()).items():
        cf = sum(w.count(term) for w in words.values())
        df = sum(1 for w in words.values() if term in w)
        for d, w in words.items():
            tf = w.count(term)
            if tf == 0:
                continue
            if model == "jm":
                part = math.log(1 + ((1 - lam) * tf / len(w)) / (lam * (cf + 1) / (total + 1)))
            else:
                part = math.sqrt(tf) * (1 + math.log((n_docs + 1) / (df + 1))) ** 2 / math.sqrt(len(w))
            scores[d] = scores.get(d, 0.0) + qtf * part
    return sorted(((d, round(s, 9)) for d, s in scores.items()), key=lambda p: (-p[1], p[0]))


@pytest.mark.parametrize("model", ["jm", "classic"])
def test_scores_equal_brute_force(spark, new_path, model):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "d", "e", "f", "g"]
    texts = {d: " ".join(rng.choices(vocabulary, weights=[9, 5, 3, 2, 1, 1, 1], k=rng.randint(0, 30))) for d in range(60)}
    asked = {q: " ".join(rng.choices([*vocabulary, "zzz"], k=4)) for q in range(8)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    index = build_index(ops.stack_fields(docs, ["text"]), new_path("brute"))
    queries = spark.createDataFrame(list(asked.items()), "query_id BIGINT, text STRING")
    run = ranking.search(index, queries, model, 10, lam=0.3).collect()
    for q, text in asked.items():
        got = [(r["doc_id"], r["score"]) for r in sorted(run, key=lambda r: r["rank"]) if r["query_id"] == q]
        want = brute_force(texts, text, model, 0.3)[:10]
        assert [d for d, _ in got] == [d for d, _ in want]
        assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-8)


def test_duplicate_query_words_count_each_time(spark, index):
    queries = spark.createDataFrame([(1, "blue"), (2, "blue (Blue)")], "query_id BIGINT, text STRING")
    run = {(r["query_id"], r["doc_id"]): r["score"] for r in ranking.search(index, queries, "jm", 5).collect()}
    assert run[(2, 0)] == pytest.approx(2 * run[(1, 0)], abs=1e-8)


def test_ranking_of_the_micro_collection(index, queries):
    run = ranking.search(index, queries, "jm", 10, lam=0.1).collect()
    order = {q: [r["doc_id"] for r in sorted(run, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (1, 2, 3)}
    assert order == {1: [0, 1], 2: [], 3: [2, 1]}


def test_large_query_side_gives_the_same_ranking(index, queries, monkeypatch):
    expected = ranking.search(index, queries, "jm", 10).collect()
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 0)
    assert sorted(ranking.search(index, queries, "jm", 10).collect()) == sorted(expected)


def test_arguments_are_checked(index, queries):
    for bad in ({"model": "bm25"}, {"model": "jm", "lam": 0.0}, {"model": "jm", "lam": 1.5}, {"model": "jm", "k": 0}):
        with pytest.raises(ValueError):
            ranking.search(index, queries, **{"k": 5, **bad})


def test_select_queries(queries):
    def chosen(spec):
        return sorted(r["query_id"] for r in ranking.select_queries(queries, spec).collect())

    assert chosen("all") == [1, 2, 3]
    assert chosen("2") == [2]
    assert chosen("2-3") == chosen("3-2") == [2, 3]


def metrics_at(index, queries, qrels, cut, **options):
    run = ranking.search(index, queries, "jm", 10, lam=0.1)
    found = evaluation.per_query_metrics(run, qrels, queries, cut, **options).collect()
    return {r["query_id"]: tuple(r[m] for m in evaluation.METRICS) for r in found}


def test_metrics_of_the_micro_collection(index, queries, qrels):
    assert metrics_at(index, queries, qrels, 2) == {1: (0.5, 0.5, 0.5, 0.5), 2: (0, 0, 0, 0), 3: (0.5, 0.5, 1.0, 0.5)}
    assert metrics_at(index, queries, qrels, 10)[1] == (0.1, 0.5, 0.5, 0.5)


def test_judgement_listed_twice_counts_once(index, queries, qrels):
    assert metrics_at(index, queries, qrels.unionAll(qrels), 2) == metrics_at(index, queries, qrels, 2)


def test_residual_documents_are_no_hits_but_stay_judged(spark, index, queries, qrels):
    residual = spark.createDataFrame([(3, 1)], "query_id BIGINT, doc_id BIGINT")
    assert metrics_at(index, queries, qrels, 2, residual=residual)[3] == (0, 0, 0, 0)


def test_recall_does_not_fall_with_the_cut(index, queries, qrels):
    recalls = [metrics_at(index, queries, qrels, cut) for cut in (1, 2, 3, 10)]
    for q in (1, 2, 3):
        values = [r[q][2] for r in recalls]
        assert values == sorted(values)


def test_means_are_over_all_queries(index, queries, qrels):
    run = ranking.search(index, queries, "jm", 10, lam=0.1)
    means = evaluation.mean_metrics(evaluation.per_query_metrics(run, qrels, queries, 2)).first()
    assert means["n_queries"] == 3
    assert means["mean_average_precision"] == pytest.approx(1 / 3)


def test_report_marks_relevance(index, queries, qrels, docs):
    run = ranking.search(index, queries, "jm", 10, lam=0.1)
    report = evaluation.relevance_report(ranking.with_document(run, docs, "text"), qrels).collect()
    marked = {(r["query_id"], r["doc_id"]): (r["relevant"], r["text"]) for r in report}
    assert marked[(1, 0)] == ("yes", TEXTS[0]) and marked[(1, 1)] == ("no", TEXTS[1])


def test_grid_has_nine_values():
    assert plans.lambda_grid() == [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def test_sweep_equals_single_searches(index, queries, qrels):
    swept = plans.sweep(index, queries, qrels, 2).collect()
    assert len(swept) == 9 * 3
    for lam in (0.2, 0.9):
        run = ranking.search(index, queries, "jm", 2, lam=lam)
        single = {r["query_id"]: r["average_precision"] for r in evaluation.per_query_metrics(run, qrels, queries, 2).collect()}
        assert {r["query_id"]: r["average_precision"] for r in swept if r["lam"] == lam} == single


@pytest.mark.parametrize("batch_rows", [1, 3, 500_000])
def test_cutting_batches_early_does_not_change_a_ranking(index, queries, monkeypatch, batch_rows):
    monkeypatch.setattr(ranking, "BATCH_ROWS", batch_rows)
    runs = plans.sweep_runs(index, queries, 1, [0.3, 0.6])
    for lam in (0.3, 0.6):
        one = ranking.search(index, queries, "jm", 1, lam=lam)
        assert sorted(runs.where(F.col("lam") == lam).drop("lam").collect()) == sorted(one.collect())


def test_ranking_in_shares_is_the_same(index, queries, monkeypatch):
    expected = sorted(ranking.search(index, queries, "jm", 1).collect())
    monkeypatch.setattr(ranking, "RANK_ROWS", 2)
    assert ranking.parts_for(index, 1) > 1
    assert sorted(ranking.search(index, queries, "jm", 1).collect()) == expected


def test_long_lists_of_askers_are_split(spark, index, monkeypatch):
    rows = [(q, "green blue") for q in range(50)]
    queries = spark.createDataFrame(rows, "query_id BIGINT, text STRING")
    expected = sorted(ranking.search(index, queries, "jm", 2).collect())
    monkeypatch.setattr(ranking, "QUERY_BLOCK", 7)
    assert sorted(ranking.search(index, queries, "jm", 2).collect()) == expected
    assert len(expected) == 100


def test_equal_means_keep_the_smaller_lambda(spark):
    means = spark.createDataFrame([(0.5, 0.25), (0.3, 0.5), (0.4, 0.5)], "lam DOUBLE, mean_value DOUBLE")
    assert plans.best_lambda(means).first()["lam"] == 0.3


def test_train_and_test(index, queries, qrels):
    train, test = ranking.select_queries(queries, "1-2"), ranking.select_queries(queries, "3")
    lam, values = plans.train_test(index, train, test, qrels, "MAP", 2)
    assert lam == 0.1 and [tuple(r) for r in values.collect()] == [(3, 0.5)]
    lam, values = plans.train_test(index, train, test, qrels, "P", 2, model="classic")
    assert lam is None and values.first()["value"] == 0.5
    with pytest.raises(ValueError):
        plans.train_test(index, train, test, qrels, "F1", 2)


def test_split_covers_both_ranges(queries):
    parts = {r["query_id"]: r["part"] for r in plans.split_queries(queries, "1-2", "3-9").collect()}
    assert parts == {1: "train", 2: "train", 3: "test"}


def test_judgements_equal_search_in_every_text(spark):
    from textloom.registry.base import containing_documents

    needle = "the quick brown Fox jumps"
    docs = spark.createDataFrame(
        [(0, f"xx{needle.upper()}yy"), (1, "the quick brown fox"), (2, f"a {needle}\nb"), (3, "the quick brown foxy fox jumps")],
        "doc_id BIGINT, text STRING",
    )
    queries = spark.createDataFrame([(7, needle)], "query_id BIGINT, text STRING")
    assert sorted(map(tuple, containing_documents(docs, queries).collect())) == [(7, 0), (7, 2)]


def test_judgements_of_short_queries(spark):
    from textloom.registry.base import containing_documents

    docs = spark.createDataFrame(
        [(0, "a Three word query here"), (1, "three word"), (2, "athree word queryb"), (3, ""), (4, None)], "doc_id BIGINT, text STRING"
    )
    rows = [(1, "three word query"), (2, "Three word"), (3, "word"), (4, "a three word query here"), (5, ""), (6, None)]
    queries = spark.createDataFrame(rows, "query_id BIGINT, text STRING")
    got = sorted(map(tuple, containing_documents(docs, queries).collect()))
    texts = {r["doc_id"]: (r["text"] or "").lower() for r in docs.collect()}
    assert got == sorted((q, d) for q, n in rows if n for d, t in texts.items() if n.lower() in t)
    assert containing_documents(docs, queries.where("query_id > 4")).collect() == []


def test_query_selection_is_strict(queries):
    from textloom.operators.ranking import select_queries

    assert [r["query_id"] for r in select_queries(queries, "2").collect()] == [2]
    assert sorted(r["query_id"] for r in select_queries(queries, "3-2").collect()) == [2, 3]
    for spec in ("1-2-9", "-5", "", "a"):
        with pytest.raises(ValueError, match="query selection"):
            select_queries(queries, spec)


def test_words_keep_combining_marks(spark):
    from textloom.functions import text as tx

    rows = spark.createDataFrame([("हिन्दी में",), ("cafe\u0301 x",)], "text STRING")
    assert [r["w"] for r in rows.select(tx.words("text").alias("w")).collect()] == [["हिन्दी", "में"], ["cafe\u0301", "x"]]


@pytest.mark.parametrize("model", ["jm", "classic"])
def test_few_pairs_are_left_for_the_ranking(spark, new_path, model):
    """A stop word in every text and query: nearly all pairs match, few can be among the best."""
    rng = random.Random(11)
    texts = {d: " ".join(["the"] * rng.randint(1, 9) + rng.choices([f"w{i}" for i in range(60)], k=rng.randint(1, 40))) for d in range(400)}
    asked = {q: f"the the w{q} w{q + 20} w{(7 * q) % 60}" for q in range(20)}
    index = build_index(ops.stack_fields(spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING"), ["text"]), new_path("stop"))
    queries = spark.createDataFrame(list(asked.items()), "query_id BIGINT, text STRING")
    run = ranking.search(index, queries, model, 5, lam=0.3).collect()
    for q, text in asked.items():
        got = [(r["doc_id"], r["score"]) for r in sorted(run, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert got == [(d, pytest.approx(s, abs=1e-8)) for d, s in brute_force(texts, text, model, 0.3)[:5]]
    left = ranking.scored_pairs(index, queries, [ranking.contribution_of(model, 0.3)], 5, "text").count()
    assert 20 * 5 <= left < 20 * 400 / 10


def test_words_are_dealt_out_by_their_bounds():
    import numpy as np

    query, term = np.array([0, 0, 0, 0]), np.array([10, 11, 12, 13])
    bounds = np.array([[1.0, 2.0, 4.0, 8.0]])
    asked = ranking.arrange(np.array([5]), query, term, np.ones(4), bounds, np.array([[6.0]]))
    # 1 alone cannot make up 0.3 * 6; 1 + 2 stay below 6, with 4 they would not.
    assert [e[1].size for e in asked.entries] == [2, 1, 1]
    assert [r[0, 0] for r in asked.rest] == [3.0, 1.0, 0.0]
    every = ranking.arrange(np.array([5]), query, term, np.ones(4), bounds)
    assert [e[1].size for e in every.entries] == [4] and every.least[0, 0] == -np.inf


def test_fewer_documents_than_asked_for_and_none(spark, index):
    queries = spark.createDataFrame([(1, "green"), (2, None), (3, "")], "query_id BIGINT, text STRING")
    assert [(r["query_id"], r["doc_id"]) for r in ranking.search(index, queries, "jm", 50).orderBy("rank").collect()] == [(1, 2), (1, 1)]
    assert ranking.search(index, queries.limit(0), "jm", 5).collect() == []
    assert ranking.search(index, queries, "jm", 50, lam=1.0).count() == 2  # all scores are 0: found all the same
