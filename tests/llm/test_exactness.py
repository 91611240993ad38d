"""Kept probabilities of the mix, equal neighbours, and words of any length."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import lm_score, mixing
from textloom.llm.nearest import nearest
from textloom.llm.queries import tokenizer_file
from textloom.llm.words import find_words


@pytest.mark.parametrize("sizes", [[100.0] + [1.0] * 60, [float(int(np.exp(x))) + 1 for x in np.random.default_rng(1).normal(3, 1.5, 60)]])
@pytest.mark.parametrize("share", [0.2, 0.5, 0.93])
def test_rounding_keeps_every_probability(sizes, share):
    """Over some thousand draws each document is taken as often as its probability says."""
    draws = 4000
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    size = [sizes[i] for i in order]
    taken = np.zeros(len(size))
    for seed in range(draws):
        rng = np.random.default_rng([6, seed])
        p = [share] * len(size)
        mixing._pivotal(p, size, rng)
        assert abs(np.dot(p, size) - share * sum(size)) < 1e-6 * sum(size)
        left = [i for i, x in enumerate(p) if 0 < x < 1]
        assert len(left) <= 1
        for i in left:
            p[i] = float(rng.random() < p[i])
        taken += p
    error = np.sqrt(share * (1 - share) / draws)
    assert np.abs(taken / draws - share).max() < 4.5 * error


def test_mixture_keeps_probabilities_over_seeds(spark):
    """Through all levels of the tree: means of whole mixtures under many seeds."""
    rows = [(i, "w " * (1 + (i * 7) % 23), "s") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").coalesce(1)
    seeds, total = 6, 0
    for seed in range(seeds):
        got = {r["doc_id"]: r for r in mixing.mixture(docs, seed=seed, leaf_docs=8, fan_in=2).collect()}
        words = sum(r["taken"] for r in got.values())
        assert abs(words - got[0]["target"]) < max(r["size"] for r in got.values())
        assert all(r["copies"] in (1, 2) for r in got.values())
        total += sum(r["copies"] - 1 for r in got.values())
    assert abs(total / (seeds * 30) - 0.5) < 0.15


def test_equal_products_go_to_the_smaller_ids(spark):
    rng = np.random.default_rng(5)
    same = [(i, [1.0, float(i), 0.0, 0.0]) for i in range(400)]  # all have the product 1 with the query
    rest = [(400 + i, [*(rng.normal(size=4) * 0.1).tolist()]) for i in range(200)]
    query = (1000, [1.0, 0.0, 0.0, 0.0])
    vectors = spark.createDataFrame([*same, *rest, query], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = nearest(vectors, vectors.where("vec_id = 1000"), k=20, leaf=64).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == list(range(20)) and {r["score"] for r in found} == {1.0}


@pytest.fixture(scope="module")
def pieces():
    names, weight = lm_score.vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return lm_score._table(names, weight, 1.0)


def test_long_words_have_the_same_probability(pieces, monkeypatch):
    texts = ["the quick " + "brownfox" * 40, "漢字かな交じり文" * 30, "x" * 500 + " aé" * 3, "ab" * 64, "ab" * 65]
    words = find_words(pa.array(texts), lower=True)
    counts = np.arange(1.0, len(words.start) + 1)
    monkeypatch.setattr(lm_score, "LONG_WORD", 10**9)
    want, expected = lm_score.word_scores(pieces, words, counts)
    monkeypatch.setattr(lm_score, "LONG_WORD", 3)
    for places in (1 << 16, 7):
        monkeypatch.setattr(lm_score, "STEP_PLACES", places)
        got, found = lm_score.word_scores(pieces, words, counts)
        assert np.allclose(got, want, rtol=1e-11, atol=1e-9)
        assert np.allclose(found, expected, rtol=1e-8, atol=1e-9)


def test_a_word_of_a_megabyte_takes_seconds(pieces):
    rng = np.random.default_rng(3)
    text = "".join(chr(c) for c in rng.integers(97, 123, 1_000_000))
    start = time.perf_counter()
    value, expected = lm_score.word_scores(pieces, find_words(pa.array([text]), lower=True), np.ones(1))
    assert np.isfinite(value).all() and value[0] < -1e5
    assert abs(sum(expected * [len(p) for p in _bytes(pieces)]) - 1_000_001) < 1  # all bytes are in pieces
    assert time.perf_counter() - start < 60


def _bytes(pieces):
    names = lm_score.vocabulary(tokenizer_file("piece_bpe_32k.model"))[0]
    return [names[i] for i in pieces.piece]


def test_short_benchmark_items_are_found(spark):
    from textloom.llm.decontaminate import contained_items

    docs = spark.createDataFrame(
        [(1, "Who wrote, Faust?"), (2, "who wrote it"), (3, "so it is: answer forty two, maybe"), (4, None), (5, ""), (6, "FORTY-TWO")],
        "doc_id BIGINT, text STRING",
    )
    items = [(10, "who wrote faust"), (11, "Forty two"), (12, ""), (13, None), (14, "one two three four five"), (15, "..."), (11, "forty TWO")]
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = sorted(tuple(r) for r in contained_items(docs, benchmark).collect())
    assert got == [(1, 10, 1, 1), (3, 11, 1, 1), (6, 11, 1, 1)]
