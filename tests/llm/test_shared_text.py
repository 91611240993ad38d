"""Substring dedup, n-gram join and decontamination beside brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from textloom.llm.decontaminate import contained_items, decontaminated
from textloom.llm.ngram_join import ngram_components, representatives
from textloom.llm.substring_dedup import remove_repeated


def words(text, lower=False):
    raw = (text or "").encode()
    return [w.decode() for w in (raw.lower() if lower else raw).split()]


def removed(rows, width):
    rows = [(i, words(t)) for i, t in rows if i is not None]
    low: dict[tuple, int] = {}
    for i, w in rows:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            low[key] = min(low.get(key, i), i)
    out = []
    for i, w in rows:
        gone = {k + d for k in range(len(w) - width + 1) if low[tuple(w[k : k + width])] < i for d in range(width)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def noisy(seed, n):
    """Copies of a few texts with random edits, and shared passages."""
    rng = random.Random(seed)
    base = [[f"v{rng.randrange(400)}" for _ in range(rng.randrange(20, 90))] for _ in range(5)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"n{rng.randrange(10_000)}"
        if rng.random() < 0.3:
            text += base[0][:20]
        rows.append((rng.randrange(10 * n), " ".join(text)))
    return rows


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_repeated_windows(make, odd_rows, block_bytes):
    for rows, width in ((odd_rows, 13), (noisy(1, 40), 5)):
        got = remove_repeated(make(rows), width, block_bytes).collect()
        assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == removed(rows, width)
        for r in got:  # intervals are maximal and add up
            spans = [(s["first"], s["last"]) for s in r["removed"]]
            assert sum(b - a + 1 for a, b in spans) == r["n_removed"]
            assert all(x[1] + 1 < y[0] for x, y in zip(spans, spans[1:]))


def components(rows, width=5, percent=80):
    sets = []
    for i, t in rows:
        if i is not None:
            w = words(t, lower=True)
            grams = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
            sets.append((i, grams))
    up = {i: i for i, _ in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return sorted((i, len(g), find(i)) for i, g in sets)


@pytest.mark.parametrize("tree_sets", [2, 2000])
def test_components(make, odd_rows, tree_sets):
    for rows in (odd_rows, noisy(2, 60)):
        got = ngram_components(make(rows), block_bytes=2000, tree_sets=tree_sets).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == components(rows)


def test_one_of_each_group_stays(make, odd_rows):
    docs = make(odd_rows)
    stay = representatives(docs)
    assert stay.columns == docs.columns
    groups = {c for _, _, c in components(odd_rows)}
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(groups)


def test_contained_items(spark, make, odd_rows):
    item = "The quick, brown fox jumps over the lazy dog and then runs away from it"
    rows = odd_rows + [
        (20, "aa bb " * 3000 + item.upper().replace(",", " ") + " cc dd" * 2000),
        (21, "start " + item.replace("lazy", "tired") + " end"),  # loses 5 of 10 shingles
        (22, "start " + item.replace("from it", "from us") + " end"),  # loses 1
        (20, "aa bb " * 3000 + item.upper().replace(",", " ") + " cc dd" * 2000),
    ]
    items = spark.createDataFrame([(1, item), (1, item), (2, "too short"), (3, None), (None, item), (4, "")], "item_id INT, text STRING")
    for pass_items in (1, 100):
        got = contained_items(make(rows), items, pass_items=pass_items).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(20, 1), (22, 1)]
    left = decontaminated(make(rows), items)
    assert left.columns == make(rows).columns
    assert left.count() == len(rows) - 3


@pytest.mark.parametrize("operator", [remove_repeated, ngram_components, representatives])
def test_empty_tables(make, operator):
    assert operator(make([])).collect() == []
    assert operator(make([(None, "a b c")])).collect() == []


def test_empty_benchmark(spark, make, odd_rows):
    none = spark.createDataFrame([], "item_id LONG, text STRING")
    assert contained_items(make(odd_rows), none).collect() == []
    assert contained_items(make([]), none).collect() == []


def test_kept_text_digest(spark):
    from textloom.llm.queries import QUERIES

    rows = QUERIES["op1_substring_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert all(len(r["kept_sha256"]) == 64 for r in rows)
    assert {r["kept_sha256"] for r in rows if r["n_removed"] == r["n_words"]} <= {hashlib.sha256(b"").hexdigest()}
