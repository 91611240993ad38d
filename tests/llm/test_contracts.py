"""The registered queries without SQL beside brute force over whole tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from textloom.llm.queries import QUERIES, tokenizer_file

FOLDER = "/root/testdata/sf0.001"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rows_of(spark, name):
    found = QUERIES[name](spark, FOLDER).collect()
    rows = {r["doc_id"]: r for r in found}
    assert len(rows) == len(found)
    return rows


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_token_output(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    got, start = rows_of(spark, "op3_token_output"), 0
    assert set(got) == set(docs)
    for i in sorted(docs):
        ids = tokenizer.encode(docs[i]["text"] or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_language(spark, docs):
    got = rows_of(spark, "op5_language_id")
    assert set(got) == set(docs)
    learned = {r["lang"] for i, r in docs.items() if remainder(i, 4) != 2 and r["lang"] is not None and r["text"] is not None}
    for i, r in got.items():
        letters = any(c.isalpha() for c in docs[i]["text"] or "")
        assert r["held_out"] == (remainder(i, 4) == 2) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in learned if letters else r["lang_pred"] == "und"
    held = [i for i, r in got.items() if r["held_out"] and r["lang_pred"] != "und" and docs[i]["lang"] is not None]
    assert sum(got[i]["lang_pred"] == docs[i]["lang"] for i in held) >= 0.95 * len(held)


def test_mixing(spark, docs):
    got = rows_of(spark, "op6_source_mixing")
    assert set(got) == set(docs)
    size, taken, target, longest = Counter(), Counter(), {}, Counter()
    for i, r in got.items():
        source, words = docs[i]["source"], len(re.findall(r"[^\x20\x09-\x0D]+", docs[i]["text"] or ""))
        assert r["size"] == words and 0 <= r["taken"] <= 2 * words
        size[source] += words
        taken[source] += r["taken"]
        target[source] = r["target"]
        longest[source] = max(longest[source], words)
    assert all(r["source_size"] == size[docs[i]["source"]] for i, r in got.items())
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want, rest, open_ = {}, 1.5 * sum(size.values()), list(order)
    while over := [s for s in open_ if rest * weight[s] / sum(weight[x] for x in open_) > 2 * size[s]]:
        want |= {s: 2.0 * size[s] for s in over}
        rest -= sum(2 * size[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    want |= {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
    for s in order:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= longest[s]


def test_licences(spark, docs):
    got = rows_of(spark, "op7_license_scan")
    assert set(got) == set(docs)
    for i, r in got.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(docs[i]["text"]))
        places = [(k, label) for p, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        at, labels = [k for k, _ in places], {label for _, label in places}
        want = (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        all_labels = [x for x in r["labels"].split(",") if x]
        assert all_labels == sorted(set(all_labels)) and labels <= set(all_labels) and 0 <= r["score"] <= 1


def test_toxicity(spark, docs):
    got = rows_of(spark, "op8_toxicity")
    assert set(got) == set(docs)
    assert all(r["held_out"] == (remainder(i, 3) == 1) and 0 <= r["score"] <= 1 for i, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_lm_score(spark, docs):
    got = rows_of(spark, "op10_lm_score")
    assert set(got) == set(docs)
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lowered(r["text"])), None] for i, r in docs.items()}
    count = Counter(w for i, words in tokens.items() if remainder(i, 10) for w in words)
    total, kinds = sum(count.values()), len(count)
    for i, r in got.items():
        known = sum(count[w] > 0 for w in tokens[i])
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens[i])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (remainder(i, 10) == 0, len(tokens[i]), known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0


def test_nearest(spark):
    got = {}
    for r in QUERIES["op9_nearest_neighbours"](spark, FOLDER).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    sound = [r for r in rows if r["embedding"] and None not in r["embedding"] and np.isfinite(r["embedding"]).all() and any(r["embedding"])]
    ids, v = np.array([r["vec_id"] for r in sound]), np.array([r["embedding"] for r in sound], dtype=np.float64)
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = total = 0
    for q, found in got.items():
        exact = (v * v[ids == q][0]).sum(axis=1)
        best = [i for i in np.lexsort((ids, -exact)) if ids[i] != q][:20]
        assert sorted(found) == list(range(1, len(best) + 1))
        by = dict(zip(ids.tolist(), exact))
        order = [found[k] for k in sorted(found)]
        assert all(score == pytest.approx(by[i], abs=1e-12) for i, score in order)
        assert order == sorted(order, key=lambda x: (-x[1], x[0]))
        hits += len({i for i, _ in order} & set(ids[best].tolist()))
        total += len(best)
    assert hits >= 0.9 * total
