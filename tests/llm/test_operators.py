"""The other operators: round trips, brute force, held-out accuracy and odd input."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import language_id, nearest, token_output, toxicity
from textloom.llm.license_scan import scan_licenses
from textloom.llm.lm_score import lm_scores
from textloom.llm.mixing import mixed, mixture
from textloom.llm.queries import tokenizer_file
from textloom.llm.token_output import Encoder, read_ids, write_ids
from textloom.llm.words import ALNUM, find_words, hash_words

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("bits", [False, True])
def test_ids_round_trip(spark, make, odd_rows, new_path, bits):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    rows = odd_rows + [(30, "a  b\n c.\n\n d"), (31, " lead"), (32, "it's 'twas a.b, c!"), (33, "x 　y\x1cz")]
    path = new_path("ids")
    write_ids(make(rows), path, tokenizer_file("byte_bpe_50k.json"), block_ids=100, segment_ids=700, bits=bits, part_bytes=20_000)
    want, start = [], 0
    for doc_id, text in sorted((i, t or "") for i, t in rows if i is not None):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        want.append((doc_id, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in read_ids(spark, path).collect()) == want


def test_encoder_beside_library():
    pieces = ["a", "B", "foo", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", ".", ",", "'s", "'", "!?", "12", "日", "\u3000", "x.", "-", "<|endoftext|>"]
    rng = random.Random(1)
    own = Encoder(tokenizer_file("byte_bpe_50k.json"))
    for _ in range(20):
        texts = ["".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(200)]
        want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert own.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in want]


def test_words_that_come_again_are_encoded_once(monkeypatch):
    """New words push out those that are not met any more, not those that every step has."""
    monkeypatch.setattr(token_output, "CACHE_WORDS", 60)
    own = Encoder(tokenizer_file("byte_bpe_50k.json"))
    library, encoded = own.tokenizer, []

    class Counting:
        def encode_batch_fast(self, pieces, **options):
            encoded.extend(word for piece in pieces for word in piece.split())
            return library.encode_batch_fast(pieces, **options)

    own.tokenizer = Counting()
    often = [f"word{chr(97 + i)}" for i in range(20)]
    for step in range(30):
        texts = [" ".join(["start", *often, *[f"new{step}x{i}" for i in range(25)], "ends."])]
        want = np.array(library.encode(texts[0], add_special_tokens=False).ids, "<u4").tobytes()
        assert own.encode(texts) == [want]
    counts = Counter(encoded)
    assert all(counts[w] == 1 for w in [*often, "start", "ends", "."])
    assert sum(map(len, own.known + own.older)) < 4 * 60 + 200


def test_pieces_of_words_are_encoded_once_and_kept_small():
    """Words that differ in their signs and lines share the ids of their pieces, and a piece takes few bytes."""
    import tracemalloc

    own = Encoder(tokenizer_file("byte_bpe_50k.json"))
    library, encoded = own.tokenizer, Counter()

    class Counting:
        def encode_batch_fast(self, pieces, **options):
            encoded.update(character for piece in pieces for character in piece)
            return library.encode_batch_fast(pieces, **options)

    own.tokenizer = Counting()
    names = [chr(97 + i) + chr(97 + k) + "érz" for i in range(26) for k in range(26)]
    texts = [" ".join(f"{a}.\n{b}," for b in names[:40]) for a in names[:40]]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want
    assert encoded["é"] <= 2 * 40
    tracemalloc.start()
    before = pa.total_allocated_bytes() + tracemalloc.get_traced_memory()[0]
    own.encode([" ".join(f"{a}{b}" for b in names) for a in names[:150]])
    after = pa.total_allocated_bytes() + tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert after - before < 100 * 150 * len(names)


def test_cuts_of_odd_texts():
    """Beside the library: signs, letters and spaces of several bytes, special tokens, empty texts."""
    pieces = [" ", " ", "\n", "\r\n", "\0", "a", "Zé", "ſ", "Ж", "×", "÷", "½", "²", "ª", "\u0301", "_", "don't", "<", "\u0130", "\u200b"]
    pieces += ["\u1680", "\u2003", "\u2028", "\u205f", "\xa0", "\x1f", "\ufeff", "🙂", "(", "\\", "]", "7", "'", "x\n <|endoftext|>", "日本"]
    rng = random.Random(2)
    own = Encoder(tokenizer_file("byte_bpe_50k.json"))
    for _ in range(20):
        texts = ["".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(300)]
        want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert own.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in want]
    assert own.encode([]) == [] and own.encode(["", ""]) == [b"", b""]


def test_no_ids(spark, make, new_path):
    path = new_path("ids")
    write_ids(make([]), path, tokenizer_file("byte_bpe_50k.json"))
    assert read_ids(spark, path).collect() == []


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.train(docs.where(~held))
    found = language_id.languages_of(docs.where(held), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred = lang").count() >= 0.98 * found.count()


def test_language_of_odd_texts(make, odd_rows):
    docs = make(odd_rows)
    model = language_id.fit(["the cat and the dog", "le chat et le chien"], ["en", "fr"])
    got = {r["doc_id"]: r for r in language_id.languages_of(docs, model).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {3, 4, 5}
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.predict(model, ["the dog", "le chien", "chiens"])[0] == ["en", "fr", "fr"]
    kept = language_id.with_language(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()}.isdisjoint({3, 4, 5, None})
    nothing = language_id.train(make([]))
    assert {r["lang_pred"] for r in language_id.languages_of(docs, nothing).collect()} == {"und"}
    assert language_id.languages_of(make([]), model).collect() == []


def test_mixture(spark, make, odd_rows):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 60), None, rng.choice(["a", "b", "é", "Z", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING")
    got = mixture(docs, leaf_docs=100, fan_in=4).collect()
    again = {r["doc_id"]: r["taken"] for r in mixture(docs.repartition(3), leaf_docs=100, fan_in=4).collect()}
    assert {r["doc_id"]: r["taken"] for r in got} == again and len(got) == 3000
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and 0 <= r["taken"] <= 2 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    order = ["Z", "a", "b", "é", None]
    weight = dict(zip(order, [3, 1, 2, 3, 1]))
    total, full = 1.5 * sum(size.values()), set()
    while True:
        rest = total - sum(2 * size[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in order if x not in full) for s in order if s not in full}
        over = {s for s in share if share[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    for s in order:
        want = 2 * size[s] if s in full else share[s]
        assert target[s] == pytest.approx(want) and abs(taken[s] - want) <= 60
    odd = mixture(make(odd_rows)).collect()
    assert sorted(r["doc_id"] for r in odd) == list(range(1, 13))
    assert {r["taken"] for r in odd if r["size"] == 0} == {0}
    assert mixture(make([])).collect() == []
    copies = mixed(docs)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r["copies"] for r in mixture(docs).collect())


def test_licences(make, odd_rows):
    rows = odd_rows + [
        (20, "Released under the MIT License. and mit-license MIT\nlicense"),
        (21, "Licensed under CC BY-NC 4.0."),
        (22, "permission is hereby granted, free of charge, to any person who obtains a copy of this software and associated documentation files"),
        (23, "license mit"),
        (24, "GNU general public licenses"),
    ]
    got = {r["doc_id"]: r for r in scan_licenses(make(rows)).collect()}
    r = got[20]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == (3, 3, 8, "mit", "mit", 1.0)
    assert (got[21]["base_labels"], got[21]["labels"], got[21]["n_base"]) == ("", "cc-by-nc", 0)
    assert got[21]["first_word"] is None and 0 < got[21]["score"] <= 1
    assert got[22]["labels"] == "mit" and got[22]["n_base"] == 0
    assert got[23]["labels"] == got[24]["labels"] == "" and got[23]["score"] == 0.0
    assert all(got[i]["n_words"] == 0 and got[i]["labels"] == "" for i in (3, 4, 5))
    assert scan_licenses(make(odd_rows)).count() == len(odd_rows) - 2
    assert scan_licenses(make([])).collect() == []


def test_licences_that_resemble_others(make):
    gnu = "you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation"
    want = {
        "Licensed under the Apache License, Version 2.0": "apache",
        "Licensed under the Mozilla Public License, Version 2.0": "mpl",
        "Licensed under the Eclipse Public License, Version 2.0": "epl",
        "Licensed under the GNU General Public License, Version 2.0": "gpl",
        "Licensed under the Foo Public License, Version 2.0": "",
        gnu.format("General Public License"): "gpl",
        gnu.format("Lesser General Public License"): "lgpl",
        gnu.format("Affero General Public License"): "agpl",
        "Licensed under CC BY 4.0": "cc-by",
        "Licensed under CC BY-ND 4.0": "cc-by-nd",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa",
        "Licensed under CC BY-NC-ND 3.0": "cc-by-nc-nd",
        "Licensed under CC BY-SA 4.0": "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
        "Licensed under CC0 1.0": "cc0",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.": "isc",
        "Licensed under the BSD 3-Clause License": "bsd",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "you may not use, sell or lend this file here except in very strict compliance with all of the license": "",
    }
    got = {r["doc_id"]: r for r in scan_licenses(make(list(enumerate(want)))).collect()}
    assert {t: ",".join(sorted({s["label"] for s in got[i]["spans"]})) for i, t in enumerate(want)} == want
    # The phrase of the GPL is in the others of its family as well, and keeps its label.
    assert got[6]["labels"] == "gpl,lgpl" and got[1]["labels"] == "mpl" and got[4]["score"] == 0.0


def test_marginals_beside_all_paths():
    rng = np.random.default_rng(1)
    model = toxicity.Model(np.empty(0, np.uint64), np.empty(0), 0.0, rng.normal(size=(2, 2)), 0.3, np.zeros(3))
    first = np.array([0, 5, 5, 6])
    e = rng.normal(size=6)
    got = toxicity.marginals(model, e, first)
    for lo, hi in zip(first, first[1:]):
        n, weight, total = hi - lo, np.zeros(hi - lo), 0.0
        for path in range(1 << n):
            tags = [path >> k & 1 for k in range(n)]
            s = sum(e[lo + k] * t for k, t in enumerate(tags)) + sum(model.move[a, b] for a, b in zip(tags, tags[1:]))
            s = math.exp(s + (model.start * tags[0] if n else 0.0))
            total += s
            weight += s * np.array(tags)
        assert got[lo:hi] == pytest.approx(weight / total)


def test_toxicity(spark, make, odd_rows):
    rng = random.Random(5)
    plain = [f"word{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(400):
        text = rng.choices(plain, k=rng.randrange(20, 80))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["badword", "nasty"]) if i % 8 else f"foulx{rng.randrange(99)}")
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    labels = spark.createDataFrame(marks + [(None, 1), (7, None)], "doc_id LONG, toxic INT")
    model = toxicity.train(make(rows).where("doc_id % 3 != 1"), labels.where("doc_id % 3 != 1"))
    got = {r["doc_id"]: r for r in toxicity.toxicity(make(rows), model).collect()}
    held = [(got[i]["score"] >= 0.7, bool(t)) for i, t in marks if i % 3 == 1]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    text = rows[4][1].split()
    spans = {k for s in got[4]["spans"] for k in range(s["first"], s["last"] + 1)}
    assert spans == {k for k, w in enumerate(text) if w in ("badword", "nasty")}
    odd = toxicity.toxicity(make(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) - 2 and all(0 <= r["score"] < 0.5 for r in odd)
    none = toxicity.train(make([]), labels.limit(0))
    assert all(0 <= r["score"] < 0.7 for r in toxicity.toxicity(make(odd_rows), none).collect())


def test_samples_hold_rare_words(make, spark):
    """Words in one of 400 toxic documents, or in two documents of a language, are learned from the usual samples."""
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(200)]
    rare = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}rare" for i in range(400)]
    rows = [(i, " ".join(rng.choices(plain, k=8) + ([rare[i % 400]] if i < 2400 else []))) for i in range(4800)]
    labels = spark.createDataFrame([(i, int(i < 2400)) for i, _ in rows], "doc_id LONG, toxic INT")
    model = toxicity.train(make(rows), labels)
    assert np.isin(hash_words(find_words(pa.array(rare), ALNUM, lower=True)), model.feature).all()
    model = language_id.train(make([(i, f"alpha beta {rare[i % 700 % 400]}") for i in range(1400)]))
    known = hash_words(language_id.letter_words(rare), language_id._letters()[2])
    assert (model.words.rows(known) >= 0).all()


def test_nearest(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(600, 8)) * rng.uniform(0.5, 2, size=(600, 1))
    v[50:90] = v[50]  # ties: equal vectors
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(3, v[3].tolist())]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [1.0] * 7 + [float("nan")]), (1004, [1.0] * 7 + [None]), (None, [1.0] * 8)]
    odd += [(1005, [1.0] * 3), (1006, [float("inf")] + [1.0] * 7)]
    table = spark.createDataFrame(rows + odd, "vec_id LONG, embedding ARRAY<DOUBLE>").withColumn("key", F.lit("clash"))
    queries = table.where("vec_id % 10 = 0")
    got = nearest.nearest(table, queries, k=5, trees=6, leaf=32, candidates=600 * 6).collect()  # all leaves: exact
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(by) == list(range(0, 600, 10))
    for q, found in by.items():
        score = (v * v[q]).sum(axis=1)
        want = [i for i in sorted(range(600), key=lambda i: (-score[i], i)) if i != q][:5]
        assert [i for i, _ in found] == want
        assert [s for _, s in found] == pytest.approx([score[i] for i in want], abs=1e-12)
    assert nearest.nearest(table.limit(0), queries, k=5).collect() == []
    assert nearest.nearest(table, queries.limit(0), k=5, trees=2).collect() == []
    assert len(nearest.nearest(table.where("vec_id < 3"), table.where("vec_id = 0"), k=5, trees=2).collect()) == 2


def test_nearest_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = nearest.nearest(table, table.where("vec_id % 100 = 0"), k=20, trees=32, leaf=64, candidates=24_000).collect()
    rows = table.collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q, near in found.items():
        score = np.where(ids == q, -9.0, v @ v[ids == q][0])
        recall.append(len(near & set(ids[np.argsort(-score)[:20]])) / 20)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("dim", [8, 48])
def test_nearest_raises_its_budget(spark, dim):
    """A budget of a small part of the table: 500 of 20,000 vectors."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=(20_000, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = nearest.nearest(table, table.where("vec_id % 100 = 0"), k=20, trees=8, sample=5000, candidates=500).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(found) == list(range(0, 20_000, 100))
    recall = []
    for q, near in found.items():
        score = v @ v[q]
        score[q] = -9.0
        recall.append(len(near & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9


def test_lm_scores(make, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 0}
    got = lm_scores(make(odd_rows), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, tokenizer_file("piece_bpe_32k.model"), 3000).collect()
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    count = Counter(w for i, ws in tokens if i not in held for w in ws)
    total, kinds = sum(count.values()), len(count)
    want = sorted(
        (i, i in held, len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws))
        for i, ws in tokens
    )
    for r, w in zip(sorted(got, key=lambda r: (r["doc_id"], r["n_tokens"])), want):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert r["base_score"] == pytest.approx(w[5]) and r["score"] < 0 and math.isfinite(r["score"])
    assert len(got) == len(want)
    assert lm_scores(make([]), F.lit(False), tokenizer_file("piece_bpe_32k.model")).collect() == []
    alone = lm_scores(make([(1, "a b")]), F.lit(True), tokenizer_file("piece_bpe_32k.model")).collect()
    assert alone[0]["train_tokens"] == 0 and alone[0]["n_known"] == 0 and math.isfinite(alone[0]["base_score"])


def test_lattice_beside_all_segmentations():
    from textloom.llm import lm_score
    from textloom.llm.words import find_words
    import pyarrow as pa

    names = [b" a", b" ab", b"b", b"ba", b"a", b" ", b"c", b"abc", b"bc"]
    weight = np.arange(1.0, len(names) + 1)
    weight /= weight.sum()
    pieces = lm_score._table(names, weight, 1.0)
    by = dict(zip(names, weight))

    def total(raw):
        return 1.0 if not raw else sum(by[raw[:k]] * total(raw[k:]) for k in range(1, len(raw) + 1) if raw[:k] in by)

    words = find_words(pa.array(["ab abc ba a cabba"]))
    got, expected = lm_score.word_scores(pieces, words, np.ones(5))
    want = [total(b" " + w) for w in (b"ab", b"abc", b"ba", b"a", b"cabba")]
    assert np.exp(got) == pytest.approx(want)
    step = 1e-6  # expected counts are the slope of the log probability along each log weight
    for at, piece in enumerate(pieces.piece):
        moved = pieces._replace(weight=pieces.weight + step * (np.arange(len(names)) == at))
        slope = (lm_score.word_scores(moved, words)[0].sum() - got.sum()) / step
        assert expected[at] == pytest.approx(slope, abs=1e-4), names[piece]
