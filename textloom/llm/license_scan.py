"""License scans: known phrases, and templates found by votes of word k-grams on diagonals."""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.words import ALNUM, BASES, find_words, hash_words, inner_windows, rolling
from textloom.session import materialize

#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Sentences of the GNU licences that name them.
_GNU = (("gpl", "gnu general public license"), ("lgpl", "gnu lesser general public license"), ("lgpl", "gnu library general public license"))
_GNU += (("agpl", "gnu affero general public license"),)
_GNU_SENTENCE = (
    "you can redistribute it and or modify it under the terms of the {0} as published by the free software foundation"
)
#: Terms that Creative Commons adds to attribution, in short and in two ways at length.
_COMMONS = (
    ("by", "attribution", "attribution"),
    ("by nc", "attribution noncommercial", "attribution non commercial"),
    ("by nd", "attribution noderivatives", "attribution no derivatives"),
    ("by sa", "attribution sharealike", "attribution share alike"),
    ("by nc nd", "attribution noncommercial noderivatives", "attribution non commercial no derivatives"),
    ("by nc sa", "attribution noncommercial sharealike", "attribution non commercial share alike"),
)

#: Templates (label, text, name): usual licence notices. The words of the name, at least a gram, must stand
#: in a text one after the other; a text without a name is told by its share alone.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0", "the apache license"),
    ("apache", "you may not use this file except in compliance with the license", ""),
    *((label, f"licensed under the {name}", f"the {name}") for label, name in _GNU),
    *((label, f"this work is licensed under the {name} version 3", f"the {name}") for label, name in _GNU),
    *((label, _GNU_SENTENCE.format(name), f"the {name}") for label, name in _GNU),
    *((f"cc-{short.replace(' ', '-')}", f"licensed under cc {short}", f"under cc {short}") for short, _, _ in _COMMONS),
    *(
        (
            f"cc-{short.replace(' ', '-')}",
            f"this work is licensed under a creative commons {terms} {version} license",
            f"creative commons {terms} {version}",
        )
        for short, *ways in _COMMONS
        for terms in sorted(set(ways))
        for version in ("4 0 international", "3 0 unported", "2 5", "2 0", "1 0")
    ),
    ("cc0", "licensed under cc0 1 0", "under cc0 1"),
    ("cc0", "released under cc0 1 0", "under cc0 1"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0"),
    ("cc0", "has waived all copyright and related or neighboring rights to", ""),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "licensed under the mit license", "the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        "",
    ),
    ("bsd", "licensed under the bsd license", "under the bsd"),
    ("bsd", "released under the bsd license", "under the bsd"),
    ("bsd", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    ("bsd", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "",
    ),
    ("isc", "licensed under the isc license", "the isc license"),
    ("isc", "released under the isc license", "the isc license"),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "",
    ),
    ("mpl", "licensed under the mozilla public license", "mozilla public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "licensed under the eclipse public license", "eclipse public license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", ""),
    (
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form "
        "or as a compiled binary",
        "",
    ),
    ("unlicense", "licensed under the unlicense", "under the unlicense"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", ""),
    # The other spelling.
    ("mit", "released under the mit licence", "the mit licence"),
    ("mit", "licensed under the mit licence", "the mit licence"),
    ("apache", "licensed under the apache licence version 2 0", "the apache licence"),
    ("bsd", "licensed under the bsd licence", "under the bsd"),
    # Short identifiers in source files: the name is what follows the mark.
    *(
        (label, f"spdx license identifier {name}", f"license identifier {name}")
        for label, name in (
            ("apache", "apache 2 0"), ("mit", "mit"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("isc", "isc"),
            ("gpl", "gpl 2 0"), ("gpl", "gpl 3 0"), ("lgpl", "lgpl 2 1"), ("lgpl", "lgpl 3 0"), ("agpl", "agpl 3 0"),
            ("mpl", "mpl 2 0"), ("epl", "epl 2 0"), ("unlicense", "unlicense"), ("zlib", "zlib"), ("cc0", "cc0 1 0"),
            *((f"cc-{short.replace(' ', '-')}", f"cc {short} {version}") for short, *_ in _COMMONS for version in ("4 0", "3 0")),
        )
    ),
)

GRAM = 3
#: Neighbouring diagonals this far apart belong to one place: words were put in or left out.
DIAGONAL_GAP = 2
#: Share that a place must have: its words that are the template's, of the template's words or its own, if these are more.
LEAST_SHARE = 0.75
STEP = 500

DIGEST = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "grams array<struct<pos:long,gram:long>>"
)
DIGEST_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())),
        ("grams", pa.list_(pa.struct([("pos", pa.int64()), ("gram", pa.int64())]))),
    ]
)


def _grams_of(text: str) -> np.ndarray:
    return rolling(hash_words(find_words(pa.array([text]), ALNUM, lower=True)), GRAM, BASES[0]).view(np.int64)


def template_table(spark: SparkSession, templates) -> DataFrame:
    """``(template, label, template_words, name_at, gram, at)``: where each k-gram stands in a template, and the places of its name's."""
    rows = []
    for number, (label, text, *name) in enumerate(templates):
        n = len(find_words(pa.array([text]), ALNUM, lower=True).start)
        grams, own = _grams_of(text).tolist(), _grams_of(name[0] if name else "").tolist()
        at = next((k for k in range(len(grams)) if grams[k : k + len(own)] == own), None)
        if at is None or name and name[0] and not own:
            raise ValueError(f"the name {name[0]!r} must be {GRAM} words or more of its template")
        name_at = list(range(at, at + len(own)))
        rows += [(number, label, n, name_at, g, k) for k, g in enumerate(grams)]
    return spark.createDataFrame(rows, "template int, label string, template_words int, name_at array<int>, gram long, at int")


def _apart(spans: list[dict]) -> list[dict]:
    """The best spans that do not overlap, by place: greatest share first, then most words, then the first."""
    spans = sorted(spans, key=lambda s: (-s["share"], s["first"] - s["last"], s["first"], s["label"]))
    kept: list[tuple[int, int, int]] = []  # first, last, number; ascending
    for number, s in enumerate(spans):
        at = bisect.bisect(kept, (s["last"], math.inf))
        if not at or kept[at - 1][1] < s["first"]:
            kept.insert(at, (s["first"], s["last"], number))
    return [spans[number] for _, _, number in kept]


def _digest(ids, texts, phrases, wanted: np.ndarray) -> pa.RecordBatch:
    words = find_words(texts, ALNUM, lower=True)
    h = hash_words(words)
    at = inner_windows(words, GRAM)
    gram = rolling(h, GRAM, BASES[0]).view(np.int64)[at]
    hit = np.isin(gram, wanted)
    at, gram = at[hit], gram[hit]
    doc = words.doc
    places = []
    for number, (phrase, _) in enumerate(phrases):
        target = hash_words(find_words(pa.array([phrase]), ALNUM, lower=True))
        start = inner_windows(words, len(target))
        for k, value in enumerate(target):
            start = start[h[start + k] == value]
        places.append(np.stack([start, np.full(len(start), number)], axis=1))
    found = np.concatenate(places)
    found = found[np.argsort(found[:, 0], kind="stable")]
    gram_cut = np.searchsorted(at, words.first)
    base_cut = np.searchsorted(found[:, 0], words.first)
    rows = []
    for d in range(len(words.first) - 1):
        first = int(words.first[d])
        base = found[base_cut[d] : base_cut[d + 1]]
        own = slice(gram_cut[d], gram_cut[d + 1])
        rows.append(
            {
                "doc_id": ids[d],
                "n_words": int(words.first[d + 1]) - first,
                "n_base": len(base),
                "first_word": int(base[0, 0]) - first if len(base) else None,
                "last_word": int(base[-1, 0]) - first if len(base) else None,
                "base_labels": sorted({phrases[k][1] for k in base[:, 1].tolist()}),
                "grams": [{"pos": p - first, "gram": g} for p, g in zip(at[own].tolist(), gram[own].tolist())],
            }
        )
    return pa.RecordBatch.from_pylist(rows, schema=DIGEST_ARROW)


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, least_share: float = LEAST_SHARE) -> DataFrame:
    """Licence marks of every row of ``docs (doc_id, text)``.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels``
    (places of ``phrases``), ``spans`` (verified places of templates: label, first
    and last word, share), ``labels`` (of both) and
    ``score`` (1 where there is a phrase, else the greatest share, else 0).

    Every word k-gram of a text that stands in a template votes for the diagonal
    (place in the text - place in the template). Votes are counted by diagonal,
    diagonals at most ``DIAGONAL_GAP`` apart are one place. A place counts if it
    holds the template's name word by word and if the words that are the template's
    are at least ``least_share`` of the template's and of the place's own. Of
    places that overlap the best is kept. A phrase keeps its label wherever it
    stands, so a notice of the GNU Lesser licence has ``gpl`` by its phrase, beside
    ``lgpl``. Texts are read once and whole; only their hits are moved.

    Words are runs of letters and digits, without regard to the case of A-Z. A
    null or empty text has no words and no labels. Rows without doc_id are left
    out; each of several rows of one doc_id is scanned by itself. An empty table
    gives an empty one; other columns are not looked at.
    """
    spark = docs.sparkSession
    wanted = np.unique(np.concatenate([_grams_of(t) for _, t, *_ in templates] or [np.empty(0, np.int64)]))

    def digest(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for lo in range(0, len(ids), STEP):
                yield _digest(ids[lo : lo + STEP], batch.column("text").slice(lo, STEP), phrases, wanted)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.where("doc_id IS NOT NULL").mapInArrow(digest, DIGEST).withColumn("row", F.monotonically_increasing_id())
    found = materialize(found, "license-digests")

    hits = found.select("row", F.inline("grams"))
    # The templates are a fixed list.
    votes = hits.join(F.broadcast(template_table(spark, templates)), "gram")
    of_template = ["row", "template", "label", "template_words"]
    diagonals = votes.groupBy(*of_template, "name_at", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("at").alias("at")
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > DIAGONAL_GAP
    numbered = diagonals.withColumn("place", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(order))
    named = F.size(F.array_except("name_at", "at")) == 0
    places = numbered.groupBy(*of_template, "place").agg(
        F.min("first").alias("first"),
        (F.max("last") + GRAM - 1).alias("last"),
        F.flatten(F.collect_list("at")).alias("at"),
        F.bool_or(named).alias("named"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + GRAM - 1)))))
    own_words = F.col("last") - F.col("first") + 1
    share = (covered / F.greatest("template_words", own_words)).alias("share")
    verified = places.where("named").select("row", "label", "first", "last", share).where(F.col("share") >= least_share)
    spans = verified.groupBy("row").agg(F.collect_list(F.struct("first", "last", "label", "share")).alias("spans"))

    def apart(batches):
        for batch in batches:
            kept = pa.array([_apart(x) for x in batch.column("spans").to_pylist()], batch.schema.field("spans").type)
            yield pa.RecordBatch.from_arrays([batch.column("row"), kept], ["row", "spans"])

    spans = spans.mapInArrow(apart, spans.schema)

    both = found.drop("grams").join(spans, "row", "left")
    none = F.array().cast("array<struct<first:long,last:long,label:string,share:double>>")
    spans_column = F.coalesce("spans", none)
    labels = F.array_sort(F.array_union("base_labels", F.transform(spans_column, lambda s: s["label"])))
    best = F.coalesce(F.array_max(F.transform(spans_column, lambda s: s["share"])), F.lit(0.0))
    return both.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"),
        spans_column.alias("spans"),
    )
