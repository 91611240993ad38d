"""Language ID: known words by their frequency in each language, unknown ones by ever shorter character n-grams."""

from __future__ import annotations

import sys
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.blocks import runs
from textloom.llm.words import BASES, Words, hash_words, mix, rolling, words_in

#: The model is fitted on about so many labelled documents per language, chosen by a hash of their id.
TRAIN_DOCS = 1500
#: Words kept per language, and n-grams per language and length.
MODEL_WORDS = 30_000
MODEL_GRAMS = 20_000
#: A word is known from this many occurrences.
LEAST_COUNT = 2
LONGEST_GRAM = 4
SMOOTHING = 0.5

UNKNOWN = "und"
STEP_CHARS = 1 << 20


@cache
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, its lower case (if one code point), and a hash value."""
    n = sys.maxunicode + 1
    letter = np.zeros(n, dtype=bool)
    lower = np.arange(n, dtype=np.uint32)
    for c in range(n):
        ch = chr(c)
        if ch.isalpha():
            letter[c] = True
            low = ch.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return letter, lower, mix(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def letter_words(texts: list[str | None]) -> Words:
    """Runs of letters, in lower case; the buffer holds code points."""
    letter, lower, _ = _letters()
    texts = [t or "" for t in texts]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    buf = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return words_in(lower[buf], at, letter)


def _grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word of every ``n`` characters inside a word."""
    values = _letters()[2]
    length = (words.end - words.start).astype(np.int64)
    has = np.maximum(length - n + 1, 0)
    word = np.repeat(np.arange(len(length)), has)
    within = np.arange(len(word)) - np.repeat(np.cumsum(has) - has, has)
    h = rolling(values[words.buf], n, BASES[0] + np.uint64(2 * n))
    return (h[words.start[word] + within] if len(word) else np.empty(0, np.uint64)), word


class Table(NamedTuple):
    """Log probabilities by language of what a sorted hash stands for."""

    hash: np.ndarray
    scores: np.ndarray

    def rows(self, h: np.ndarray) -> np.ndarray:
        """The row of each hash; -1 if unknown."""
        if not len(self.hash):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[at] == h, at, -1)


class Model(NamedTuple):
    languages: list[str]
    words: Table
    grams: list[Table]  # of length 1, 2, ...


def _counted(h: np.ndarray, lang: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of hash and language, with their counts added up."""
    order = np.lexsort((lang, h))
    h, lang = h[order], lang[order]
    start = np.flatnonzero(runs(h, lang)) if len(h) else np.empty(0, np.int64)
    return h[start], lang[start], np.add.reduceat(count[order], start) if len(start) else count[:0]


class Counts:
    """Counts by hash and language, added step by step."""

    def __init__(self):
        self.held = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))

    def add(self, h: np.ndarray, lang: np.ndarray) -> None:
        new = _counted(h, lang, np.ones(len(h), np.int64))
        self.held = _counted(*[np.concatenate(pair) for pair in zip(self.held, new)])


def _table(counts: Counts, n_lang: int, most: int, least: int) -> Table:
    h, lang, count = counts.held
    total = np.bincount(lang, weights=count, minlength=n_lang)
    keep = np.zeros(len(h), dtype=bool)
    for k in range(n_lang):  # the most frequent of each language, ties to the smaller hash
        own = np.flatnonzero((lang == k) & (count >= least))
        keep[own[np.argsort(-count[own], kind="stable")[:most]]] = True
    values = np.unique(h[keep])
    at = np.searchsorted(values, h)
    known = (at < len(values)) & (values[np.minimum(at, max(len(values) - 1, 0))] == h) if len(values) else np.zeros(len(h), bool)
    counts = np.zeros((len(values), n_lang))
    counts[at[known], lang[known]] = count[known]
    scores = np.log(counts + SMOOTHING) - np.log(total + SMOOTHING * (len(values) + 1))
    return Table(values, scores)


def fit(texts: list[str], langs: list[str], words: int = MODEL_WORDS, grams: int = MODEL_GRAMS) -> Model:
    """The model of labelled texts."""
    names = sorted(set(langs))
    code = np.array([names.index(x) for x in langs], dtype=np.int64)
    of_words, of_grams = Counts(), [Counts() for _ in range(LONGEST_GRAM)]
    for lo, hi in _steps(texts):
        w = letter_words(texts[lo:hi])
        lang = code[lo:hi][w.doc]
        of_words.add(hash_words(w, _letters()[2]), lang)
        for n in range(1, LONGEST_GRAM + 1):
            h, word = _grams(w, n)
            of_grams[n - 1].add(h, lang[word])
    n = len(names)
    return Model(names, _table(of_words, n, words, LEAST_COUNT), [_table(c, n, grams, 1) for c in of_grams])


def _steps(texts):
    """Ranges of texts of a few million characters."""
    lo = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= STEP_CHARS:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its probability among the learned ones."""
    n_lang = len(model.languages)
    w = letter_words(texts)
    n_words = np.diff(w.first)
    if not n_lang:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    row = model.words.rows(hash_words(w, _letters()[2]))
    scores = np.zeros((len(row), n_lang))
    known = row >= 0
    scores[known] = model.words.scores[row[known]]
    open_words = np.flatnonzero(~known)
    for n in range(LONGEST_GRAM, 0, -1):
        if not len(open_words):
            break
        part = w._replace(start=w.start[open_words], end=w.end[open_words])
        h, word = _grams(part, n)
        found = model.grams[n - 1].rows(h)
        use = found >= 0
        count = np.bincount(word[use], minlength=len(open_words))
        for k in range(n_lang):
            total = np.bincount(word[use], weights=model.grams[n - 1].scores[found[use], k], minlength=len(open_words))
            scores[open_words, k] = np.divide(total, count, out=np.zeros(len(count)), where=count > 0)
        open_words = open_words[count == 0]
    doc = w.doc
    total = np.stack([np.bincount(doc, weights=scores[:, k], minlength=len(texts)) for k in range(n_lang)], axis=1)
    best = np.argmax(total, axis=1)
    odds = np.exp(total - total.max(axis=1, keepdims=True))
    score = odds.max(axis=1) / odds.sum(axis=1)
    lang = [model.languages[b] if n else UNKNOWN for b, n in zip(best, n_words)]
    return lang, np.where(n_words > 0, score, 0.0)


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Fit a model on a bounded sample of the labelled rows of ``docs (doc_id, text, lang)``.

    The sample takes ``train_docs`` documents per language on average, by a hash
    of their id; a language of fewer is taken whole. Only the sample reaches the
    driver.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return fit([], [])
    share: Column = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(train_docs / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(draw < share).orderBy("doc_id").select("text", "lang").toArrow()
    return fit(sample.column("text").to_pylist(), sample.column("lang").to_pylist())


def languages_of(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row of ``docs (doc_id, text)``.

    A word that the model knows is scored by its log frequency in each language,
    another by the average of its known n-grams of the greatest length of which
    there are any. ``score`` is the probability of the language among the learned
    ones. Texts that are null, empty or without letters are ``und`` with score 0,
    as are all if nothing was learned. Ties go to the first language. Rows
    without doc_id are left out; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _steps(texts):
                lang, value = predict(shared.value, texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(lang, pa.string()), pa.array(value)],
                    ["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where("doc_id IS NOT NULL").mapInArrow(score, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, model: Model, least_score: float = 0.5) -> DataFrame:
    """``docs`` without the rows that are rejected: no letters, no doc_id, or no language of at least ``least_score``.

    All columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        values = [t if isinstance(t, str) else None for t in texts]
        keep = np.zeros(len(values), dtype=bool)
        for lo, hi in _steps(values):
            lang, score = predict(shared.value, values[lo:hi])
            keep[lo:hi] = (np.array(lang, dtype=object) != UNKNOWN) & (score >= least_score)
        return pd.Series(keep)

    return docs.where(F.col("doc_id").isNotNull()).where(accepted(F.col("text").cast("string")))
