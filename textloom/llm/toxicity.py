"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals make the score of a text."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.blocks import runs
from textloom.llm.words import ALNUM, Words, find_words, hash_words, mix

#: The model is fitted on about so many documents of each label, chosen by a hash of their id.
TRAIN_DOCS = 2500
#: Lengths (in bytes) of word beginnings that are features, besides whole words.
PREFIXES = (4, 5, 6, 7)
#: A sign of toxic text stands in at least so many toxic documents that lack other signs, and so few clean ones.
LEAST_DOCS = 4
MOST_CLEAN = 0.02
#: A toxic document is explained by so many different signs.
SIGNS = 6
#: Features of the field besides the signs: the words that most often stand in clean documents.
PLAIN_FEATURES = 1000
#: Words of the pieces that the field is trained on.
PIECE = 64
ROUNDS = 60
SPAN_PROBABILITY = 0.5
STEP_BYTES = 8 << 20

SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("probability", pa.float64())]))
RESULT = "doc_id long, score double, spans array<struct<first:long,last:long,probability:double>>"


class Model(NamedTuple):
    """Weights of the two tags (0 plain, 1 toxic) and of the document score."""

    feature: np.ndarray  # hashes, ascending
    weight: np.ndarray  # of tag 1 against tag 0
    bias: float
    move: np.ndarray  # 2 x 2 transition weights
    start: float  # weight of tag 1 at the first word
    document: np.ndarray  # intercept, of the greatest marginal's log odds, of the log of the expected toxic words


def _features(words: Words) -> list[np.ndarray]:
    """Hashes per word: of the word, and of its beginnings if it is longer."""
    length = words.end - words.start
    out = [hash_words(words)]
    for n in PREFIXES:
        h = mix(hash_words(words.prefixes(n)) + np.uint64(n))
        out.append(np.where(length > n, h, np.uint64(0)))
    return out


def _lookup(model_feature: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(model_feature):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(model_feature, h), len(model_feature) - 1)
    return np.where(model_feature[at] == h, at, -1)


def _emissions(model: Model, words: Words) -> np.ndarray:
    """Log weight of tag 1 against tag 0 per word."""
    total = np.full(len(words.start), model.bias)
    for h in _features(words):
        at = _lookup(model.feature, h)
        hit = at >= 0
        total[hit] += model.weight[at[hit]]
    return total


def marginals(model: Model, emission: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of tag 1 at every word, by forward and backward passes over all sequences at once.

    Both passes keep probabilities, scaled to a sum of 1 at each word, so no
    length of text overflows. Step ``t`` handles the ``t``-th word of all
    sequences that are that long.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    e = np.exp(np.clip(emission, -50, 50))
    t = np.exp(model.move)
    forward, backward = np.empty(len(e)), np.empty(len(e))
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
    p = np.empty(0)
    for k in range(longest):
        at = start[: active[k]] + k
        if k == 0:
            one, zero = np.exp(model.start) * e[at], 1.0
        else:
            p = p[: active[k]]
            one = (p * t[1, 1] + (1 - p) * t[0, 1]) * e[at]
            zero = p * t[1, 0] + (1 - p) * t[0, 0]
        p = one / (one + zero)
        forward[at] = p
    b = np.empty(0)
    for k in range(longest - 1, -1, -1):
        at = start[: active[k]] + k
        own = np.full(len(at), 0.5)  # the last word of a sequence
        if len(b):
            nxt = e[at[: len(b)] + 1]
            one = t[1, 1] * nxt * b + t[1, 0] * (1 - b)
            zero = t[0, 1] * nxt * b + t[0, 0] * (1 - b)
            own[: len(b)] = one / (one + zero)
        backward[at] = own
        b = own
    one, zero = forward * backward, (1 - forward) * (1 - backward)
    return one / np.maximum(one + zero, 1e-300)


def _pair_marginals(model: Model, emission: np.ndarray, first: np.ndarray, tag: np.ndarray):
    """Expected tags and expected transitions (2 x 2) of all sequences."""
    m = marginals(model, emission, first)
    inner = np.ones(len(m), dtype=bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    right = np.flatnonzero(inner)
    # P(a, b) from P(b | a): needs what follows the right word; it is in its marginal over its forward value.
    t, e = np.exp(model.move), np.exp(np.clip(emission, -50, 50))
    fwd, bwd = _passes(model, e, t, first)
    pair = np.empty((2, 2, len(right)))
    for a in (0, 1):
        fa = fwd[right - 1] if a else 1 - fwd[right - 1]
        for b in (0, 1):
            pair[a, b] = fa * t[a, b] * (e[right] * bwd[right] if b else 1 - bwd[right])
    pair /= pair.sum(axis=(0, 1))
    return m, pair.sum(axis=2), right


def _passes(model: Model, e: np.ndarray, t: np.ndarray, first: np.ndarray):
    """Forward and backward values of sequences of equal length at most, as columns."""
    length = np.diff(first)
    longest = int(length.max()) if len(length) else 0
    fwd, bwd = np.empty(len(e)), np.full(len(e), 0.5)
    for k in range(longest):
        at = first[:-1][length > k] + k
        if k == 0:
            one, zero = np.exp(model.start) * e[at], 1.0
        else:
            p = fwd[at - 1]
            one, zero = (p * t[1, 1] + (1 - p) * t[0, 1]) * e[at], p * t[1, 0] + (1 - p) * t[0, 0]
        fwd[at] = one / (one + zero)
    for k in range(longest - 2, -1, -1):
        at = first[:-1][length > k + 1] + k
        nxt, b = e[at + 1], bwd[at + 1]
        one, zero = t[1, 1] * nxt * b + t[1, 0] * (1 - b), t[0, 1] * nxt * b + t[0, 0] * (1 - b)
        bwd[at] = one / (one + zero)
    return fwd, bwd


def _signs(hashes: list[np.ndarray], doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Features that mark toxic documents, chosen one after the other.

    A feature counts the toxic documents it stands in that are not yet explained
    by ``SIGNS`` others; so what only copies of one document share is no sign
    once that document is explained. Longer beginnings win ties.
    """
    parts = []
    for number, own in enumerate(hashes):
        order = np.lexsort((doc, own))
        order = order[runs(own[order], doc[order]) & (own[order] != 0)] if len(own) else order
        parts.append((own[order], doc[order], np.full(len(order), number, np.int8)))
    h, d, kind = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(h, kind="stable")
    h, d, kind = h[order], d[order], kind[order]
    start = np.flatnonzero(runs(h)) if len(h) else np.empty(0, np.int64)
    if not len(start):
        return np.empty(0, np.uint64)
    n_toxic = np.add.reduceat(toxic[d].astype(np.int64), start)
    n_clean = np.add.reduceat((~toxic[d]).astype(np.int64), start)
    stop = np.append(start[1:], len(h))
    rate = max(1.0, (~toxic).sum() / max(1, toxic.sum()))
    good = np.flatnonzero((n_toxic >= LEAST_DOCS) & (n_clean <= MOST_CLEAN * rate * n_toxic))
    specificity = np.where(kind[start] == 0, 100, kind[start])
    good = good[np.lexsort((-specificity[good], -n_toxic[good]))]
    open_signs = np.where(toxic, SIGNS, 0)
    chosen = []
    for f in good.tolist():  # most documents first; of those already explained it counts none
        own = d[start[f] : stop[f]]
        own = own[open_signs[own] > 0]
        if len(own) >= LEAST_DOCS:
            chosen.append(h[start[f]])
            open_signs[own] -= 1
    return np.array(chosen, dtype=np.uint64)


def fit(texts: list[str], labels: list[int], prior: float | None = None) -> Model:
    """The model of labelled texts; ``prior`` is the share of toxic documents where the scores are used."""
    toxic = np.array(labels, dtype=bool)
    empty = Model(np.empty(0, np.uint64), np.empty(0), 0.0, np.zeros((2, 2)), 0.0, np.array([-3.0, 0.0, 0.0]))
    if not len(texts) or toxic.all() or not toxic.any():
        level = 4.0 if len(texts) and toxic.all() else -4.0
        return empty._replace(bias=level, document=np.array([level, 0.0, 0.0]))
    words = find_words(pa.array(texts, pa.string()), ALNUM, lower=True)
    doc = words.doc
    hashes = _features(words)
    signs = np.sort(_signs(hashes, doc, toxic))
    is_sign = np.zeros(len(doc), dtype=bool)
    for h in hashes:
        is_sign |= _lookup(signs, h) >= 0
    tag = is_sign & toxic[doc]
    plain, count = np.unique(hashes[0][~toxic[doc]], return_counts=True)
    plain = plain[np.argsort(-count, kind="stable")[:PLAIN_FEATURES]]
    feature = np.unique(np.concatenate([signs, plain]))

    # Pieces of equal length, in texts; all words of all texts are in one.
    length = np.diff(words.first)
    pieces = -(-length // PIECE)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.append(np.repeat(words.first[:-1], pieces) + number * PIECE, len(doc))
    rows, columns = [], []
    for h in hashes:
        at = _lookup(feature, h)
        hit = np.flatnonzero(at >= 0)
        rows.append(hit)
        columns.append(at[hit])
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    n = max(1, len(doc))
    inner = np.ones(len(doc), dtype=bool)
    inner[first[:-1]] = False
    right = np.flatnonzero(inner)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (tag[right - 1].astype(int), tag[right].astype(int)), 1)
    seen_feature = np.bincount(columns, weights=tag[rows], minlength=len(feature))
    seen_tag, seen_first = tag.sum(), tag[first[:-1]].sum()

    # Adam on the penalised log likelihood: observed less expected counts.
    sizes = (len(feature), 1, 4, 1)
    theta = np.zeros(sum(sizes))
    theta[sizes[0]] = -4.0
    speed, power = np.zeros_like(theta), np.zeros_like(theta)
    cut = np.cumsum(sizes)
    model = empty
    for step in range(1, ROUNDS + 1):
        model = Model(feature, theta[: cut[0]], float(theta[cut[0]]), theta[cut[1] : cut[2]].reshape(2, 2), float(theta[cut[2]]), empty.document)
        emission = np.full(len(doc), model.bias)
        emission += np.bincount(rows, weights=model.weight[columns], minlength=len(doc))
        m, pairs, _ = _pair_marginals(model, emission, first, tag)
        gradient = np.concatenate(
            [
                seen_feature - np.bincount(columns, weights=m[rows], minlength=len(feature)),
                [seen_tag - m.sum()],
                (seen_pairs - pairs).ravel(),
                [seen_first - m[first[:-1]].sum()],
            ]
        )
        gradient = gradient / np.sqrt(n) - 0.002 * theta
        speed = 0.9 * speed + 0.1 * gradient
        power = 0.99 * power + 0.01 * gradient**2
        theta = theta + 0.3 * (speed / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-8)
    x = _document_features(marginals(model, _emissions(model, words), words.first), words.first)
    share = toxic.mean() if prior is None else prior
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    return model._replace(document=_logistic(x, toxic, weight))


def _document_features(m: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: 1, log odds of the greatest marginal, log of the expected number of toxic words."""
    n = len(first) - 1
    has = np.diff(first) > 0
    top, total = np.zeros(n), np.zeros(n)
    if has.any():
        top[has] = np.maximum.reduceat(m, first[:-1][has])
        likely = np.where(m >= 0.05, m, 0.0)  # what thousands of plain words add up to is no sign
        total[has] = np.add.reduceat(likely, first[:-1][has])
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(n), np.log(top / (1 - top)), np.log1p(total)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, slightly penalised."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - 0.1 * w
        curvature = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(curvature, gradient)
    return w


def predict(model: Model, texts) -> tuple[np.ndarray, np.ndarray, Words]:
    """Score of each text, marginal of each word, and the words."""
    words = find_words(texts, ALNUM, lower=True)
    m = marginals(model, _emissions(model, words), words.first)
    x = _document_features(m, words.first)
    return 1 / (1 + np.exp(-np.clip(x @ model.document, -30, 30))), m, words


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on a bounded sample of the rows of ``docs (doc_id, text)`` that ``labels (doc_id, toxic)`` covers.

    About ``train_docs`` documents of each label are taken, by a hash of their
    id; only these reach the driver. A document with labels that differ counts as
    toxic.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not counts:
        return fit([], [])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.when(F.col("toxic") == 1, train_docs / counts.get(1, 1)).otherwise(train_docs / counts.get(0, 1))
    drawn = marks.where(draw < share)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The drawn ids are bounded by the parameter.
    sample = rows.join(F.broadcast(drawn), "doc_id").where("text IS NOT NULL").orderBy("doc_id", "text").toArrow()
    total = sum(counts.values())
    prior = min(max(counts.get(1, 0) / total, 1e-3), 1 - 1e-3)
    return fit(sample.column("text").to_pylist(), sample.column("toxic").to_pylist(), prior)


def _steps(texts: pa.Array):
    lo = held = 0
    for i, n in enumerate(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()):
        held += n
        if held >= STEP_BYTES:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, spans)`` per row of ``docs (doc_id, text)``.

    ``spans`` are runs of words (positions from 0) whose marginal probability of
    the toxic tag is at least ``SPAN_PROBABILITY``, with the greatest of these.
    ``score`` is the probability of the label, from the greatest marginal and the
    expected number of toxic words. The field runs over whole texts.

    A null or empty text gets the score of a text without toxic words. Rows
    without doc_id are left out; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for lo, hi in _steps(batch.column("text")):
                value, m, words = predict(shared.value, batch.column("text").slice(lo, hi - lo))
                hot = m >= SPAN_PROBABILITY
                begins = np.zeros(len(m) + 1, dtype=bool)
                begins[words.first] = True
                before = np.concatenate([[False], hot[:-1]])
                after = np.concatenate([hot[1:], [False]])
                first = np.flatnonzero(hot & (~before | begins[:-1]))
                last = np.flatnonzero(hot & (~after | begins[1:]))
                base = words.first[words.doc[first]]
                top = [float(m[a : b + 1].max()) for a, b in zip(first, last)]
                spans = pa.StructArray.from_arrays(
                    [pa.array(first - base), pa.array(last - base), pa.array(top, pa.float64())], ["first", "last", "probability"]
                )
                cut = pa.array(np.searchsorted(first, words.first).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(value), pa.ListArray.from_arrays(cut, spans).cast(SPANS)],
                    ["doc_id", "score", "spans"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where("doc_id IS NOT NULL").mapInArrow(score, RESULT)
