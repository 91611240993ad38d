"""LM scoring: the probability of a text under all its segmentations into pieces of a given vocabulary.

A text is its words, each begun by a word mark, and an end. Pieces never reach
over a word mark, so the lattice of a text is a chain of lattices of its words,
and equal words of a block are computed once. The weight of a piece begins with
its place in the vocabulary and is then learned from the training texts: one
round of expectation over all segmentations of all their words.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import blocks as bl
from textloom.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from textloom.llm.words import BASES, BYTE_VALUES, Words, find_words, hash_words, mix
from textloom.session import materialize

#: Smoothing of the word counts.
ADDED = 0.1
#: Pseudo-counts of the vocabulary's own weights beside the learned ones.
PRIOR_COUNT = 1000.0
WORD_MARK = 0x20
STEP_WORDS = 1 << 14
#: Longer words, in bytes, are walked one by one, all their pieces being found first.
LONG_WORD = 128
#: Upper bits of a hash that lead to its place in the table of pieces.
TABLE_BITS = 20
#: Places of a long word whose pieces are walked at a time.
STEP_PLACES = 1 << 16
STEP_DOCS = 1000
BASE = BASES[0]

SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
ANSWERS = pa.schema(
    [("block", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("known", pa.int64()), ("total", pa.int64())]
)
SCORED = (
    "doc_id long, train boolean, n_words long, n_known long, log_sum double, score double, "
    "known_words long, train_words long, train_docs long"
)


class Pieces(NamedTuple):
    """A vocabulary as bytes: hashes in ascending order, the piece of each, natural log weights, and the end's.

    ``first`` has where the hashes of each value of the upper ``TABLE_BITS`` begin.
    """

    first: np.ndarray
    hash: np.ndarray
    piece: np.ndarray
    weight: np.ndarray
    longest: int
    end: float


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """The pieces of a sentencepiece model that a word can hold, as bytes, and their weights, which sum to 1.

    Scores that are log probabilities are taken as they are. A model whose
    scores only count down gives its order; there, weights fall with the place as
    words do with their rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names, scores = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        name = model.id_to_piece(i)
        raw = bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        if raw and WORD_MARK not in raw[1:]:
            names.append(raw)
            scores.append(-np.inf if model.is_byte(i) else model.get_score(i))
    value = np.array(scores)
    real = np.isfinite(value)
    if real.any() and value[real].min() < -1000:
        value[real] = -np.log(2.7 + value[real].max() - value[real])
    # The single bytes together weigh as much as the rarest piece.
    value[~real] = (value[real].min() if real.any() else 0.0) - np.log(256)
    weight: dict[bytes, float] = {}
    for name, v in zip(names, np.exp(value)):
        weight[name] = weight.get(name, 0.0) + v
    for b in range(256):  # every text has a segmentation
        weight.setdefault(bytes([b]), float(np.exp(value.min())))
    total = sum(weight.values())
    return list(weight), np.array(list(weight.values())) / total


def _piece_hash(raw: bytes) -> int:
    h = 0
    for b in raw:
        h = (h * int(BASE) + int(BYTE_VALUES[b])) & 0xFFFFFFFFFFFFFFFF
    return h


def _table(names: list[bytes], weight: np.ndarray, end: float) -> Pieces:
    h = mix(np.array([_piece_hash(n) for n in names], dtype=np.uint64) + np.array([len(n) for n in names], dtype=np.uint64))
    order = np.argsort(h)
    upper = np.arange((1 << TABLE_BITS) + 1, dtype=np.uint64) << np.uint64(64 - TABLE_BITS)
    first = np.searchsorted(h[order], upper[:-1]).astype(np.int32)
    return Pieces(np.append(first, np.int32(len(h))), h[order], order, np.log(weight)[order], max(map(len, names)), float(np.log(end)))


def _find(pieces: Pieces, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of some hashes are pieces, and the row of each of these."""
    slot = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    start = pieces.first[slot]
    stop = pieces.first[slot + 1]
    left = np.flatnonzero(stop > start)  # most slots are empty
    at, stop = start[left], stop[left]
    rows, found = [], []
    while len(left):
        hit = pieces.hash[at] == h[left]
        rows.append(left[hit])
        found.append(at[hit])
        at = at + 1
        more = ~hit & (at < stop)
        left, at, stop = left[more], at[more], stop[more]
    if len(rows) > 1:
        which = np.concatenate(rows)
        order = np.argsort(which, kind="stable")
        return which[order], np.concatenate(found)[order]
    return (rows[0], found[0]) if rows else (left, at)


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def _lattice(pieces: Pieces, raw: np.ndarray, counts: np.ndarray | None):
    """Log probability of words of one length (rows of bytes), over all segmentations.

    With ``counts`` also the expected number of each piece: rows of ``pieces``
    and their sums.
    """
    n, length = raw.shape
    values = BYTE_VALUES[raw]
    prefix = np.zeros((length + 1, n), np.uint64)
    for j in range(length):
        prefix[j + 1] = prefix[j] * BASE + values[:, j]
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(length, BASE)]), dtype=np.uint64)
    forward = np.full((length + 1, n), -np.inf)
    forward[0] = 0.0
    edges = []
    for j in range(1, length + 1):
        for size in range(1, min(j, pieces.longest) + 1):
            h = mix(prefix[j] - prefix[j - size] * power[size] + np.uint64(size))
            rows, at = _find(pieces, h)
            if not len(rows):
                continue
            forward[j, rows] = _log_add(forward[j, rows], forward[j - size, rows] + pieces.weight[at])
            if counts is not None:
                edges.append((j, size, rows, at))
    if counts is None:
        return forward[length], None
    backward = np.full((length + 1, n), -np.inf)
    backward[length] = 0.0
    expected = np.zeros(len(pieces.hash))
    for j, size, rows, at in reversed(edges):
        through = pieces.weight[at] + backward[j, rows]
        share = np.exp(forward[j - size, rows] + through - forward[length, rows])
        expected += np.bincount(at, weights=share * counts[rows], minlength=len(expected))
        backward[j - size, rows] = _log_add(backward[j - size, rows], through)
    return forward[length], expected


def _inverse(base: int) -> int:
    """The number that gives 1 with an odd base, modulo 2^64."""
    return pow(base, -1, 1 << 64)


def _pieces_within(pieces: Pieces, raw: np.ndarray):
    """Start, end and row of every piece that stands in a word, in the order of ends."""
    values = BYTE_VALUES[raw]
    length = len(raw)
    base, inverse = np.full(length + 1, BASE), np.full(length, np.uint64(_inverse(int(BASE))))
    base[0] = inverse[0] = 1
    power = np.cumprod(base, dtype=np.uint64)
    prefix = np.zeros(length + 1, np.uint64)
    prefix[1:] = np.cumsum(values * np.cumprod(inverse, dtype=np.uint64), dtype=np.uint64) * power[:-1]
    starts, ends, rows = [], [], []
    for size in range(1, min(length, pieces.longest) + 1):
        h = mix(prefix[size:] - prefix[:-size] * power[size] + np.uint64(size))
        hit, at = _find(pieces, h)
        starts.append(hit)
        ends.append(hit + size)
        rows.append(at)
    start, end, row = (np.concatenate(x) for x in (starts, ends, rows))
    order = np.argsort(end, kind="stable")
    return start[order], end[order], row[order]


def _walk(near: np.ndarray, far: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Log sums at all places of a chain: place ``far`` gets the sum at ``near`` times the weight, for ``far`` ascending.

    Sums are kept as plain numbers beside a common scale, which is lowered before
    they get too small.
    """
    out = np.full(length + 1, -np.inf)
    sums, scale = {0: 1.0}, 0.0
    out[0] = 0.0
    reach = int((far - near).max()) if len(far) else 1
    for lo in range(1, length + 1, STEP_PLACES):
        hi = min(lo + STEP_PLACES, length + 1)
        a, b = np.searchsorted(far, [lo, hi])
        own_near, own_weight = near[a:b].tolist(), weight[a:b].tolist()
        cuts = np.searchsorted(far[a:b], np.arange(lo, hi + 1)).tolist()
        found = []
        for j in range(lo, hi):
            total = 0.0
            for e in range(cuts[j - lo], cuts[j - lo + 1]):
                total += sums.get(own_near[e], 0.0) * own_weight[e]
            sums[j] = total
            sums.pop(j - reach, None)
            found.append(math.log(total) + scale if total > 0 else -math.inf)
            if 0 < total < 1e-100:
                scale += math.log(total)
                for place in sums:
                    sums[place] /= total
        out[lo:hi] = found
    return out


def _long_word(pieces: Pieces, raw: np.ndarray, count: float | None):
    """The same as ``_lattice`` for one long word: its pieces are found at all places at once, then walked."""
    length = len(raw)
    start, end, row = _pieces_within(pieces, raw)
    weight = np.exp(pieces.weight[row])
    forward = _walk(start, end, weight, length)
    if count is None:
        return forward[length], None
    # Backward is forward from the other end.
    order = np.argsort(length - start, kind="stable")
    backward = _walk((length - end)[order], (length - start)[order], weight[order], length)[::-1]
    share = np.exp(forward[start] + pieces.weight[row] + backward[end] - forward[length])
    return forward[length], np.bincount(row, weights=share * count, minlength=len(pieces.hash))


def word_scores(pieces: Pieces, words: Words, counts: np.ndarray | None = None):
    """Log probability of each word, and with ``counts`` the expected number of each piece."""
    length = (words.end - words.start).astype(np.int64)
    out = np.empty(len(length))
    expected = np.zeros(len(pieces.hash))
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order], prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
        size = int(length[order[lo]])
        if size > LONG_WORD:
            for i in order[lo:hi].tolist():
                raw = np.concatenate([np.array([WORD_MARK], np.uint8), words.buf[words.start[i] : words.end[i]]])
                out[i], part = _long_word(pieces, raw, None if counts is None else float(counts[i]))
                if part is not None:
                    expected += part
            continue
        step = max(1, STEP_WORDS * 8 // max(8, size))
        for a in range(lo, hi, step):
            own = order[a : min(a + step, hi)]
            raw = np.empty((len(own), size + 1), np.uint8)
            raw[:, 0] = WORD_MARK
            raw[:, 1:] = words.buf[words.start[own][:, None] + np.arange(size)]
            out[own], part = _lattice(pieces, raw, None if counts is None else counts[own])
            if part is not None:
                expected += part
    return out, expected


def _distinct(words: Words):
    """Hashes of distinct words in order, a place of each, and the distinct word of each word."""
    h, at, which = np.unique(hash_words(words), return_index=True, return_inverse=True)
    return h, words._replace(start=words.start[at], end=words.end[at]), which


def learn(texts: DataFrame, names: list[bytes], weight: np.ndarray) -> Pieces:
    """Piece weights from all rows of ``texts (doc_id, text, train)`` with ``train``; the driver gets a sum per piece."""
    start = _table(names, weight, 1.0)
    shared = texts.sparkSession.sparkContext.broadcast(start)

    def expect(batches):
        total = np.zeros(len(start.hash))
        docs = 0
        for batch in batches:
            docs += len(batch)
            for lo in range(0, len(batch), STEP_DOCS):
                words = find_words(batch.column("text").slice(lo, STEP_DOCS), lower=True)
                _, distinct, which = _distinct(words)
                total += word_scores(shared.value, distinct, np.bincount(which, minlength=len(distinct.start)))[1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(total[used], float(docs)))], ["piece", "expected"]
        )

    sums = texts.where("train").select("text").mapInArrow(expect, "piece long, expected double")
    found = sums.groupBy("piece").agg(F.sum("expected").alias("expected")).collect()
    counts = np.zeros(len(start.hash))
    ends = 0.0
    for row in found:
        if row["piece"] < 0:
            ends += row["expected"]
        else:
            counts[row["piece"]] = row["expected"]
    mass = counts.sum() + ends + PRIOR_COUNT
    learned = (counts + PRIOR_COUNT * 0.999 * np.exp(start.weight)) / mass
    return start._replace(weight=np.log(learned), end=float(np.log((ends + 0.001 * PRIOR_COUNT) / mass)))


def _send(table: pa.Table, buckets: int) -> pa.Table:
    """A row per bucket: the block's distinct words and how often each stands in its training texts."""
    block = table.column("block")[0].as_py()
    words = find_words(table.column("text"), lower=True)
    h, _, which = _distinct(words)
    train = table.column("train").to_numpy().astype(bool)[words.doc]
    count = np.bincount(which[train], minlength=len(h)).astype(np.uint32)
    bucket = bl.bucket_of(h, buckets)
    cuts = np.flatnonzero(bl.runs(bucket)) if len(h) else []
    rows = [
        {
            "bucket": int(bucket[lo]),
            "block": block,
            "n": int(hi - lo),
            "hashes": pack_sorted(h[lo:hi]),
            "counts": pack(count[lo:hi]),
        }
        for lo, hi in zip(cuts, [*cuts[1:], len(h)])
    ]
    return bl.table_of(rows, SENT)


def _meet(table: pa.Table) -> pa.Table:
    """Per block and bucket the training count of each word; one row of the bucket also has its totals."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    h = np.concatenate([unpack_sorted(r["hashes"], np.uint64) for r in rows])
    count = np.concatenate([unpack(r["counts"], np.uint32) for r in rows]).astype(np.int64)
    order = np.argsort(h, kind="stable")
    start = np.flatnonzero(bl.runs(h[order]))
    total = np.add.reduceat(count[order], start)
    answer = np.empty(len(h), np.uint64)
    answer[order] = np.repeat(total, np.diff(start, append=len(h))).astype(np.uint64)
    out, lo = [], 0
    for i, r in enumerate(rows):
        out.append(
            {
                "block": r["block"],
                "bucket": r["bucket"],
                "counts": pack(answer[lo : lo + r["n"]]),
                "known": int((total > 0).sum()) if i == 0 else 0,
                "total": int(total.sum()) if i == 0 else 0,
            }
        )
        lo += r["n"]
    return bl.table_of(out, ANSWERS)


def _score(texts: pa.Table, answers: pa.Table, pieces) -> pa.Table:
    """Per document the sums of the base model and its log probability; a last row has the block's totals."""
    words = find_words(texts.column("text"), lower=True)
    h, distinct, which = _distinct(words)
    parts = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
    count = np.concatenate([np.empty(0, np.uint64), *[unpack(r["counts"], np.uint64) for r in parts]]).astype(np.float64)
    value, _ = word_scores(pieces.value, distinct)
    doc, n = words.doc, len(words.first) - 1

    def per_doc(x):
        return np.bincount(doc, weights=x[which], minlength=n)

    train = texts.column("train").to_numpy().astype(bool)
    columns = {
        "doc_id": [*texts.column("doc_id").to_pylist(), None],
        "train": [*train.tolist(), None],
        "n_words": np.append(np.diff(words.first), 0),
        "n_known": np.append(per_doc((count > 0).astype(float)), 0).astype(np.int64),
        "log_sum": np.append(per_doc(np.log10(count + ADDED)), 0.0),
        "score": np.append((per_doc(value) + pieces.value.end) / np.log(10), 0.0),
        "known_words": np.append(np.zeros(n, np.int64), sum(r["known"] for r in parts)),
        "train_words": np.append(np.zeros(n, np.int64), sum(r["total"] for r in parts)),
        "train_docs": np.append(np.zeros(n, np.int64), train.sum()),
    }
    return pa.table({k: pa.array(v) for k, v in columns.items()}).cast(
        pa.schema(
            [("doc_id", pa.int64()), ("train", pa.bool_())]
            + [(c, pa.int64()) for c in ("n_words", "n_known")]
            + [(c, pa.float64()) for c in ("log_sum", "score")]
            + [(c, pa.int64()) for c in ("known_words", "train_words", "train_docs")]
        )
    )


def lm_scores(docs: DataFrame, held_out: Column, model: str, block_bytes: int = bl.BLOCK_BYTES) -> DataFrame:
    """Log probabilities of every row of ``docs (doc_id, text)``; rows for which ``held_out`` is true are not learned from.

    Returns ``doc_id, held_out, n_tokens`` (words and the end), ``n_known`` (those
    that the training texts hold), ``train_tokens``, ``base_score`` (smoothed
    word counts) and ``score`` (the lattice over the pieces of ``model``, a
    sentencepiece file that the driver reads), both as log10.

    Words are compared without regard to the case of A-Z. Counts are those of all
    training texts: each block sends its distinct words once to their buckets,
    where the counts are added up. A null or empty text is its end alone. With no
    training text the base is uniform over nothing but the smoothing, and the
    pieces keep the weights of the vocabulary. ``held_out`` may be null, which
    counts as false. Rows without doc_id are left out; an empty table gives an
    empty one.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (~F.coalesce(held_out, F.lit(False))).alias("train"),
    ).where("doc_id IS NOT NULL")
    n = bl.count_blocks(rows, block_bytes)
    pieces = docs.sparkSession.sparkContext.broadcast(learn(rows, *vocabulary(model)))
    placed = bl.by_hash(rows, n)
    sent = placed.groupBy("block").applyInArrow(
        bl.of_group(_send, buckets=n), "bucket int, block int, n int, hashes binary, counts binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(
        bl.of_group(_meet), "block int, bucket int, counts binary, known long, total long"
    )
    both = placed.groupBy("block").cogroup(answers.groupBy("block"))
    scored = materialize(both.applyInArrow(bl.of_groups(_score, pieces=pieces), SCORED), "lm-scores")
    totals = scored.where("doc_id IS NULL").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"all_{c}") for c in ("known_words", "train_words", "train_docs")]
    )
    # One row.
    result = scored.where("doc_id IS NOT NULL").crossJoin(F.broadcast(totals))
    ends = F.col("all_train_docs")
    train_tokens = F.col("all_train_words") + ends
    known = F.col("all_known_words") + (ends > 0).cast("long")
    tokens = F.col("n_words") + 1
    mass = F.log10(train_tokens + F.lit(ADDED) * (known + 1))
    return result.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        tokens.alias("n_tokens"),
        (F.col("n_known") + (ends > 0).cast("long")).alias("n_known"),
        train_tokens.alias("train_tokens"),
        (F.col("log_sum") + F.log10(ends + F.lit(ADDED)) - tokens * mass).alias("base_score"),
        "score",
    )
