"""Benchmark decontamination: short test items inside long documents."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.blocks import runs, texts_of
from textloom.llm.words import ALNUM, BASES, find_words, hash_words, inner_windows, rolling

SHINGLE = 5
PERCENT = 80
#: Items that are searched for in one pass; more take as many passes as needed.
PASS_ITEMS = 20_000
#: Text looked at in one step, in documents.
STEP = 500

PAIRS = "doc_id long, item_id long, n_item long, n_shared long"


class Items(NamedTuple):
    """Test items in classes of size; ``sketch`` holds (hash, item) sorted by hash."""

    ids: np.ndarray
    size: np.ndarray
    shingles: list[np.ndarray]
    sketch: np.ndarray
    sketch_item: np.ndarray


def _distinct(texts, width: int):
    """Distinct shingles by text, and the number of texts."""
    words = find_words(texts, ALNUM, lower=True)
    at = inner_windows(words, width)
    shingle = rolling(hash_words(words), width, BASES[0])[at]
    doc = words.doc[at]
    order = np.lexsort((shingle, doc))
    new = runs(shingle[order], doc[order])
    return doc[order][new], shingle[order][new], len(words.first) - 1


def sketch_length(size: int, percent: int) -> int:
    """MinHash values that an item of this size class needs.

    Of any ``size - need + 1`` shingles of an item at least one stands in every
    text that contains ``need`` of them. The class of an item is its size rounded
    up to a power of two, so the sketch of a class suffices for all in it.
    """
    top = 1 << math.ceil(math.log2(size)) if size > 1 else 1
    return min(size, top - -(-percent * top // 100) + 1 + (top != size))


def _items(rows: list, width: int, percent: int) -> Items:
    doc, shingle, n = _distinct(pa.array([r["text"] for r in rows], pa.string()), width)
    sets = np.split(shingle, np.cumsum(np.bincount(doc, minlength=n))[:-1])  # ascending, so the lowest hashes come first
    hashes, owner = [], []
    for i, s in enumerate(sets):
        if len(s):
            k = sketch_length(len(s), percent)
            hashes.append(s[:k])
            owner.append(np.full(k, i))
    low = np.concatenate([np.empty(0, np.uint64), *hashes])
    own = np.concatenate([np.empty(0, np.int64), *owner]).astype(np.int64)
    order = np.argsort(low, kind="stable")
    ids = np.array([r["item_id"] for r in rows], dtype=np.int64)
    return Items(ids, np.array([len(s) for s in sets]), sets, low[order], own[order])


def _by_width(rows: list, width: int, percent: int) -> dict[int, Items]:
    """Items by the width of their shingles: all words of an item of fewer than ``width``; items without words are left out."""
    lengths = np.diff(find_words(pa.array([r["text"] for r in rows], pa.string()), ALNUM, lower=True).first)
    groups: dict[int, list] = {}
    for row, n in zip(rows, lengths.tolist()):
        if n:
            groups.setdefault(min(n, width), []).append(row)
    return {n: _items(own, n, percent) for n, own in sorted(groups.items())}


def _search(ids: np.ndarray, texts, items: Items, width: int, percent: int):
    """Pairs of a text and an item of which it contains at least ``percent``."""
    doc, shingle, n = _distinct(texts, width)
    if not len(shingle) or not len(items.sketch):
        return []
    size = np.bincount(doc, minlength=n)
    lo = np.searchsorted(items.sketch, shingle, side="left")
    hits = np.searchsorted(items.sketch, shingle, side="right") - lo
    at = np.flatnonzero(hits)
    count = hits[at]
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    item = items.sketch_item[np.repeat(lo[at], count) + within]
    pair = np.unique(np.stack([np.repeat(doc[at], count), item], axis=1), axis=0)
    # A text with too few shingles is of a size class that cannot contain the item.
    pair = pair[100 * size[pair[:, 0]] >= percent * items.size[pair[:, 1]]]
    start = np.concatenate([[0], np.cumsum(size)])
    found = []
    for d, i in pair.tolist():
        own = shingle[start[d] : start[d + 1]]
        wanted = items.shingles[i]
        place = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
        shared = int(np.count_nonzero(own[place] == wanted))
        if 100 * shared >= percent * len(wanted):
            found.append({"doc_id": int(ids[d]), "item_id": int(items.ids[i]), "n_item": len(wanted), "n_shared": shared})
    return found


PAIR_SCHEMA = pa.schema([(c, pa.int64()) for c in ("doc_id", "item_id", "n_item", "n_shared")])


def contained_items(
    docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE, percent: int = PERCENT, pass_items: int = PASS_ITEMS
) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared)``: documents that contain at least ``percent`` of an item's shingles.

    ``docs (doc_id, text)``, ``benchmark (item_id, text)``. Words are runs of
    letters and digits, without regard to the case of A-Z, so punctuation and
    line breaks don't hide an item. An item is represented by its lowest shingle
    hashes, as many as its size class needs so that no containing text can lack
    them all; a candidate is verified by all its shingles. Documents are read
    whole and stay where they are; items go to the tasks in passes of at most
    ``pass_items``.

    An item of fewer than ``width`` words has one shingle, all its words, and is
    found where they stand one after the other. Null and empty items match
    nothing, as do null and empty texts. Rows without an id are left out; equal
    pairs of repeated rows are given once. Empty tables give an empty one. Other
    columns are not looked at.
    """
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    wanted = wanted.where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    passes = max(1, math.ceil(wanted.count() / pass_items))
    texts = texts_of(docs)
    of_pass = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    result = None
    for k in range(passes):
        rows = wanted.where(of_pass == k).orderBy("item_id", "text").collect()
        shared = docs.sparkSession.sparkContext.broadcast(_by_width(rows, width, percent))

        def search(batches, shared=shared):
            for batch in batches:
                ids = batch.column("doc_id").to_numpy()
                for lo in range(0, len(ids), STEP):
                    part = batch.column("text").slice(lo, STEP)
                    for own_width, items in shared.value.items():
                        rows = _search(ids[lo : lo + STEP], part, items, own_width, percent)
                        if rows:
                            yield pa.RecordBatch.from_pylist(rows, schema=PAIR_SCHEMA)

        found = texts.mapInArrow(search, PAIRS)
        result = found if result is None else result.unionByName(found)
    return result.distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``docs`` without those that contain an item; rows without doc_id stay."""
    found = contained_items(docs, benchmark, **parameters).select("doc_id").distinct()
    return docs.join(found, docs["doc_id"] == found["doc_id"], "left_anti")
