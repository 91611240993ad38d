"""Substring dedup: windows of words that an earlier document has are cut out."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textloom.llm import blocks as bl
from textloom.llm.packing import pack_sorted, unpack_sorted
from textloom.llm.words import BASES, Words, find_words, hash_words, inner_windows, joined, rolling

WINDOW = 13

SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary())])
SEEN = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("seen", pa.binary())])
INTERVALS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<first:long,last:long>>"


class Windows(NamedTuple):
    """The windows of a block in the order of (bucket, hash); ``new`` marks the first of equal ones."""

    words: Words
    at: np.ndarray
    bucket: np.ndarray
    hash: np.ndarray
    new: np.ndarray


def _windows(texts, width: int, buckets: int) -> Windows:
    words = find_words(texts)
    at = inner_windows(words, width)
    h = hash_words(words)
    bucket = bl.bucket_of(rolling(h, width, BASES[0])[at], buckets)
    key = rolling(h, width, BASES[1])[at]
    order = np.lexsort((key, bucket))
    bucket, key = bucket[order], key[order]
    return Windows(words, at[order], bucket, key, bl.runs(key, bucket))


def _send(table: pa.Table, width: int, buckets: int) -> pa.Table:
    """A row per bucket with the distinct windows of the block."""
    block = table.column("block")[0].as_py()
    w = _windows(table.column("text"), width, buckets)
    bucket, key = w.bucket[w.new], w.hash[w.new]
    cuts = np.flatnonzero(bl.runs(bucket)) if len(bucket) else []
    rows = []
    for lo, hi in zip(cuts, [*cuts[1:], len(bucket)]):
        rows.append({"bucket": int(bucket[lo]), "block": block, "n": int(hi - lo), "hashes": pack_sorted(key[lo:hi])})
    return bl.table_of(rows, SENT)


def _meet(table: pa.Table) -> pa.Table:
    """Per block and bucket a bit for each of its windows: does an earlier block have it?"""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    key = np.concatenate([unpack_sorted(r["hashes"], np.uint64) for r in rows])
    order = np.argsort(key, kind="stable")
    seen = np.empty(len(key), dtype=bool)
    seen[order] = ~bl.runs(key[order])
    out, lo = [], 0
    for r in rows:
        bits = np.packbits(seen[lo : lo + r["n"]]).tobytes()
        out.append({"block": r["block"], "bucket": r["bucket"], "n": r["n"], "seen": bits})
        lo += r["n"]
    return bl.table_of(out, SEEN)


def _remove(texts: pa.Table, answers: pa.Table, width: int, buckets: int) -> pa.Table:
    ids = bl.column(texts, "doc_id")
    w = _windows(texts.column("text"), width, buckets)
    words = w.words
    doc = words.doc
    covered = np.zeros(len(doc) + 1, dtype=np.int32)
    if len(w.at):
        parts = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        seen = np.concatenate(
            [np.unpackbits(np.frombuffer(r["seen"], np.uint8), count=r["n"]).astype(bool) for r in parts]
        )
        unique = np.cumsum(w.new) - 1
        owner = ids[doc[w.at]]
        smallest = np.minimum.reduceat(owner, np.flatnonzero(w.new))
        repeated = w.at[seen[unique] | (smallest[unique] < owner)]
        covered += np.bincount(repeated, minlength=len(covered)).astype(np.int32)
        covered -= np.bincount(repeated + width, minlength=len(covered)).astype(np.int32)
    removed = np.cumsum(covered[:-1]) > 0
    before = np.concatenate([[0], np.cumsum(removed)])[words.first]
    edge = removed & (np.concatenate([[False], removed[:-1]]) < removed)
    starts_doc = np.zeros(len(doc) + 1, dtype=bool)
    starts_doc[words.first] = True
    first = np.flatnonzero(edge | (removed & starts_doc[:-1]))
    ends = removed & (~np.concatenate([removed[1:], [False]]) | starts_doc[1:])
    last = np.flatnonzero(ends)
    base = words.first[doc[first]]
    spans = pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], ["first", "last"])
    at = np.searchsorted(first, words.first).astype(np.int32)
    return pa.table(
        {
            "doc_id": pa.array(ids),
            "n_words": pa.array(np.diff(words.first)),
            "n_removed": pa.array(np.diff(before)),
            "kept_text": joined(words, ~removed).cast(pa.string()),
            "removed": pa.ListArray.from_arrays(pa.array(at), spans).cast(INTERVALS),
        }
    )


def remove_repeated(docs: DataFrame, window: int = WINDOW, block_bytes: int = bl.BLOCK_BYTES) -> DataFrame:
    """Cut every window of ``window`` words that also starts in a document of a smaller doc_id.

    Returns per row of ``docs (doc_id, text)``: ``doc_id, n_words, n_removed,
    kept_text`` (words joined by one blank) and ``removed``, the maximal intervals
    of removed words (positions from 0, both ends included). All windows are
    judged on the input.

    Blocks are ascending ranges of ids, so "an earlier document" is one of an
    earlier block or one of the same block. Each block sends the Rabin-Karp hashes
    of its windows to their buckets, where equal ones meet; back comes one bit per
    window. A window is recognised by 64 bits, besides those that chose its
    bucket; the number of buckets grows with the texts, so the chance of a false
    match per window stays below 1e-12.

    Null and empty texts, and texts of fewer than ``window`` words, lose nothing.
    Rows of one doc_id don't cut each other. Rows without doc_id are left out. An
    empty table gives an empty one; other columns are not looked at.
    """
    texts = bl.texts_of(docs)
    n = bl.count_blocks(texts, block_bytes)
    placed = bl.by_order(texts, n)
    sent = placed.groupBy("block").applyInArrow(
        bl.of_group(_send, width=window, buckets=n), "bucket int, block int, n int, hashes binary"
    )
    seen = sent.groupBy("bucket").applyInArrow(bl.of_group(_meet), "block int, bucket int, n int, seen binary")
    both = placed.groupBy("block").cogroup(seen.groupBy("block"))
    return both.applyInArrow(bl.of_groups(_remove, width=window, buckets=n), RESULT)
