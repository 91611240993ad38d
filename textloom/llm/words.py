"""Words of many texts at once, as arrays: where they stand and what they hash to.

A table of texts is laid out as one byte buffer with an offset per text. Words
are runs of bytes of a class, never across two texts. All hashes depend on the
bytes alone, so every task of a job gets the same value for the same word.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Longer words are hashed one by one.
LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
WORD_BASE = U64(0x2545F4914F6CDD1D)
#: Bases of two independent rolling hashes.
BASES = (U64(0xD1342543DE82EF95), U64(0xAF251AF3B0F025B5))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: All bytes but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, ASCII letters in lower case, and all bytes of other characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Words(NamedTuple):
    """Words of a list of texts. ``first[d]:first[d + 1]`` are those of text ``d``."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), np.diff(self.first))

    def prefixes(self, n: int) -> Words:
        """The first ``n`` elements of each word."""
        return self._replace(end=np.minimum(self.end, self.start + n))

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]].tobytes()


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offset of each; a null is an empty text."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    if not sum(map(len, chunks)):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    whole = pc.fill_null(pa.concat_arrays([c.cast(pa.large_binary()) for c in chunks]), b"")
    _, offsets, data = whole.buffers()
    at = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[at[0] : at[-1]], at - at[0]


def find_words(column, kind: np.ndarray = NOT_BLANK, lower: bool = False) -> Words:
    """The words of a column of texts: longest runs of bytes of the class ``kind``."""
    buf, at = text_bytes(column)
    if lower:
        buf = LOWER[buf]
    return words_in(buf, at, kind)


def words_in(buf: np.ndarray, at: np.ndarray, kind: np.ndarray) -> Words:
    """The words of texts laid out in a row, with the offset of each text."""
    if not len(buf):
        none = np.empty(0, np.int32)
        return Words(buf, none, none, np.zeros(len(at), np.int64))
    inside = kind[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(buf)]] = False
    start = np.flatnonzero(inside & ~before)
    after = before  # reuse of the memory
    after[-1] = False
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    small = np.int32 if len(buf) < 2**31 else np.int64
    return Words(buf, start.astype(small), end.astype(small), np.searchsorted(start, at))


def hash_words(words: Words, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit polynomial hash per word; ``values`` has the value of each element of the buffer."""
    length = words.end - words.start
    order = np.argsort(-np.minimum(length, LONG_WORD + 1).astype(np.int16), kind="stable")
    start, sizes = words.start[order], length[order]
    n_long = int(np.searchsorted(-sizes, -LONG_WORD, side="left"))
    h = sizes.astype(U64)
    many = np.searchsorted(-sizes, -np.arange(1, LONG_WORD + 1), side="right")
    for k, n in enumerate(many):
        if n <= n_long:
            break
        part = h[n_long:n]
        part *= WORD_BASE
        part += values[words.buf[start[n_long:n] + k]]
    for i in range(n_long):
        at = order[i]
        h[i] = int.from_bytes(hashlib.blake2b(words.bytes_of(at), digest_size=8).digest(), "little")
    out = np.empty_like(h)
    out[order] = h
    return mix(out)


def rolling(h: np.ndarray, k: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of every ``k`` consecutive values; none if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    total = h[:n].copy()
    for j in range(1, k):
        total *= base
        total += h[j : j + n]
    return mix(total)


def inner_windows(words: Words, k: int) -> np.ndarray:
    """First words of all runs of ``k`` words that lie in one text."""
    doc = words.doc
    n = len(doc) - k + 1
    return np.flatnonzero(doc[:n] == doc[k - 1 :]) if n > 0 else np.empty(0, np.int64)


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """Per text its kept words, joined by one blank."""
    start, end = words.start[keep], words.end[keep]
    size = (end - start).astype(np.int64) + 1
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    take = np.repeat(start - (stop - size), size)
    take += np.arange(total)
    take[stop - 1] = 0
    out = words.buf[take] if total else np.empty(0, np.uint8)
    out[stop - 1] = 0x20
    kept_before = np.concatenate([[0], np.cumsum(keep)])[words.first]
    at = np.concatenate([[0], stop])[kept_before]
    # The blank after a text's last word is no part of it: texts are cut out one by one.
    has = np.diff(kept_before) > 0
    lengths = np.diff(at) - has
    drop = np.ones(total, dtype=bool)
    drop[at[1:][has] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    data = out[drop]
    return pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).cast(pa.large_string())
