"""Token ids in files: blocks of ids as planes, each compressed, with an index.

A stored folder has two Parquet tables. ``segments`` holds a row per segment:

* ``part, segment``: parts are ascending ranges of doc_id, segments follow each other in a part;
* ``first, n_ids``: ids of the part before the segment, and in it;
* ``doc_ids, n_tokens``: its documents in ascending order and their number of ids, end id included;
* ``chunks``: the index, a ``(first, n, sizes)`` per block: its first id in the segment, its number of ids, and the
  bytes of each compressed plane;
* ``payload``: all planes of all blocks, one after the other.

A block of ``n`` ids is 4 byte planes (plane ``k`` holds byte ``k`` of every id, lowest first) or 32 bit planes (plane
``k`` holds bit ``k`` of every id, eight to a byte, first id in the highest bit). Planes are zstandard frames.
``parts`` holds ``(part, start, n_ids)``: the ids of all parts before it.
"""

from __future__ import annotations

import math
import os
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm import blocks as bl
from textloom.llm.packing import from_planes, to_planes
from textloom.llm.words import Words, hash_words, text_bytes

BLOCK_IDS = 1 << 16
#: Ids after which a segment ends; a document is never split.
SEGMENT_IDS = 1 << 20
END_ID = 0

#: Pieces after which a worker starts to forget those not met since as many others were, and the bytes of the longest
#: that it keeps.
CACHE_WORDS = 300_000
CACHE_LENGTH = 40
#: Unknown pieces that are encoded as one text.
JOINED_WORDS = 64
#: Text that is encoded at once.
STEP_BYTES = 2 << 20
#: How the vocabulary writes a blank (fixed by its format).
BLANK = "Ġ"

SEGMENT = pa.schema(
    [
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("chunks", pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int32()), ("sizes", pa.list_(pa.int32()))]))),
        ("payload", pa.binary()),
    ]
)
SEGMENT_DDL = (
    "segment int, first long, n_ids long, doc_ids array<long>, n_tokens array<long>, "
    "chunks array<struct<first:long,n:int,sizes:array<int>>>, payload binary"
)

#: Kinds of bytes. No token reaches across a blank that a visible character follows, or a single line end, or from
#: letters, digits or signs into another of these kinds. Signs leave out the apostrophe, which may go with letters, and
#: letters are the Latin ones: words with any other byte are encoded as they are.
_LETTER, _DIGIT, _SIGN, _LINE_END, _BLANK, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = _SIGN
_KIND[0x0A] = _LINE_END
_KIND[0x20] = _BLANK
_TIMES, _DIVIDED = "×÷".encode()[1::2]
#: How characters begin that are white space or, of some first bytes, may be.
_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_SPACE_LEADS = {0xC2: {0x85, 0xA0}, 0xE1: {0x9A}, 0xE2: {0x80, 0x81}, 0xE3: {0x80}}
#: Pieces of which many are encoded as one text.
_AFTER_BLANK = r"\A [A-Za-zÀ-ÖØ-öø-ſ0-9!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~]+\z"

_TEXT, _IDS = pa.large_string(), pa.large_binary()


class Kept:
    """Words and their ids, found by a hash."""

    def __init__(self):
        self.hashes, self.rows = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.words, self.ids = pa.array([], _TEXT), pa.array([], _IDS)

    def __len__(self) -> int:
        return len(self.words)

    def find(self, hashes: np.ndarray, words: pa.Array) -> np.ndarray:
        """The row of each word, or -1."""
        if not len(self):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        rows = np.where(self.hashes[at] == hashes, self.rows[at], -1)
        hits = np.flatnonzero(rows >= 0)
        same = pc.equal(self.words.take(pa.array(rows[hits])), words.take(pa.array(hits)))
        rows[hits[~same.to_numpy(zero_copy_only=False)]] = -1
        return rows

    def add(self, hashes: np.ndarray, words: pa.Array, ids: pa.Array) -> None:
        """Add words in the order of their hashes; of words of one hash only one is kept."""
        at = np.searchsorted(self.hashes, hashes)
        free = bl.runs(hashes)
        if len(self):
            free &= self.hashes[np.minimum(at, len(self) - 1)] != hashes
        chosen = pa.array(np.flatnonzero(free))
        self.rows = np.insert(self.rows, at[free], len(self) + np.arange(len(chosen)))
        self.hashes = np.insert(self.hashes, at[free], hashes[free])
        self.words = pa.concat_arrays([self.words, words.take(chosen)])
        self.ids = pa.concat_arrays([self.ids, ids.take(chosen)])


def _joined(values: pa.Array, codes: np.ndarray, starts: np.ndarray) -> pa.Array:
    """``values`` by their numbers, one after the other; a result begins at each of ``starts``."""
    taken = values.take(pa.array(codes))
    _, offsets, data = taken.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(taken) + 1, 8 * taken.offset) if len(taken) else np.zeros(1, np.int64)
    bounds = offsets[np.append(starts, len(taken))]
    return pa.Array.from_buffers(_IDS, len(starts), [None, pa.py_buffer(bounds.tobytes()), data or pa.py_buffer(b"")])


def cut(buf: np.ndarray, at: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where the pieces of texts start that are encoded on their own; the texts start at ``at`` and are not empty.

    Those marked ``whole`` are one piece each.
    """
    kind = _KIND[buf]
    odd = kind == _OTHER
    odd[1:] |= (buf[:-1] == 0xC3) & ((buf[1:] == _TIMES) | (buf[1:] == _DIVIDED))
    opens = np.zeros(len(buf), bool)
    opens[at] = True
    word = kind == _BLANK
    blanks = np.flatnonzero(word)
    following = np.append(buf, np.zeros(2, np.uint8))
    spaces = _SPACE[following[blanks + 1]]
    for lead, seconds in _SPACE_LEADS.items():
        i = np.flatnonzero(following[blanks + 1] == lead)
        spaces[i] |= np.isin(following[blanks[i] + 2], list(seconds))
    spaces |= np.append(opens, True)[blanks + 1]
    for i in np.flatnonzero(whole):
        lo, hi = at[i], at[i + 1] if i + 1 < len(at) else len(buf)
        odd[lo] = True
        spaces[np.searchsorted(blanks, lo) : np.searchsorted(blanks, hi)] = True
    odd[blanks[spaces]] = True
    word[blanks[spaces]] = False
    word |= opens
    # Of several line ends in a row each but the last may go with the others.
    odd[1:] |= (kind[1:] == _LINE_END) & (kind[:-1] == _LINE_END) & ~opens[1:]
    inner = np.zeros(len(buf), bool)
    inner[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK)
    inner |= word
    starts = np.flatnonzero(inner)
    odd = np.flatnonzero(odd)
    if len(odd):
        words = np.flatnonzero(word)
        is_odd = np.zeros(len(words), bool)
        is_odd[np.searchsorted(words, odd, side="right") - 1] = True
        starts = starts[word[starts] | ~is_odd[np.searchsorted(words, starts, side="right") - 1]]
    return starts


class Encoder:
    """Ids of texts as little-endian 32-bit numbers; keeps the ids of the pieces of texts that it has seen."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith(BLANK) for i in range(size)])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known, self.older = [Kept()], [Kept()]

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """A number per word, and the ids by these numbers."""
        if len(self.known[0]) > CACHE_WORDS:
            self.older, self.known = self.known, [Kept()]
        (known,), (older,) = self.known, self.older
        numbered = words.dictionary_encode()
        buf, at = text_bytes(numbered.dictionary)
        hashes = hash_words(Words(buf, at[:-1], at[1:], at))
        order = np.argsort(hashes)
        hashes, distinct = hashes[order], numbered.dictionary.take(pa.array(order))
        rows = known.find(hashes, distinct)
        rest = np.flatnonzero(rows < 0)
        before = older.find(hashes[rest], distinct.take(pa.array(rest)))
        again, new = rest[before >= 0], rest[before < 0]
        unseen = distinct.take(pa.array(new))
        ids = pa.concat_arrays([known.ids, older.ids.take(pa.array(before[before >= 0])), self._learn(unseen)])
        rows[again] = len(known) + np.arange(len(again))
        rows[new] = len(known) + len(again) + np.arange(len(new))
        short = pc.binary_length(unseen).to_numpy() <= CACHE_LENGTH
        add = np.sort(np.concatenate([again, new[short]]))
        known.add(hashes[add], distinct.take(pa.array(add)), ids.take(pa.array(rows[add])))
        by_code = np.empty(len(order), np.int64)
        by_code[order] = rows
        return by_code[numbered.indices.to_numpy()], ids

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of pieces: simple ones after a blank many in one text, cut where a token begins with a blank."""
        rows = pieces.to_pylist()
        after = pc.match_substring_regex(pieces, _AFTER_BLANK).to_numpy(zero_copy_only=False)
        joined, alone = np.flatnonzero(after).tolist(), np.flatnonzero(~after).tolist()
        ids: list[bytes] = [b""] * len(rows)
        lots = [joined[lo : lo + JOINED_WORDS] for lo in range(0, len(joined), JOINED_WORDS)]
        texts = ["".join([rows[i] for i in lot]) for lot in lots]
        for lot, encoded in zip(lots, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found = np.array(encoded.ids, "<u4")
            at = (4 * np.flatnonzero(self.opens[found])).tolist()
            if len(at) == len(lot):
                raw = found.tobytes()
                for i, a, b in zip(lot, at, [*at[1:], len(raw)]):
                    ids[i] = raw[a:b]
            else:
                alone += lot
        for i, encoded in zip(alone, self.tokenizer.encode_batch_fast([rows[i] for i in alone], add_special_tokens=False)):
            ids[i] = _pack(encoded.ids)
        return pa.array(ids, _IDS)

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """The same for an Arrow array of large strings without nulls, as one of large binaries."""
        buf, at = text_bytes(texts)
        filled = np.flatnonzero(np.diff(at))
        if not len(filled):
            return pa.array([b""] * len(texts), _IDS)
        whole = np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        starts = cut(buf, at[filled], whole[filled])
        bounds = pa.py_buffer(np.append(starts, len(buf)))
        codes, ids = self._look_up(pa.Array.from_buffers(_TEXT, len(starts), [None, bounds, pa.py_buffer(buf)]))
        return _joined(ids, codes, np.searchsorted(starts, at[:-1]))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array(texts, _TEXT)).to_pylist()


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def planes_of(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The compressed planes of a block."""
    if bits:
        planes = [np.packbits(((ids >> np.uint32(k)) & np.uint32(1)).astype(np.uint8)).tobytes() for k in range(32)]
    else:
        raw = to_planes(ids)
        planes = [raw[k * len(ids) : (k + 1) * len(ids)] for k in range(4)]
    compressor = zstandard.ZstdCompressor(level=3)
    return [compressor.compress(p) for p in planes]


def block_of(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block; the number of planes tells their kind."""
    raw = [zstandard.ZstdDecompressor().decompress(p) for p in planes]
    if len(raw) == 4:
        return from_planes(b"".join(raw), np.uint32)
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(raw):
        ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype(np.uint32) << np.uint32(k)
    return ids


def _segment(number: int, first: int, docs: list[tuple[int, bytes]], block_ids: int, bits: bool) -> dict:
    ids = np.frombuffer(b"".join(raw for _, raw in docs), "<u4")
    chunks, payload = [], []
    for at in range(0, len(ids), block_ids):
        block = ids[at : at + block_ids]
        planes = planes_of(block, bits)
        chunks.append({"first": at, "n": len(block), "sizes": [len(p) for p in planes]})
        payload.extend(planes)
    return {
        "segment": number,
        "first": first,
        "n_ids": len(ids),
        "doc_ids": [d for d, _ in docs],
        "n_tokens": [len(raw) // 4 for _, raw in docs],
        "chunks": chunks,
        "payload": b"".join(payload),
    }


def _steps(sizes: np.ndarray):
    """Ranges of texts of about as many bytes each, at most ``STEP_BYTES`` but for the last text of a range."""
    total = np.cumsum(sizes)
    n = math.ceil(total[-1] / STEP_BYTES) if len(total) else 0
    cuts = np.searchsorted(total, np.arange(1, n) * (total[-1] / n)) + 1 if n > 1 else []
    bounds = np.unique([0, *cuts, len(total)]).tolist()
    return zip(bounds, bounds[1:])


def _encode_part(batches, path: str, end_id: int, block_ids: int, segment_ids: int, bits: bool):
    """The segments of a part whose documents come in order."""
    end = np.array([end_id], "<u4").tobytes()
    number = first = held = 0
    docs: list[tuple[int, bytes]] = []
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        texts = batch.column("text").cast(_TEXT).fill_null("")
        for lo, hi in _steps(pc.binary_length(texts).to_numpy()):
            for doc_id, raw in zip(ids[lo:hi], encoder(path).encode_array(texts.slice(lo, hi - lo)).to_pylist()):
                docs.append((doc_id, raw + end))
                held += len(raw) // 4 + 1
                if held >= segment_ids:
                    yield pa.RecordBatch.from_pylist([_segment(number, first, docs, block_ids, bits)], schema=SEGMENT)
                    number, first, held, docs = number + 1, first + held, 0, []
    if docs:
        yield pa.RecordBatch.from_pylist([_segment(number, first, docs, block_ids, bits)], schema=SEGMENT)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    segment_ids: int = SEGMENT_IDS,
    bits: bool = False,
    part_bytes: int = bl.BLOCK_BYTES,
) -> None:
    """Encode every text of ``docs (doc_id, text)``, append ``end_id`` to each and store the ids below ``path``.

    ``tokenizer`` is a file of the tokenizers library that all executors find
    under this path. Documents are stored in ascending order of doc_id; rows of
    one doc_id in the order of their texts. A null or empty text is the end id
    alone. Rows without doc_id are left out; an empty table gives an empty folder
    of the same tables. Other columns are not looked at.
    """
    texts = bl.texts_of(docs)
    parts = bl.count_blocks(texts, part_bytes)

    def encode(batches):
        return _encode_part(batches, tokenizer, end_id, block_ids, segment_ids, bits)

    ordered = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    segments = ordered.mapInArrow(encode, SEGMENT_DDL).withColumn("part", F.spark_partition_id())
    segments.write.mode("error").parquet(f"{path}/segments")
    totals = docs.sparkSession.read.schema(f"part int, {SEGMENT_DDL}").parquet(f"{path}/segments")
    totals = totals.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    # One row per part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"), "n_ids")
    starts.write.mode("error").parquet(f"{path}/parts")


def _decode(batches):
    for batch in batches:
        for r in batch.to_pylist():
            blocks, at = [], 0
            for chunk in r["chunks"]:
                planes = []
                for size in chunk["sizes"]:
                    planes.append(r["payload"][at : at + size])
                    at += size
                blocks.append(block_of(planes, chunk["n"]))
            ids = np.concatenate(blocks).astype("<u4", copy=False)
            stop = np.cumsum(r["n_tokens"])
            starts = stop - np.array(r["n_tokens"])
            raw = [ids[a:b].tobytes() for a, b in zip(starts, stop)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"]), pa.array(starts + r["start"] + r["first"]), pa.array(r["n_tokens"]), pa.array(raw, pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document ``doc_id, start`` (ids of all documents before it), ``n_tokens`` and ``ids``, the ids as
    little-endian unsigned 32-bit numbers."""
    segments = spark.read.schema(f"part int, {SEGMENT_DDL}").parquet(f"{path}/segments")
    parts = spark.read.schema("part int, start long, n_ids long").parquet(f"{path}/parts")
    placed = segments.join(parts.select("part", "start"), "part")
    columns = ["doc_ids", "n_tokens", "chunks", "payload", "first", "start"]
    return placed.select(*columns).mapInArrow(_decode, "doc_id long, start long, n_tokens long, ids binary")
