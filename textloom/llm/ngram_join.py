"""N-gram Jaccard join: documents whose sets of word shingles are similar, by a prefix tree."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import blocks as bl
from textloom.llm.components import components
from textloom.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from textloom.llm.prefix_tree import Groups, links_between, similar_groups
from textloom.llm.words import BASES, find_words, hash_words, inner_windows, rolling
from textloom.session import materialize

SHINGLE = 5
PERCENT = 80
#: Sets that one task puts into a tree, on average.
TREE_SETS = 2000

CLASS_BITS = 6

SENT = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
)
CLASSES = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("classes", pa.binary())])
SETS = "doc_id long, n_shingles long, tokens binary, n_prefix int, digest binary"
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Shingles(NamedTuple):
    """Distinct shingles per document, in the order of their documents."""

    doc: np.ndarray
    hash: np.ndarray
    n_docs: int


def _shingles(texts, width: int) -> Shingles:
    words = find_words(texts, lower=True)
    h = hash_words(words)
    at = inner_windows(words, width)
    doc, shingle = [words.doc[at]], [rolling(h, width, BASES[0])[at]]
    count = np.diff(words.first)
    for short in range(1, width):  # all words of a short text make its one shingle
        of = np.flatnonzero(count == short)
        doc.append(of.astype(np.int32))
        shingle.append(rolling(h, short, BASES[1])[words.first[of]])
    doc, shingle = np.concatenate(doc), np.concatenate(shingle)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = bl.runs(shingle, doc)
    return Shingles(doc[new], shingle[new], len(count))


def _by_key(s: Shingles, buckets: int):
    """Shingles sorted by (bucket, 32 bits of the hash), and where equal ones begin."""
    bucket = bl.bucket_of(s.hash, buckets)
    key = (bucket.astype(np.uint64) << np.uint64(32)) | (s.hash & np.uint64(0xFFFFFFFF))
    order = np.argsort(key)
    return order, key[order], bl.runs(key[order])


def _send(table: pa.Table, width: int, buckets: int) -> pa.Table:
    """A row per bucket: the block's distinct keys and in how many of its documents each stands."""
    block = table.column("block")[0].as_py()
    _, key, new = _by_key(_shingles(table.column("text"), width), buckets)
    starts = np.flatnonzero(new)
    counts = np.diff(starts, append=len(key)).astype(np.uint32)
    key = key[new]
    bucket = (key >> np.uint64(32)).astype(np.int32)
    cuts = np.flatnonzero(bl.runs(bucket)) if len(key) else []
    rows = [
        {
            "bucket": int(bucket[lo]),
            "block": block,
            "n": int(hi - lo),
            "keys": pack_sorted(key[lo:hi].astype(np.uint32)),
            "counts": pack(counts[lo:hi]),
        }
        for lo, hi in zip(cuts, [*cuts[1:], len(key)])
    ]
    return bl.table_of(rows, SENT)


def _meet(table: pa.Table) -> pa.Table:
    """Per block and bucket the frequency class of each key: 0 for one document, else the bits of (documents - 1)."""
    rows = table.to_pylist()
    key = np.concatenate([unpack_sorted(r["keys"], np.uint32) for r in rows])
    count = np.concatenate([unpack(r["counts"], np.uint32) for r in rows])
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(bl.runs(key[order]))
    total = np.add.reduceat(count[order].astype(np.int64), starts)
    kind = np.where(total > 1, np.floor(np.log2(np.maximum(total - 1, 1))) + 1, 0).astype(np.uint8)
    classes = np.empty(len(key), np.uint8)
    classes[order] = np.repeat(kind, np.diff(starts, append=len(key)))
    out, lo = [], 0
    for r in rows:
        out.append({"block": r["block"], "bucket": r["bucket"], "classes": pack(classes[lo : lo + r["n"]])})
        lo += r["n"]
    return bl.table_of(out, CLASSES)


def _sets(texts: pa.Table, answers: pa.Table, width: int, buckets: int, percent: int) -> pa.Table:
    """Per document its shared shingles in global order, rare ones first.

    Shingles that no other document has cannot be shared. Where they alone exceed
    what two similar sets may differ in, the document has no partner and no
    tokens. Otherwise similar sets share one of the first ``n_prefix`` tokens.
    """
    ids = bl.column(texts, "doc_id")
    s = _shingles(texts.column("text"), width)
    order, _, new = _by_key(s, buckets)
    parts = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
    classes = np.concatenate([np.empty(0, np.uint8), *[unpack(r["classes"], np.uint8) for r in parts]])
    kind = np.empty(len(order), np.uint64)
    kind[order] = classes[np.cumsum(new) - 1] if len(order) else 0
    token = (kind << np.uint64(64 - CLASS_BITS)) | (s.hash >> np.uint64(CLASS_BITS))
    total = np.bincount(s.doc, minlength=s.n_docs)
    common = kind > 0
    shared = np.bincount(s.doc[common], minlength=s.n_docs)
    need = -(-percent * total // 100)
    possible = (shared >= need) & (total > 0)
    pick = common & possible[s.doc]
    doc, token = s.doc[pick], token[pick]
    place = np.lexsort((token, doc))
    token = token[place]
    stop = np.cumsum(np.where(possible, shared, 0))
    prefix = np.where(possible, shared - need + 1, 0)
    tokens, digests = [], []
    for d in range(s.n_docs):
        if not possible[d]:
            tokens.append(None)
            digests.append(None)
            continue
        raw = token[stop[d] - shared[d] : stop[d]].tobytes()
        # A set with a shingle of its own equals no other set.
        own = b"" if shared[d] == total[d] else int(ids[d]).to_bytes(8, "little", signed=True)
        tokens.append(raw)
        digests.append(hashlib.blake2b(raw + own, digest_size=16).digest())
    return pa.table(
        {
            "doc_id": pa.array(ids),
            "n_shingles": pa.array(total.astype(np.int64)),
            "tokens": pa.array(tokens, pa.binary()),
            "n_prefix": pa.array(prefix.astype(np.int32)),
            "digest": pa.array(digests, pa.binary()),
        }
    )


def shingle_sets(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, block_bytes: int = bl.BLOCK_BYTES):
    """``(doc_id, n_shingles, tokens, n_prefix, digest)`` per row of ``docs``; see ``_sets``."""
    texts = bl.texts_of(docs)
    n = bl.count_blocks(texts, block_bytes)
    placed = bl.by_hash(texts, n)
    sent = placed.groupBy("block").applyInArrow(
        bl.of_group(_send, width=width, buckets=n), "bucket int, block int, n int, keys binary, counts binary"
    )
    classes = sent.groupBy("bucket").applyInArrow(bl.of_group(_meet), "block int, bucket int, classes binary")
    both = placed.groupBy("block").cogroup(classes.groupBy("block"))
    return both.applyInArrow(bl.of_groups(_sets, width=width, buckets=n, percent=percent), SETS)


def _prefixes(batches):
    """A row per prefix token of each set."""
    for batch in batches:
        lists = [np.frombuffer(t, np.int64)[:n] for t, n in zip(*(batch.column(c).to_pylist() for c in ("tokens", "n_prefix")))]
        sizes = [len(x) for x in lists]
        if sum(sizes):
            ids = np.repeat(batch.column("doc_id").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists)), pa.array(ids)], ["token", "doc_id"])


def _unpacked(table: pa.Table):
    """Ids, sets and sizes."""
    raw = table.column("tokens").to_pylist()
    return bl.column(table, "doc_id"), [np.frombuffer(t, np.uint64) for t in raw], bl.column(table, "n_shingles")


def _links(ids: np.ndarray, groups: Groups) -> pa.Table:
    """Each member of a group beside the smallest id of it."""
    root = np.array([groups.find(i) for i in range(len(ids))])
    low = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(low, root, ids)
    linked = ids != low[root]
    return pa.table({"a": pa.array(ids[linked]), "b": pa.array(low[root][linked])})


def _tree_join(table: pa.Table, percent: int) -> pa.Table:
    ids, tokens, sizes = _unpacked(table)
    return _links(ids, similar_groups(tokens, sizes, percent))


def _stray_join(table: pa.Table, percent: int) -> pa.Table:
    ids, tokens, sizes = _unpacked(table)
    labels, strays = bl.column(table, "component_id"), bl.column(table, "stray", bool)
    return _links(ids, links_between(tokens, sizes, percent, labels, strays))


def _shares(n, per_share: int):
    return F.greatest(F.ceil(n / F.lit(per_share)), F.lit(1)).cast("int")


def _each(n):
    return F.explode(F.sequence(F.lit(0), n - 1))


def similar_components(sets: DataFrame, percent: int = PERCENT, tree_sets: int = TREE_SETS) -> DataFrame:
    """``(doc_id, component_id)`` of the documents of the stored table ``sets`` that have a set.

    Equal sets are represented by their smallest doc_id. Sets that share a prefix
    token go to the tree of the smallest id that has it, so each set goes to as
    many trees as it has different such ids. Trees of more than ``tree_sets`` sets
    are dealt out over several tasks. There, sets of different tasks are first
    connected through what the tasks found; those that then still stand outside
    of the largest component of their tree search all other tasks of it, in
    blocks. So every two sets of one tree are compared or known to be connected.
    """
    linked = sets.where("tokens IS NOT NULL")
    # Documents of one digest have the same set.
    whole = [F.first(c).alias(c) for c in ("n_shingles", "tokens", "n_prefix")]
    reps = materialize(linked.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *whole), "distinct-sets")
    ids = reps.select("digest", F.col("doc_id").alias("rep"))
    member = materialize(linked.select("doc_id", "digest").join(ids, "digest").select("doc_id", "rep"), "set-members")
    # Only rows of one doc_id with different sets connect sets; equal sets are attached to their component afterwards.
    several = member.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last").select("doc_id", "b")
    same = member.join(several, "doc_id").select(F.col("rep").alias("a"), "b")

    def of_members(links: DataFrame) -> DataFrame:
        labels = components(links).withColumnRenamed("doc_id", "rep")
        return member.join(labels, "rep", "left").select("doc_id", F.coalesce("component_id", "rep").alias("component_id"))

    tokens = reps.select("doc_id", "tokens", "n_prefix").mapInArrow(_prefixes, "token long, doc_id long")
    owners = tokens.groupBy("token").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other"))
    owners = owners.where("owner < other").select("token", "owner")
    placed = materialize(tokens.join(owners, "token").select("owner", "doc_id").distinct(), "tree-members")

    counted = placed.groupBy("owner").agg(_shares(F.count("*"), tree_sets).alias("shares"))
    dealt = placed.join(counted, "owner").withColumn("share", F.pmod(F.xxhash64("doc_id"), "shares").cast("int"))
    contents = reps.select("doc_id", "n_shingles", "tokens")
    found = dealt.select("owner", "share", "doc_id").join(contents, "doc_id").groupBy("owner", "share")
    first = materialize(found.applyInArrow(bl.of_group(_tree_join, percent=percent), "a long, b long"), "tree-links")
    if counted.where("shares > 1").isEmpty():
        return of_members(first.unionByName(same))

    labels = components(first)
    large = dealt.where("shares > 1").join(labels, "doc_id", "left")
    large = large.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    sizes = large.groupBy("owner", "component_id").count()
    by_size = Window.partitionBy("owner").orderBy(F.desc("count"), "component_id")
    main = sizes.withColumn("place", F.row_number().over(by_size)).where("place = 1")
    main = main.select("owner", F.col("component_id").alias("main"))
    marked = large.join(main, "owner").withColumn("stray", F.col("component_id") != F.col("main"))
    marked = materialize(marked.select("owner", "shares", "share", "doc_id", "component_id", "stray"), "large-trees")
    strays = marked.where("stray")
    parts = strays.groupBy("owner").agg(_shares(F.count("*"), tree_sets).alias("parts"))
    # Every share meets every part of the strays.
    columns = ["owner", "share", "part", "doc_id", "component_id", "stray"]
    still = marked.where("NOT stray").join(parts, "owner").withColumn("part", _each(F.col("parts"))).select(*columns)
    of_part = F.pmod(F.xxhash64("doc_id", F.lit("part")), "parts").cast("int")
    split = strays.join(parts, "owner").withColumn("part", of_part)
    search = split.withColumn("share", _each(F.col("shares"))).select(*columns)
    # Strays are searched for by other strays in the shares they lie in.
    lying = split.select("owner", "share", F.col("part").alias("of"), "parts", "doc_id", "component_id", "stray")
    lying = lying.withColumn("part", _each(F.col("parts"))).where("part != of").withColumn("stray", F.lit(False)).select(*columns)
    cells = still.unionByName(search).unionByName(lying).join(contents, "doc_id").groupBy("owner", "share", "part")
    second = materialize(cells.applyInArrow(bl.of_group(_stray_join, percent=percent), "a long, b long"), "stray-links")
    return of_members(first.unionByName(second).unionByName(same))


def ngram_components(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, block_bytes: int = bl.BLOCK_BYTES, tree_sets: int = TREE_SETS
) -> DataFrame:
    """Near-duplicate groups: ``(doc_id, n_shingles, component_id)`` per row of ``docs (doc_id, text)``.

    Words are compared without regard to the case of A-Z. Two documents are
    linked when their sets of distinct shingles have a Jaccard similarity of at
    least ``percent``; a text of fewer words is one shingle. ``component_id`` is
    the smallest doc_id that links reach. The search misses no link: sets are in
    the order of (frequency, hash), similar ones share a token of their prefixes.

    A null or empty text has no shingles and no links. Rows of one doc_id belong
    together, whatever their texts. Rows without doc_id are left out. An empty
    table gives an empty one; other columns are not looked at. Shingles are
    compared by 58 bits of a hash, and their frequency class.
    """
    sets = materialize(shingle_sets(docs, width, percent, block_bytes), "shingle-sets")
    groups = similar_components(sets, percent, tree_sets).withColumnRenamed("doc_id", "member")
    merged = groups.groupBy("member").agg(F.min("component_id").alias("component"))
    result = sets.join(merged, F.col("doc_id") == F.col("member"), "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the smallest doc_id; all columns stay as they are.

    Rows without doc_id are left out; of rows of one doc_id one stays.
    """
    groups = ngram_components(docs, **parameters)
    stay = groups.where("component_id = doc_id").select(F.col("doc_id").alias("stays")).distinct()
    kept = docs.join(stay, docs["doc_id"] == stay["stays"], "left_semi")
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id"])
