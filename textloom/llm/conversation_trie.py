"""Conversations that begin alike: a prefix trie of their turns, built in adaptive radix trees block by block."""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.blocks import of_group
from textloom.llm.radix_tree import RadixTree
from textloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations of so many consecutive ids take their first turns from the first of them.
FAMILY = 20
#: A conversation takes less than so many turns from there.
MOST_SHARED = 4
#: Bytes of a turn's id and of a node's.
WIDTH = 16
#: Turns that one tree holds.
BLOCK_TURNS = 50_000

ROOT = bytes(WIDTH)
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

PARTIAL = (
    "block long, seq int, above int, node binary, parent binary, depth long, words long, n_convs long, low long, "
    "first_end long, ends string"
)
PARTIAL_ARROW = pa.schema(
    [("block", pa.int64()), ("seq", pa.int32()), ("above", pa.int32()), ("node", pa.binary()), ("parent", pa.binary())]
    + [(name, pa.int64()) for name in ("depth", "words", "n_convs", "low", "first_end")]
    + [("ends", pa.string())]
)
SUBTREES = "node binary, n_leaves long, saved_tokens long, parent_conv_id long"
SUBTREES_ARROW = pa.schema(
    [("node", pa.binary()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("parent_conv_id", pa.int64())]
)
RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: per conversation its turns in order, as ids of ``WIDTH`` bytes with their number of words.

    The id is a digest of role and text. Turns of one number are in the order of
    their ids. So texts stay where they are; a conversation is one row of some
    20 bytes per turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH).alias("id"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(lists: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED) -> DataFrame:
    """``lists`` with the first ``crc32(conv_id) % most_shared`` turns of each conversation taken from ``conv_id - conv_id % family``."""
    first = lists.where(F.col("conv_id") % family == 0)
    heads = first.select(F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, most_shared - 1)).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).cast("int")
    own = lists.withColumns({"base": F.col("conv_id") - F.col("conv_id") % family, "taken": taken})
    both = own.join(heads, "base", "left")
    none = F.array().cast(lists.schema["turns"].dataType)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("taken"))
    rest = F.slice("turns", F.col("taken") + 1, F.size("turns"))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


def _partial_nodes(block_turns: int):
    """Builds trees over conversations that come in ascending order of their ids; a full tree is handed out."""

    def nodes(tree: RadixTree, words: dict[bytes, int], block: int):
        keys, columns = [], [[] for _ in PARTIAL_ARROW]
        for seq, visit in enumerate(tree.walk()):
            parent = keys[visit.parent] if visit.depth else None
            keys.append(hashlib.sha256(parent + visit.last).digest()[:WIDTH] if visit.depth else ROOT)
            ends = visit.ends or []
            row = (
                block, seq, visit.parent, keys[seq], parent, visit.depth, words.get(visit.last, 0), visit.count, visit.low,
                ends[0] if ends else None, ",".join(map(str, ends)) if ends else None,
            )
            for column, value in zip(columns, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PARTIAL_ARROW)], schema=PARTIAL_ARROW)

    def build(batches):
        tree, words, held, number = RadixTree(WIDTH), {}, 0, 0
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            for member, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                words.update((t["id"], t["words"]) for t in turns)
                tree.insert(b"".join(t["id"] for t in turns), member)
                held += len(turns) + 1
                if held >= block_turns:
                    yield from nodes(tree, words, first + number)
                    tree, words, held, number = RadixTree(WIDTH), {}, 0, number + 1
        if held:
            yield from nodes(tree, words, first + number)

    return build


def _sum_up(table: pa.Table) -> pa.Table:
    """What the nodes of one tree add to their own subtree and to those above.

    A node is counted in the one tree that has its smallest member. That tree has
    all nodes above it too, so the parent's smallest member is found there.
    """
    data = table.sort_by("seq").to_pydict()
    n = len(data["seq"])
    own = [low == conv for low, conv in zip(data["low"], data["conv_id"])]
    leaves = [leaf if mine else 0 for leaf, mine in zip(data["leaf"], own)]
    saved = [s if mine else 0 for s, mine in zip(data["saved"], own)]
    parents = [None] * n
    for i in range(n - 1, 0, -1):
        above = data["above"][i]
        leaves[above] += leaves[i]
        saved[above] += saved[i]
        if own[i]:
            parents[i] = data["conv_id"][above]
    return pa.table([pa.array(c, f.type) for c, f in zip((data["node"], leaves, saved, parents), SUBTREES_ARROW)], schema=SUBTREES_ARROW)


def _hash_in_order(batches):
    """One digest per node, of lists that come one after the other; no list of a node is held together."""
    node, state = None, None
    done: list[tuple[bytes, str]] = []

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["node", "ends_sha256"]
        )

    for batch in batches:
        for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if key != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ends.encode())
            else:
                state.update(f",{ends}".encode())
        yield out()
        done = []
    if node is not None:
        done = [(node, state.hexdigest())]
        yield out()


def prefix_trie(
    conversations: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED, block_turns: int = BLOCK_TURNS
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations of ``conversations (conv_id, turn, role, text)``.

    Each node is a distinct sequence of first turns: ``conv_id`` (its smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, the digest of the members
    that end there.

    Conversations are dealt out in ranges of ids. Each task builds adaptive radix
    trees over their turn ids, and hands out a row per node, so a node that all
    conversations share comes from a task once per tree; rows of one node are
    then added up. Sums over subtrees are made in the same trees: a node is
    counted where its smallest member is. The number of stages does not depend on
    the depth.

    Turns without number come first; turns of one number are in the order of a
    digest of role and text, repeated rows count each time. A null role or text
    is empty. Rows without conv_id are left out; an empty table gives no node, not
    even a root. Other columns are not looked at.
    """
    whole = materialize(rebuilt(turn_lists(conversations), family, most_shared), "rebuilt-conversations")
    size = whole.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    tasks = max(whole.sparkSession.sparkContext.defaultParallelism, math.ceil(size / block_turns))
    ranges = whole.repartitionByRange(tasks, "conv_id").sortWithinPartitions("conv_id")
    partial = materialize(ranges.mapInArrow(_partial_nodes(block_turns), PARTIAL), "partial-nodes")

    merged = partial.groupBy("node").agg(
        F.min("low").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.min("words").alias("words"),
        F.sum("n_convs").alias("n_convs"),
    )
    merged = materialize(merged, "merged-nodes")
    children = merged.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = merged.join(children, "node", "left").select(
        "node", "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "words"
    )
    nodes = materialize(nodes, "nodes")

    values = nodes.select(
        "node",
        "conv_id",
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    placed = partial.select("block", "seq", "above", "node", "low").join(values, "node")
    sums = placed.groupBy("block").applyInArrow(of_group(_sum_up), SUBTREES)
    subtrees = sums.groupBy("node").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("parent_conv_id").alias("parent_conv_id")
    )

    ends = partial.where("ends IS NOT NULL").select("node", "first_end", "ends")
    in_order = ends.repartition("node").sortWithinPartitions("node", "first_end")
    digests = in_order.mapInArrow(_hash_in_order, "node binary, ends_sha256 string")

    found = nodes.join(subtrees, "node").join(digests, "node", "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_HASH))).select(*RESULT)
