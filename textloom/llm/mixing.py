"""Mixing sources to target weights by pivotal rounding of copy probabilities."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.blocks import of_group
from textloom.llm.words import find_words
from textloom.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
#: Documents of a leaf of the reduction tree, and leaves that a node joins.
LEAF_DOCS = 20_000
FAN_IN = 64
SEED = 6

UNITS = "doc_id long, source string, size long, p double, leaf long, lot long"
UNITS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("p", pa.float64())]
    + [("leaf", pa.int64()), ("lot", pa.int64())]
)


def _count_words(batches):
    for batch in batches:
        n = np.diff(find_words(batch.column("text")).first)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source"), pa.array(n)], ["doc_id", "source", "size"]
        )


def document_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: words of each document; rows of one doc_id are one document of their smallest source."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    ).where("doc_id IS NOT NULL")
    counted = rows.mapInArrow(_count_words, "doc_id long, source string, size long")
    return counted.groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("size").alias("size"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``(source, source_size, target)``: ``share`` of all sizes by weight, at most ``most`` times a source's size.

    Sources in the order of code points, null last, take the weights in turn.
    What a source cannot take is dealt out among the others by weight: all
    sources below their bound get the same amount per weight, which is raised
    until no further source reaches its bound.
    """
    totals = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.array(*[F.lit(float(w)) for w in weights])
    by_weight = totals.withColumn("weight", F.get(choice, (turn % len(weights)).cast("int")))
    bound = F.col("source_size") * most
    total = totals.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) >= bound
        row = by_weight.agg(
            F.sum(F.when(full, bound).otherwise(0)).alias("taken"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        raised = max(level, (share * total - row["taken"]) / row["open"])
        if raised == level:
            break
        level = raised
    target = F.least(F.col("weight") * F.lit(level), bound.cast("double"))
    return by_weight.select("source", "source_size", target.alias("target"))


def _pivotal(p: list[float], size: list[float], rng: np.random.Generator) -> None:
    """Round ``p`` in place, but for one at most; the sum of ``p * size`` stays.

    Two open probabilities at a time, until one of them is 0 or 1: words are moved
    to the first, as many as the two can give and take (``up``), or away from it
    (``down``). It gets them with probability ``down / (up + down)``, drawn anew
    for each pair, so both keep their expectation whatever their sizes.
    """
    draws = rng.random(len(p)).tolist()
    i = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if i >= 0:
            a, b = size[i], size[j]
            up, down = min((1.0 - p[i]) * a, p[j] * b), min(p[i] * a, (1.0 - p[j]) * b)
            words = up if draws[j] * (up + down) < down else -down
            p[i], p[j] = round(p[i] + words / a, 12), round(p[j] - words / b, 12)
            if 0.0 < p[i] < 1.0:
                continue
        i = j if 0.0 < p[j] < 1.0 else -1


def _round_group(table: pa.Table, seed: int, level: int) -> pa.Table:
    """One node of the tree: all documents of a group, source by source.

    Large documents come first, so that what is left over tends to be a small one;
    documents of one size are in random order.
    """
    data = table.drop_columns(["part_of_sources"]).to_pandas()
    order = ["source", "size", "lot", "doc_id"]
    data = data.sort_values(order, ascending=[True, False, True, True], na_position="last", ignore_index=True)
    p, size = data["p"].to_numpy(copy=True), data["size"].to_numpy(dtype=np.float64)
    rng = np.random.default_rng([seed, level, int(data["leaf"].min())])
    unknown, source = data["source"].isna().to_numpy(), data["source"].fillna("").to_numpy()
    cut = np.flatnonzero((source[1:] != source[:-1]) | (unknown[1:] != unknown[:-1])) + 1
    for lo, hi in zip([0, *cut], [*cut, len(data)]):
        part = p[lo:hi].tolist()
        _pivotal(part, size[lo:hi].tolist(), rng)
        p[lo:hi] = part
    return pa.Table.from_pandas(data.assign(p=p)[UNITS_ARROW.names], schema=UNITS_ARROW, preserve_index=False)


def mixture(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
    leaf_docs: int = LEAF_DOCS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)``: how often the mix takes each document.

    Every document of a source gets the same number of copies on average, target
    by size; the whole part of it for certain, the rest as a probability. Leaves
    of the tree are lots of documents chosen by a hash of the id, so they don't
    depend on how the table is stored, and a large source is spread over all of
    them. Each node rounds all but one document per source and hands that one on;
    what is left at the root is drawn with its probability. So every document
    keeps its probability, and the words taken of a source differ from its target
    by less than the one document that was drawn last.

    A null source is a source; rows of one doc_id are one document; rows without
    doc_id are left out. Empty documents are taken 0 words. An empty table gives
    an empty one. Other columns are not looked at.
    """
    sizes = materialize(document_sizes(docs), "document-sizes")
    # One row per source, in this table and in those that are joined with it.
    targets = materialize(source_targets(sizes, weights, share, most), "source-targets")
    average = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    n, sources = sizes.count(), targets.count()
    leaves = max(1, math.ceil(n / leaf_docs))
    lots = targets.select(
        F.col("source").alias("of"), "source_size", "target", F.floor(average).alias("whole"), (average - F.floor(average)).alias("part")
    )
    units = sizes.join(lots, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    lot = F.xxhash64("doc_id", F.lit(seed))
    # A document without words has nothing to move.
    open_part = F.when(F.col("size") > 0, F.col("part")).otherwise(F.lit(0.0))
    state = units.select(
        "doc_id", "source", "size", F.round(open_part, 12).alias("p"), F.pmod(lot, F.lit(leaves)).alias("leaf"), lot.alias("lot")
    )
    done, level = [], 0
    while True:
        spread = F.pmod(F.xxhash64("source"), F.lit(max(1, math.ceil(sources / 1000)) if level else 1))
        group = state.withColumn("part_of_sources", spread).groupBy("leaf", "part_of_sources")
        rounded = group.applyInArrow(of_group(_round_group, seed=seed, level=level), UNITS)
        rounded = materialize(rounded, f"mixture-{level}")
        if leaves == 1:
            draw = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(1 << 40)) / F.lit(float(1 << 40))
            done.append(rounded.withColumn("p", F.when(draw < F.col("p"), 1.0).otherwise(0.0)))
            break
        done.append(rounded.where("p <= 0 OR p >= 1"))
        state = rounded.where("p > 0 AND p < 1").withColumn("leaf", F.floor(F.col("leaf") / fan_in))
        leaves, level = math.ceil(leaves / fan_in), level + 1
    extra = done[0]
    for more in done[1:]:
        extra = extra.unionByName(more)
    copies = (F.col("whole") + F.col("p")).cast("long")
    result = extra.join(lots, F.col("source").eqNullSafe(F.col("of")))
    return result.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows without doc_id go."""
    taken = mixture(docs, **parameters).where("copies > 0")
    taken = taken.select(F.col("doc_id").alias("taken_id"), F.expr("explode(sequence(1, copies))").alias("copy"))
    both = docs.join(taken, docs["doc_id"] == taken["taken_id"])
    return both.select(*[docs[c] for c in docs.columns])
