"""Blocks of documents and buckets of hashes.

A question about a hash that all documents must answer ("who else has it?") is
asked per block, not per row: a block of documents sends each distinct hash
once, sorted and packed, to the bucket of the hash. So a hash that a third of
all documents hold reaches its bucket once per block, and both blocks and
buckets are of bounded size whatever the data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text of a block, on average.
BLOCK_BYTES = 8 << 20


def texts_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; rows without a doc_id cannot be named in a result and are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        F.col("doc_id").isNotNull()
    )


def count_blocks(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks that these texts fill, from the bytes of all of them."""
    total = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def by_hash(texts: DataFrame, blocks: int) -> DataFrame:
    """``texts`` with a ``block``, dealt out by the id."""
    return texts.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"), *texts.columns)


def by_order(texts: DataFrame, blocks: int) -> DataFrame:
    """``(block, doc_id, text)``: blocks are ranges of ids in ascending order, of about as many rows each.

    The driver gets one number per block, the smallest id in it.
    """
    ids = texts.select("doc_id").repartitionByRange(blocks, "doc_id")
    lows = ids.groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("low")).orderBy("low").collect()
    bounds = np.array([row["low"] for row in lows[1:]], dtype=np.int64)

    @F.pandas_udf("int")
    def block_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, doc_id.to_numpy(), side="right").astype(np.int32))

    return texts.select(block_of("doc_id").alias("block"), "doc_id", "text")


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a hash, by its upper half."""
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Whether a sorted row differs from the one before it."""
    new = np.ones(len(keys[0]), dtype=bool)
    for k in keys:
        if k is keys[0]:
            new[1:] = k[1:] != k[:-1]
        else:
            new[1:] |= k[1:] != k[:-1]
    return new


def column(table: pa.Table, name: str, dtype=np.int64) -> np.ndarray:
    """A column without nulls."""
    return table.column(name).to_numpy().astype(dtype, copy=False)


def of_group(function, **fixed):
    """``function`` with fixed arguments, as Spark wants it for a group: from a table to a table."""

    def apply(table: pa.Table) -> pa.Table:
        return function(table, **fixed)

    return apply


def of_groups(function, **fixed):
    """The same for a pair of groups."""

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        return function(left, right, **fixed)

    return apply


def table_of(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)
