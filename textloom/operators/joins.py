"""Joins that stay safe when a side grows or a key is hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if it is measured to be below both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20

# Document frequencies are told apart by so many classes per doubling.
DF_CLASSES = 8

# A term is hot if it holds more than 1/HOT_SHARE of all postings; so at most HOT_SHARE terms are hot.
HOT_SHARE = 10_000


def _width(df: DataFrame) -> Column:
    """Approximate bytes of a row."""
    width = F.lit(0)
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
        elif isinstance(field.dataType, T.ArrayType):
            width = width + F.coalesce(F.size(field.name), F.lit(0)) * 24 + 8
        else:
            width = width + 8
    return width


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, by one aggregation."""
    row = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(_width(df)), F.lit(0)).alias("bytes")).first()
    return row["rows"], row["bytes"]


def is_small(df: DataFrame, size: tuple[int, int] | None = None, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` may be broadcast; ``size`` saves measuring where it is already known."""
    rows, nbytes = size or measured_size(df)
    return rows <= max_rows and nbytes <= MAX_BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, size: tuple[int, int] | None = None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if measured small; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if is_small(df, size, max_rows) else df


def join_on_term(
    postings: DataFrame,
    by_term: DataFrame,
    size: tuple[int, int] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """``postings`` ⋈ ``by_term`` on (field, term); ``by_term`` carries ``df``. See ``parts_on_term``."""
    return reduce(DataFrame.unionByName, parts_on_term(postings, by_term, size, max_rows, hot_share))


def parts_on_term(
    postings: DataFrame,
    by_term: DataFrame,
    size: tuple[int, int] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> list[DataFrame]:
    """``join_on_term`` in parts, of which the first does not move the postings.

    A small right side is broadcast. Of a large one the most frequent terms are, as
    many as stay below the bounds: few terms have most of the postings. Postings of the
    others are left for a second part, which is a shuffle.
    """
    keys = ["field", "term"]
    if is_small(by_term, size, max_rows):
        return [postings.join(F.broadcast(by_term), keys)]
    df_class = F.floor(F.log2("df") * DF_CLASSES)
    classes = by_term.groupBy(df_class.alias("class")).agg(F.count("*").alias("rows"), F.sum(_width(by_term)).alias("bytes"))
    least, rows, nbytes = None, 0, 0
    for row in sorted(classes.collect(), reverse=True):
        rows, nbytes = rows + row["rows"], nbytes + row["bytes"]
        if not is_small(by_term, (rows, nbytes), max_rows):
            break
        least = row["class"]
    if least is None:
        return [_salted_join(postings, by_term, hot_share)]
    frequent = by_term.where(df_class >= least)
    others = postings.join(F.broadcast(frequent.select(keys)), keys, "left_anti")
    return [postings.join(F.broadcast(frequent), keys), _salted_join(others, by_term.where(df_class < least), hot_share)]


def _salted_join(postings: DataFrame, by_term: DataFrame, hot_share: int) -> DataFrame:
    """The join by a shuffle in which the rows of a hot term are spread over several partitions.

    The list of hot terms is broadcast: document frequencies add up to the number
    of postings, so no more than ``hot_share`` terms can exceed the threshold,
    whatever the data.
    """
    keys = ["field", "term"]
    total = by_term.select(*keys, "df").distinct().agg(F.sum("df")).first()[0] or 0
    chunk = max(total // hot_share, 1)
    copies = F.ceil(F.col("df") / F.lit(chunk)).cast("int")
    hot = by_term.where(copies > 1).select(*keys, copies.alias("copies")).distinct()
    left = (
        postings.join(F.broadcast(hot), keys, "left")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("copies")), F.lit(0)).cast("int"))
        .drop("copies")
    )
    right = by_term.withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1)))
    return left.join(right, [*keys, "salt"]).drop("salt")
