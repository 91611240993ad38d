"""Collections as tables: create, upsert, partition, dump."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_collection(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Create: drop what exists at ``path`` and write all.

    With ``partition_by`` one folder per value is written. The rebalance hint
    lets Spark split a folder that holds most of the rows over several tasks and
    merge small ones.
    """
    writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write
    writer.mode("overwrite").parquet(path)


def upsert_documents(existing: DataFrame, incoming: DataFrame, key: str = "doc_id", order: str | None = None) -> DataFrame:
    """``existing`` with the documents of ``incoming`` in place of those of the same key, and the new ones added.

    Of several incoming rows of one key the last by the column ``order`` counts,
    which the result does not keep; without ``order`` they are an error.
    """
    if order:
        last = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc_nulls_last()))
        incoming = incoming.withColumn("_place", last).where("_place = 1").drop("_place", order)
    else:
        repeated = F.raise_error(F.concat(F.lit(f"{key} comes more than once: "), F.col(key).cast("string")))
        rows = F.count("*").over(Window.partitionBy(key))
        incoming = incoming.withColumn("_rows", rows).where(F.when(F.col("_rows") > 1, repeated.cast("boolean")).otherwise(True))
        incoming = incoming.drop("_rows")
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming)


def update_collection(
    spark: SparkSession, source: str, incoming: DataFrame, target: str, key: str = "doc_id", create: bool = False
) -> None:
    """Upsert ``incoming`` into the collection at ``source``, written to the new path ``target``.

    ``create`` tolerates a missing ``source``; without it that is an error. An
    input path is never overwritten, so a lost task can always be run again.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the target must be a new path")
    try:
        existing = spark.read.parquet(source)
    except AnalysisException:
        if not create:
            raise
        incoming.write.parquet(target)
        return
    upsert_documents(existing, incoming, key).write.parquet(target)


def partition_by_top_folder(docs: DataFrame, rel_path: str = "rel_path") -> DataFrame:
    """``docs`` with ``top_folder``; documents directly in the root are left out."""
    parts = F.split(F.col(rel_path), "/")
    return docs.where(F.size(parts) > 1).withColumn("top_folder", F.get(parts, F.lit(0)))


def dump_collection(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """All stored fields as ``(doc_id, field, value)``."""
    columns = [c for c in docs.columns if c != doc_id]
    return docs.select(doc_id, *[F.col(c).cast("string") for c in columns]).unpivot([doc_id], columns, "field", "value")


def write_dump(docs: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """The same as text, one block per document: a ``docID`` line, then ``field: value`` lines."""
    columns = [c for c in docs.columns if c != doc_id]
    lines = [F.concat(F.lit("docID "), F.col(doc_id).cast("string"))]
    lines += [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    docs.select(F.concat_ws("\n", F.lit(""), *lines).alias("value")).write.text(path)
