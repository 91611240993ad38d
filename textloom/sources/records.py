"""Marked records (``.I id`` / ``.W`` / text lines) and judgement files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx

# Fixed values of the record format.
ID_MARK = ".I "
TEXT_MARK = ".W"


def read_marked_records(spark: SparkSession, path: str) -> DataFrame:
    """``(id, text)``; the lines of a record are joined by one blank, empty lines at its end dropped.

    The record mark is the line separator of the scan, so a large file is split
    over tasks at record borders. It counts at the start of a line only.
    """
    records = spark.read.option("lineSep", "\n" + ID_MARK).text(path)
    return parse_marked_records(records)


def parse_marked_records(records: DataFrame) -> DataFrame:
    """Split each record (column ``value``) into id and text; a record without a numeric id raises an error."""
    body = F.regexp_replace("value", r"\r\n", "\n")
    # Only the first record of a file still has its mark.
    body = F.regexp_replace(body, r"\A\.I ", "")
    record_id = F.regexp_extract(body, r"\A\s*(\d+)", 1)
    text = F.regexp_replace(body, r"\A\s*\d+[^\n]*(?:\n\.W[^\n]*)?(?:\n|\z)", "")
    text = F.regexp_replace(text, r"[\r\n]+\z", "")
    bad = F.raise_error(F.concat(F.lit("record without a numeric id: "), F.substring(body, 1, 40))).cast("string")
    number = F.when(record_id == "", bad).otherwise(record_id).cast("long")
    return records.where(F.trim(body) != "").select(number.alias("id"), tx.join_lines(text).alias("text"))


def write_marked_records(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` as marked records."""
    record = F.concat(F.lit(ID_MARK), F.col(doc_id).cast("string"), F.lit(f"\n{TEXT_MARK}\n"), F.col(text))
    docs.select(record.alias("value")).write.text(path)


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, doc_id)``, distinct, from lines ``query 0 doc flag``; the flag is ignored."""
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(
        F.get(parts, F.lit(0)).cast("long").alias("query_id"), F.get(parts, F.lit(2)).cast("long").alias("doc_id")
    ).distinct()


def write_qrels(qrels: DataFrame, path: str) -> None:
    line = F.concat_ws(" ", F.col("query_id").cast("string"), F.lit("0"), F.col("doc_id").cast("string"), F.lit("1"))
    qrels.select(line.alias("value")).write.text(path)
