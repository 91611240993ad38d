"""Reports: sweep and test tables, rankings, top terms; and reading them back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of the report layout.
CUT_WORD = "Corte"
METRIC_WORD = "metrica"
MEAN_ROW = "Promedio:"
QUERY_WORD = "query"
SEPARATOR = ";"


def sweep_table(values: DataFrame, grid: list[float]) -> DataFrame:
    """``(lam, query_id, value)`` as one row per query and one column per lambda, plus the row of means.

    The row of means has a null ``query_id``.
    """
    names = [f"lambda {lam}" for lam in grid]
    table = values.groupBy("query_id").pivot("lam", grid).agg(F.first("value")).toDF("query_id", *names)
    means = table.agg(*[F.avg(f"`{n}`").alias(n) for n in names]).withColumn("query_id", F.lit(None).cast("long"))
    return table.unionByName(means)


def run_table(values: DataFrame, label: str) -> DataFrame:
    """``(query_id, value)`` with one value column ``label``, plus the row of means."""
    table = values.select("query_id", F.col("value").alias(label))
    means = table.agg(F.avg(f"`{label}`").alias(label)).withColumn("query_id", F.lit(None).cast("long"))
    return table.unionByName(means)


def write_report(table: DataFrame, path: str, metric: str, cut: int) -> None:
    """Write a sweep or run table: a heading with cut and metric, queries in order, means last."""
    values = [c for c in table.columns if c != "query_id"]
    first = F.coalesce(F.concat(F.lit(QUERY_WORD + " "), F.col("query_id").cast("string")), F.lit(MEAN_ROW))
    ordered = table.orderBy(F.col("query_id").asc_nulls_last())
    heading = f"{CUT_WORD}={cut} & {METRIC_WORD}={metric}"
    ordered.select(first.alias(heading), *[F.col(f"`{v}`") for v in values]).write.csv(path, sep=SEPARATOR, header=True)


def read_run_results(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """``(run_id, query_id, metric, cut, value)`` of a run report; heading and means are skipped."""
    report = spark.read.csv(path, sep=SEPARATOR, header=True)
    heading = report.columns[0]
    found = re.fullmatch(rf"{CUT_WORD}=(\d+) & {METRIC_WORD}=(.+)", heading)
    if not found:
        raise ValueError(f"not a report: the heading is {heading!r}")
    query_id = F.regexp_extract(F.col(f"`{heading}`"), rf"^{QUERY_WORD} ?(\d+)$", 1)
    return report.select(
        F.lit(run_id).alias("run_id"),
        F.nullif(query_id, F.lit("")).cast("long").alias("query_id"),
        F.lit(found[2]).alias("metric"),
        F.lit(int(found[1])).alias("cut"),
        F.col(f"`{report.columns[1]}`").cast("double").alias("value"),
    ).where("query_id IS NOT NULL")


def report_name(run: str, train: str | None, test: str, metric: str, cut: int) -> str:
    """The dotted name of a test report; ``train`` is the training range, or none for the classic model."""
    return f"{run}.training.{train or 'null'}.test.{test}.{metric.lower()}{cut}.test.csv"


def read_named_results(spark: SparkSession, path: str) -> DataFrame:
    """All reports below ``path`` in one scan, with what their names tell.

    ``(run_id, test_from, test_to, metric, cut, query_id, value)``; lines of
    heading and means are skipped.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", "_metadata.file_path")
    name = F.regexp_extract("file_path", r"([^/]+\.test\.csv)(?:/[^/]*)?$", 1)
    row = rf"^{QUERY_WORD} ?(\d+){SEPARATOR}([^{SEPARATOR}]+)"
    return lines.where(F.col("value").rlike(row)).select(
        *parse_run_name(name),
        F.regexp_extract("value", row, 1).cast("long").alias("query_id"),
        F.regexp_extract("value", row, 2).cast("double").alias("value"),
    )


def parse_run_name(name: Column) -> list[Column]:
    """Run, test range, metric and cut of a dotted report name, as ``run_id, test_from, test_to, metric, cut``."""
    pattern = r"\.test\.(\d+)-(\d+)\.([a-z]+)(\d+)\.test\.csv"
    return [
        F.regexp_extract(name, r"^(.*?)\.training\.", 1).alias("run_id"),
        F.regexp_extract(name, pattern, 1).cast("long").alias("test_from"),
        F.regexp_extract(name, pattern, 2).cast("long").alias("test_to"),
        F.upper(F.regexp_extract(name, pattern, 3)).alias("metric"),
        F.regexp_extract(name, pattern, 4).cast("int").alias("cut"),
    ]


def comparable(name_a: str, name_b: str) -> bool:
    """Whether two dotted report names agree in test range, metric and cut, i.e. from the first word ``test`` on."""
    tails = [name.split(".test.", 1) for name in (name_a, name_b)]
    return all(len(t) == 2 for t in tails) and tails[0][1] == tails[1][1]


def write_ranking_report(run: DataFrame, path: str) -> None:
    """Rankings or per-query metrics of several runs, one folder per ``run_id``."""
    run.hint("rebalance", "run_id").write.partitionBy("run_id").csv(path, sep=SEPARATOR, header=True)


def write_top_terms(terms: DataFrame, path: str) -> None:
    """Top terms in their order."""
    terms.write.csv(path, sep="\t", header=True)
