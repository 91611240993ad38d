"""Retrieval quality against relevance judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ["precision", "precision_retrieved", "recall", "average_precision"]


def mark_relevant(run: DataFrame, qrels: DataFrame, residual: DataFrame | None = None) -> DataFrame:
    """``run`` with ``rel`` 1 or 0. Pairs in ``residual`` count as not relevant."""
    if residual is not None:
        qrels = qrels.join(residual, ["query_id", "doc_id"], "left_anti")
    judged = qrels.select("query_id", "doc_id").distinct().withColumn("judged", F.lit(1))
    marked = run.join(judged, ["query_id", "doc_id"], "left")
    return marked.withColumn("rel", F.coalesce("judged", F.lit(0))).drop("judged")


def per_query_metrics(
    run: DataFrame,
    qrels: DataFrame,
    queries: DataFrame,
    cut: int,
    by: str | None = None,
    by_values: list | None = None,
    residual: DataFrame | None = None,
) -> DataFrame:
    """One row per query with all metrics at ``cut``.

    Every query gets a row: one that retrieves nothing or has no judgement
    scores 0. Where ``run`` holds several runs, ``by`` is the column that tells
    them apart and ``by_values`` their names, so that a run without any hit is
    not lost either. A residual document is not counted as a hit but stays in
    the number of judged documents.
    """
    if cut < 1:
        raise ValueError("cut must be positive")
    group = [by, "query_id"] if by else ["query_id"]
    marked = mark_relevant(run.where(F.col("rank") <= cut), qrels, residual)
    so_far = Window.partitionBy(*group).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    walked = marked.withColumn("hits_so_far", F.sum("rel").over(so_far))
    totals = walked.groupBy(*group).agg(
        F.sum("rel").alias("hits"),
        F.count("*").alias("retrieved"),
        F.sum(F.when(F.col("rel") == 1, F.col("hits_so_far") / F.col("rank")).otherwise(0.0)).alias("precisions"),
    )
    judged = qrels.select("query_id", "doc_id").distinct().groupBy("query_id").agg(F.count("*").alias("judged"))
    expected = queries.select("query_id").distinct()
    if by:
        expected = expected.select("query_id", F.explode(F.array(*[F.lit(v) for v in by_values])).alias(by))
    joined = expected.join(totals, group, "left").join(judged, "query_id", "left").na.fill(0)

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    return joined.select(
        *group,
        (F.col("hits") / F.lit(cut)).alias("precision"),
        ratio(F.col("hits"), F.col("retrieved")).alias("precision_retrieved"),
        ratio(F.col("hits"), F.col("judged")).alias("recall"),
        ratio(F.col("precisions"), F.col("judged")).alias("average_precision"),
    )


def long_form(metrics: DataFrame, cut: int, *keys: str) -> DataFrame:
    """``(…keys, query_id, metric, cut, value)``."""
    return metrics.unpivot([*keys, "query_id"], METRICS, "metric", "value").withColumn("cut", F.lit(cut))


def mean_metrics(metrics: DataFrame, *keys: str) -> DataFrame:
    """Means over all queries of the selection (mean average precision among them)."""
    return metrics.groupBy(*keys).agg(
        F.count("*").alias("n_queries"), *[F.avg(m).alias(f"mean_{m}") for m in METRICS]
    )


def relevance_report(run_with_text: DataFrame, qrels: DataFrame) -> DataFrame:
    """Per hit: rank, document, score, stored columns and whether it is relevant."""
    marked = mark_relevant(run_with_text, qrels)
    return marked.withColumn("relevant", F.when(F.col("rel") == 1, "yes").otherwise("no")).drop("rel")
