"""Choice of the smoothing parameter on training queries, check on test queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import weights
from textloom.operators import evaluation, ranking
from textloom.operators.evaluation import METRICS
from textloom.operators.ranking import SCORE_DIGITS

# Metric names of the reports.
METRIC_NAMES = {"P": "precision_retrieved", "R": "recall", "MAP": "average_precision"}


def lambda_grid() -> list[float]:
    """0.1 to 0.9 by 0.1."""
    return [i / 10 for i in range(1, 10)]


def sweep_runs(index, queries: DataFrame, k: int, grid: list[float], field: str = "text") -> DataFrame:
    """``(lam, query_id, rank, doc_id, score)`` for the whole grid, matched once."""
    contributions = {lam: weights.smoothed_likelihood(lam) for lam in grid}
    return ranking.rank_models(index, queries, contributions, k, "lam", field)


def sweep(
    index, queries: DataFrame, qrels: DataFrame, cut: int, grid: list[float] | None = None, field: str = "text"
) -> DataFrame:
    """All metrics per grid value and query: ``(lam, query_id, …metrics)``."""
    grid = grid or lambda_grid()
    runs = sweep_runs(index, queries, cut, grid, field)
    return evaluation.per_query_metrics(runs, qrels, queries, cut, by="lam", by_values=grid)


def lambda_means(per_query: DataFrame, metric: str) -> DataFrame:
    """``(lam, mean_value)``."""
    return per_query.groupBy("lam").agg(F.avg(_column(metric)).alias("mean_value"))


def best_lambda(means: DataFrame) -> DataFrame:
    """The value of greatest mean; the smallest of equally good ones."""
    return means.orderBy(F.desc(F.round("mean_value", SCORE_DIGITS)), "lam").limit(1)


def split_queries(queries: DataFrame, train: str, test: str) -> DataFrame:
    """Queries with ``part`` = ``train`` or ``test``, by two inclusive id ranges."""
    parts = [
        ranking.select_queries(queries, spec).withColumn("part", F.lit(part))
        for part, spec in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1])


def train_test(
    index,
    train: DataFrame,
    test: DataFrame,
    qrels: DataFrame,
    metric: str,
    cut: int,
    model: str = "jm",
    field: str = "text",
) -> tuple[float | None, DataFrame]:
    """The chosen lambda and the test queries' ``(query_id, value)`` with it.

    ``model="classic"`` has no parameter, so it is only tested.
    """
    lam = None
    if model == "jm":
        lam = best_lambda(lambda_means(sweep(index, train, qrels, cut, field=field), metric)).first()["lam"]
    run = ranking.search(index, test, model, cut, field, lam or 0.5)
    measured = evaluation.per_query_metrics(run, qrels, test, cut)
    return lam, measured.select("query_id", F.col(_column(metric)).alias("value"))


def _column(metric: str) -> str:
    name = METRIC_NAMES.get(metric, metric)
    if name not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {[*METRIC_NAMES, *METRICS]}")
    return name
