"""Significance tests between runs, for any number of run pairs in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.significance import exact_signed_rank_p, normal_two_sided, student_t_two_sided

PAIR = ["run_a", "run_b", "metric", "cut"]


def pair_runs(values: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(run_a, run_b, metric, cut, query_id, a, b)``, aligned by query, metric and cut.

    ``values`` is ``(run_id, query_id, metric, cut, value)``; ``pairs`` names the
    comparisons ``(run_a, run_b)``. Only queries that both runs have are paired.
    """
    side_a = pairs.join(values.withColumnsRenamed({"run_id": "run_a", "value": "a"}), "run_a")
    side_b = values.withColumnsRenamed({"run_id": "run_b", "value": "b"})
    return side_a.join(side_b, ["run_b", "query_id", "metric", "cut"]).select(*PAIR, "query_id", "a", "b")


def welch_statistics(paired: DataFrame) -> DataFrame:
    """t and degrees of freedom of the two-sample test with unequal variances.

    This is the unpaired test, although the values are paired by query; see
    ``wilcoxon_statistics`` for a paired one. Without variance t is null.
    """
    moments = paired.groupBy(*PAIR).agg(
        F.count("*").alias("n"),
        F.avg("a").alias("mean_a"),
        F.avg("b").alias("mean_b"),
        (F.var_samp("a") / F.count("*")).alias("se_a"),
        (F.var_samp("b") / F.count("*")).alias("se_b"),
    )
    se = F.col("se_a") + F.col("se_b")
    spread = F.col("se_a") * F.col("se_a") / (F.col("n") - 1) + F.col("se_b") * F.col("se_b") / (F.col("n") - 1)
    known = se > 0
    return moments.select(
        *PAIR,
        "n",
        "mean_a",
        "mean_b",
        F.when(known, (F.col("mean_a") - F.col("mean_b")) / F.sqrt(se)).alias("t"),
        F.when(known, se * se / spread).alias("dof"),
    )


def welch_t_test(paired: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``welch_statistics`` with the two-sided ``p_value`` and whether it is below ``alpha``."""
    tested = welch_statistics(paired).withColumn("p_value", student_t_two_sided("t", "dof"))
    return tested.withColumn("reject", F.col("p_value") < alpha)


def wilcoxon_statistics(paired: DataFrame) -> DataFrame:
    """Signed-rank sums: ``(…, n, w_plus, w_minus, w)``, with ``w`` the greater sum.

    Ranks are those of ``|b - a|``, ties get the mean rank, and zero differences
    keep their ranks, which count on the negative side. Equal differences are
    counted together before anything is ordered.
    """
    difference = F.round(F.col("b") - F.col("a"), 9)
    tied = (
        paired.select(*PAIR, difference.alias("d"))
        .groupBy(*PAIR, F.abs("d").alias("size"))
        .agg(F.count("*").alias("ties"), F.count_if(F.col("d") > 0).alias("positive"))
    )
    up_to = Window.partitionBy(*PAIR).orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    ranked = tied.withColumn("rank", F.sum("ties").over(up_to) - (F.col("ties") - 1) / 2)
    sums = ranked.groupBy(*PAIR).agg(
        F.sum("ties").alias("n"), F.sum(F.col("positive") * F.col("rank")).cast("double").alias("w_plus")
    )
    all_ranks = F.col("n") * (F.col("n") + 1) / 2
    minus = sums.withColumn("w_minus", all_ranks - F.col("w_plus"))
    return minus.withColumn("w", F.greatest("w_plus", "w_minus"))


def wilcoxon_signed_rank(paired: DataFrame, alpha: float = 0.05, method: str = "exact") -> DataFrame:
    """``wilcoxon_statistics`` with ``p_value``: ``exact`` at any number of queries, or by the ``normal`` approximation."""
    if method not in ("exact", "normal"):
        raise ValueError("method must be 'exact' or 'normal'")
    n = F.col("n")
    if method == "exact":
        p_value = exact_signed_rank_p(n, F.col("w"))
    else:
        deviation = F.sqrt(n * (n + 1) * (2 * n + 1) / 24)
        z = (F.least("w_plus", "w_minus") - n * (n + 1) / 4 - 0.5) / deviation
        p_value = F.least(F.lit(1.0), normal_two_sided(z))
    tested = wilcoxon_statistics(paired).withColumn("p_value", p_value)
    return tested.withColumn("reject", F.col("p_value") < alpha)


def compare_runs(values: DataFrame, pairs: DataFrame, test: str, alpha: float = 0.05, method: str = "exact") -> DataFrame:
    """All ``pairs`` for every metric and cut they share, by ``t`` or ``wilcoxon`` (its ``method``)."""
    if test not in ("t", "wilcoxon"):
        raise ValueError("test must be 't' or 'wilcoxon'")
    paired = pair_runs(values, pairs)
    return welch_t_test(paired, alpha) if test == "t" else wilcoxon_signed_rank(paired, alpha, method)
