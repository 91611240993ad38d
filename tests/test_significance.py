import itertools

import pytest

from textloom.functions.significance import normal_two_sided, student_t_two_sided
from textloom.operators import comparison

SCHEMA = "run_id STRING, query_id BIGINT, metric STRING, cut INT, value DOUBLE"


def values(spark, a, b):
    rows = [("a", i, "MAP", 10, float(v)) for i, v in enumerate(a)] + [("b", i, "MAP", 10, float(v)) for i, v in enumerate(b)]
    return spark.createDataFrame(rows, SCHEMA)


def pairs(spark):
    return spark.createDataFrame([("a", "b")], "run_a STRING, run_b STRING")


def test_student_table_values(spark):
    # Critical values of t for two-sided p = 0.05 and 0.01.
    table = [(12.706205, 1, 0.05), (4.302653, 2, 0.05), (2.228139, 10, 0.05), (2.042272, 30, 0.05), (3.169273, 10, 0.01)]
    rows = spark.createDataFrame([(t, float(df), p) for t, df, p in table], "t DOUBLE, df DOUBLE, p DOUBLE")
    for r in rows.withColumn("got", student_t_two_sided("t", "df")).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-6)
    zero = spark.createDataFrame([(0.0, 5.0), (None, None)], "t DOUBLE, df DOUBLE")
    assert [r["p"] for r in zero.select(student_t_two_sided("t", "df").alias("p")).collect()] == [pytest.approx(1.0), None]


def test_normal_table_values(spark):
    rows = spark.createDataFrame([(1.959964,), (-2.575829,), (0.0,)], "z DOUBLE")
    got = [r["p"] for r in rows.select(normal_two_sided("z").alias("p")).collect()]
    assert got == pytest.approx([0.05, 0.01, 1.0], abs=1e-6)


def test_welch_example(spark):
    # A worked example of the unequal-variance test with unequal spreads.
    a = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9, 16.9, 20.1, 21.9, 22.6, 23.1, 19.6, 19.0, 21.7, 21.4]
    b = [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0, 24.8, 20.2, 21.9, 22.1, 22.9, 30.5, 24.4]
    row = comparison.compare_runs(values(spark, a, b), pairs(spark), "t").first()
    n, ma, mb = len(a), sum(a) / len(a), sum(b) / len(b)
    va, vb = (sum((v - m) ** 2 for v in x) / (n - 1) / n for x, m in ((a, ma), (b, mb)))
    assert row["t"] == pytest.approx((ma - mb) / (va + vb) ** 0.5)
    assert row["dof"] == pytest.approx((va + vb) ** 2 / (va**2 / (n - 1) + vb**2 / (n - 1)))
    assert 0 < row["p_value"] < 0.05 and row["reject"]


def test_without_variance_nothing_is_tested(spark):
    row = comparison.compare_runs(values(spark, [1, 1], [1, 1]), pairs(spark), "t").first()
    assert row["t"] is None and row["p_value"] is None


def signed_rank(a, b):
    d = [round(y - x, 9) for x, y in zip(a, b)]
    size = sorted(abs(v) for v in d)
    rank = {s: size.index(s) + (size.count(s) + 1) / 2 for s in size}
    plus = sum(rank[abs(v)] for v in d if v > 0)
    n = len(d)
    return plus, n * (n + 1) / 2 - plus


@pytest.mark.parametrize(
    "a,b",
    [
        ([0.1, 0.2, 0.3, 0.4, 0.5], [0.2, 0.1, 0.6, 0.9, 0.5]),
        ([0.0, 0.0, 0.0], [0.0, 0.0, 0.0]),
        ([1, 2, 3, 4, 5, 6, 7, 8], [2, 4, 3, 8, 1, 12, 9, 9]),
    ],
)
def test_signed_ranks_and_exact_p(spark, a, b):
    row = comparison.compare_runs(values(spark, a, b), pairs(spark), "wilcoxon").first()
    plus, minus = signed_rank(a, b)
    assert (row["w_plus"], row["w_minus"], row["w"]) == (plus, minus, max(plus, minus))
    n = len(a)
    signs = itertools.product((0, 1), repeat=n)
    upper = sum(sum(r for r, s in zip(range(1, n + 1), pattern) if s) >= row["w"] for pattern in signs)
    assert row["p_value"] == pytest.approx(min(1.0, 2 * upper / 2**n))


def test_method_does_not_depend_on_the_number_of_queries(spark):
    import math

    a, b = [i / 100 for i in range(40)], [i / 100 + (0.011 * (i % 7) - 0.02) for i in range(40)]
    plus, minus = signed_rank(a, b)
    z = (min(plus, minus) - 40 * 41 / 4 - 0.5) / (40 * 41 * 81 / 24) ** 0.5
    normal = comparison.compare_runs(values(spark, a, b), pairs(spark), "wilcoxon", method="normal").first()
    assert normal["p_value"] == pytest.approx(min(1.0, math.erfc(abs(z) / math.sqrt(2))))
    counts = [1]  # subsets of ranks by their sum
    for r in range(1, 41):
        counts = [x + y for x, y in zip(counts + [0] * r, [0] * r + counts)]
    exact = comparison.compare_runs(values(spark, a, b), pairs(spark), "wilcoxon").first()
    tail = sum(counts[math.ceil(max(plus, minus)) :])
    assert exact["p_value"] == pytest.approx(min(1.0, 2 * tail / 2**40))
    with pytest.raises(ValueError, match="method"):
        comparison.compare_runs(values(spark, a, b), pairs(spark), "wilcoxon", method="auto")


def test_runs_are_paired_by_query_metric_and_cut(spark):
    rows = [("a", 1, "MAP", 10, 0.5), ("a", 2, "MAP", 10, 0.6), ("b", 2, "MAP", 10, 0.7), ("b", 1, "MAP", 5, 0.1)]
    paired = comparison.pair_runs(spark.createDataFrame(rows, SCHEMA), pairs(spark)).collect()
    assert [(r["query_id"], r["a"], r["b"]) for r in paired] == [(2, 0.6, 0.7)]


def test_unknown_test_is_refused(spark):
    with pytest.raises(ValueError):
        comparison.compare_runs(values(spark, [1], [2]), pairs(spark), "sign")


def test_many_queries_take_seconds_and_keep_their_digits(spark, monkeypatch):
    import time

    from pyspark.sql import functions as F

    from textloom.functions import significance

    rows = [(n, n * (n + 1) / 4 + z * (n * (n + 1) * (2 * n + 1) / 24) ** 0.5) for n in (150, 333, 600) for z in (0, 0.5, 2, 5, 7.5)]
    frame = spark.createDataFrame([(n, float(round(2 * w) / 2)) for n, w in rows], "n BIGINT, w DOUBLE")

    def p_values():
        return [r["p"] for r in frame.select(significance.exact_signed_rank_p(F.col("n"), F.col("w")).alias("p")).collect()]

    counted = p_values()
    monkeypatch.setattr(significance, "COUNTED", 100)
    assert p_values() == pytest.approx(counted, rel=1e-8)
    assert min(counted) < 1e-12
    monkeypatch.setattr(significance, "COUNTED", 600)
    start = time.perf_counter()
    n = 70_000
    large = spark.createDataFrame([(5_000, 6_400_000.0), (n, n * (n + 1) / 4 + 3 * (n**3 / 12) ** 0.5)], "n BIGINT, w DOUBLE")
    got = [r["p"] for r in large.select(significance.exact_signed_rank_p(F.col("n"), F.col("w")).alias("p")).collect()]
    import math

    for (ranks, w), p in zip([(5_000, 6_400_000.0), (n, n * (n + 1) / 4 + 3 * (n**3 / 12) ** 0.5)], got):
        z = (w - 0.5 - ranks * (ranks + 1) / 4) / (ranks * (ranks + 1) * (2 * ranks + 1) / 24) ** 0.5
        assert p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-2)
    assert time.perf_counter() - start < 30
