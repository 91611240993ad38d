"""Significance tests between runs."""

from __future__ import annotations

from textloom.operators import comparison, evaluation, ranking
from textloom.registry import sql
from textloom.registry.base import query, rounded
from textloom.session import materialize

CUT = 10
RUNS = {"classic": ("classic", 0.5), "jm_0.1": ("jm", 0.1), "jm_1.0": ("jm", 1.0)}
PAIRS = [("classic", "jm_0.1"), ("classic", "jm_1.0"), ("jm_0.1", "jm_1.0")]


def _runs_sql() -> str:
    scores = {"classic": sql.CLASSIC, "jm_0.1": sql.jm("0.1::DOUBLE"), "jm_1.0": sql.jm("1.0::DOUBLE")}
    parts, unions = [], []
    for i, (name, score) in enumerate(scores.items()):
        parts += [sql.ranked(score, CUT, f"r{i}"), sql.measured(CUT, f"r{i}", f"q{i}")]
        unions += [
            f"SELECT '{name}' AS run_id, query_id, '{m}' AS metric, {m} AS value FROM q{i}" for m in evaluation.METRICS
        ]
    pairs = ", ".join(f"('{a}', '{b}')" for a, b in PAIRS)
    return f"""WITH {sql.MATCHES}, {sql.QRELS}, {", ".join(parts)},
v AS ({" UNION ALL ".join(unions)}),
pairs(run_a, run_b) AS (VALUES {pairs}),
paired AS (SELECT p.run_a, p.run_b, a.metric, {CUT} AS cut, a.query_id, a.value AS a, b.value AS b
    FROM pairs p JOIN v a ON a.run_id = p.run_a
    JOIN v b ON b.run_id = p.run_b AND b.query_id = a.query_id AND b.metric = a.metric)"""


_PAIRED = _runs_sql()


def _values(ws):
    """All metrics of all runs: ``(run_id, query_id, metric, cut, value)``; computed once per workspace."""
    if "run-values" not in ws.kept:
        models = {name: ranking.contribution_of(*model) for name, model in RUNS.items()}
        runs = ranking.rank_models(ws.index, ws.queries, models, CUT)
        measured = evaluation.per_query_metrics(runs, ws.qrels, ws.queries, CUT, by="run_id", by_values=list(RUNS))
        ws.kept["run-values"] = materialize(evaluation.long_form(measured, CUT, "run_id"), "run-values")
    return ws.kept["run-values"]


def _paired(ws):
    return comparison.pair_runs(_values(ws), ws.spark.createDataFrame(PAIRS, "run_a STRING, run_b STRING"))


@query(
    "run_values",
    f"{_PAIRED} SELECT run_id, query_id, metric, CAST({CUT} AS INTEGER) AS cut, round(value, 6) AS value FROM v",
)
def run_values(ws):
    return rounded(_values(ws), "value")


@query(
    "paired_runs",
    f"""{_PAIRED} SELECT run_a, run_b, metric, CAST(cut AS INTEGER) AS cut, query_id, round(a, 6) AS a, round(b, 6) AS b
    FROM paired""",
)
def paired_runs(ws):
    return rounded(_paired(ws), "a", "b")


@query(
    "welch_statistics",
    f"""{_PAIRED}, s AS (SELECT run_a, run_b, metric, cut, count(*) AS n, avg(a) AS mean_a, avg(b) AS mean_b,
        var_samp(a) / count(*) AS sa, var_samp(b) / count(*) AS sb FROM paired GROUP BY ALL)
    SELECT run_a, run_b, metric, CAST(cut AS INTEGER) AS cut, n, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b,
        CASE WHEN sa + sb > 0 THEN round((mean_a - mean_b) / sqrt(sa + sb), 6) END AS t,
        CASE WHEN sa + sb > 0 THEN round(pow(sa + sb, 2) / (sa * sa / (n - 1) + sb * sb / (n - 1)), 6) END AS dof
    FROM s""",
)
def welch_statistics(ws):
    return rounded(comparison.welch_statistics(_paired(ws)), "mean_a", "mean_b", "t", "dof")


def _area(density: str, bound: str, keys: str, source: str) -> str:
    """CTE ``p(keys, p_value)``: two-sided tail area beyond ``bound``, by Simpson's rule on 2000 intervals."""
    return f"""p AS (SELECT {keys}, 1 - 2 * abs({bound}) / 6000 * sum(w * {density}) AS p_value FROM (
    SELECT *, abs({bound}) * i / 2000 AS x, CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
    FROM {source} CROSS JOIN (SELECT unnest(range(2001)) AS i)) GROUP BY {keys}, {bound})"""


_T_DENSITY = """exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi()) * pow(1 + x * x / dof, -(dof + 1) / 2)"""
_ALPHA = 0.05


@query(
    "welch_p_value",
    f"""{_PAIRED}, s AS (SELECT run_a, run_b, metric, count(*) AS n, avg(a) - avg(b) AS diff,
        var_samp(a) / count(*) AS sa, var_samp(b) / count(*) AS sb FROM paired GROUP BY ALL),
    w AS (SELECT run_a, run_b, metric, CASE WHEN sa + sb > 0 THEN diff / sqrt(sa + sb) END AS t,
        pow(sa + sb, 2) / (sa * sa / (n - 1) + sb * sb / (n - 1)) AS dof FROM s),
    {_area(_T_DENSITY, "t", "run_a, run_b, metric", "w")}
    SELECT run_a, run_b, metric, round(p_value, 6) AS p_value, p_value < {_ALPHA} AS reject FROM p""",
)
def welch_p_value(ws):
    tested = comparison.welch_t_test(_paired(ws), alpha=_ALPHA)
    return rounded(tested.select("run_a", "run_b", "metric", "p_value", "reject"), "p_value")


_SIGNED = f"""{_PAIRED}, d AS (SELECT run_a, run_b, metric, cut, round(b - a, 9) AS d FROM paired),
ranks AS (SELECT *, rank() OVER (PARTITION BY run_a, run_b, metric, cut ORDER BY abs(d))
    + (count(*) OVER (PARTITION BY run_a, run_b, metric, cut, abs(d)) - 1) / 2 AS r FROM d),
sums AS (SELECT run_a, run_b, metric, cut, count(*) AS n, sum(CASE WHEN d > 0 THEN r ELSE 0 END) AS w_plus
    FROM ranks GROUP BY ALL),
signed AS (SELECT *, n * (n + 1) / 2 - w_plus AS w_minus FROM sums)"""


@query(
    "wilcoxon_statistics",
    f"""{_SIGNED} SELECT run_a, run_b, metric, CAST(cut AS INTEGER) AS cut, n, round(w_plus, 6) AS w_plus,
        round(w_minus, 6) AS w_minus, round(greatest(w_plus, w_minus), 6) AS w FROM signed""",
)
def wilcoxon_statistics(ws):
    return rounded(comparison.wilcoxon_statistics(_paired(ws)), "w_plus", "w_minus", "w")


def _wilcoxon_p_sql(signed: str) -> str:
    """Exact, by the share of subsets of ranks of each sum."""
    return f"""WITH RECURSIVE {signed.removeprefix("WITH ")},
most AS (SELECT max(n) AS n FROM signed),
shares(r, c) AS (
    SELECT 0, list_transform(range((SELECT n * (n + 1) // 2 + 1 FROM most)), lambda s: CASE WHEN s = 0 THEN 1.0::DOUBLE ELSE 0 END)
    UNION ALL SELECT r + 1, list_transform(range(len(c)), lambda s: (c[s + 1] + CASE WHEN s > r THEN c[s - r] ELSE 0 END) / 2)
    FROM shares WHERE r < (SELECT n FROM most)),
e AS (SELECT g.run_a, g.run_b, g.metric, least(1, 2 * list_sum(c[CAST(ceil(greatest(w_plus, w_minus)) AS BIGINT) + 1:])) AS p_value
    FROM signed g JOIN shares ON r = n)
SELECT run_a, run_b, metric, round(p_value, 6) AS p_value, p_value < {_ALPHA} AS reject FROM e"""


_NORMAL_P_SQL = f"""{_SIGNED},
z AS (SELECT *, (least(w_plus, w_minus) - n * (n + 1) / 4 - 0.5::DOUBLE) / sqrt(n * (n + 1) * (2 * n + 1) / 24) AS z FROM signed),
{_area("exp(-x * x / 2) / sqrt(2 * pi())", "z", "run_a, run_b, metric", "z")}
SELECT run_a, run_b, metric, round(least(1, p_value), 6) AS p_value, p_value < {_ALPHA} AS reject FROM p"""


def _wilcoxon(ws, values, method="exact"):
    pairs = ws.spark.createDataFrame(PAIRS, "run_a STRING, run_b STRING")
    tested = comparison.compare_runs(values, pairs, "wilcoxon", _ALPHA, method)
    return rounded(tested.select("run_a", "run_b", "metric", "p_value", "reject"), "p_value")


@query("wilcoxon_p_value", _wilcoxon_p_sql(_SIGNED))
def wilcoxon_p_value(ws):
    return _wilcoxon(ws, _values(ws))


@query("wilcoxon_normal_p_value", _NORMAL_P_SQL)
def wilcoxon_normal_p_value(ws):
    return _wilcoxon(ws, _values(ws), "normal")


@query(
    "wilcoxon_test_half",
    _wilcoxon_p_sql(
        _SIGNED.replace(
            "AS d FROM paired",
            "AS d FROM paired WHERE query_id > (SELECT (min(item_id) + max(item_id)) // 2 FROM benchmark)",
        )
    ),
)
def wilcoxon_test_half(ws):
    """The same on the test part of the queries, as after a sweep on the training part."""
    test = ranking.select_queries(ws.queries, ws.query_halves[1]).select("query_id")
    return _wilcoxon(ws, _values(ws).join(test, "query_id", "left_semi"))
