"""Ranked retrieval, its evaluation, the parameter sweep, and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import evaluation, ranking
from textloom.operators.evaluation import METRICS
from textloom.plans import sweep as plans
from textloom.registry import sql
from textloom.registry.base import query, rounded
from textloom.session import materialize
from textloom.sources import reports

CUT = 10
LAM = 0.1

_JM = sql.jm("0.1::DOUBLE")
_RUN = f"WITH {sql.MATCHES}, {sql.ranked(_JM)}"
_MEASURED = f"{_RUN}, {sql.QRELS}, {sql.measured()}"


def _lm_run(ws):
    return ranking.search(ws.index, ws.queries, "jm", CUT, lam=LAM)


@query("search_jm", f"{_RUN} SELECT query_id, rank, doc_id, round(score, 6) AS score FROM run")
def search_jm(ws):
    return rounded(_lm_run(ws).withColumn("rank", F.col("rank").cast("long")), "score")


@query(
    "search_classic",
    f"""WITH {sql.MATCHES}, {sql.ranked(sql.CLASSIC)}
    SELECT query_id, rank, doc_id, round(score, 6) AS score FROM run""",
)
def search_classic(ws):
    run = ranking.search(ws.index, ws.queries, "classic", CUT)
    return rounded(run.withColumn("rank", F.col("rank").cast("long")), "score")


@query("judgements", f"WITH {sql.QRELS} SELECT query_id, doc_id FROM qrels")
def judgements(ws):
    return ws.qrels


@query(
    "relevance_report",
    f"""{_RUN}, {sql.QRELS}
    SELECT r.query_id, r.rank, r.doc_id, round(r.score, 6) AS score, d.lang, d.source, d.text,
        CASE WHEN j.doc_id IS NULL THEN 'no' ELSE 'yes' END AS relevant
    FROM run r JOIN documents d USING (doc_id)
        LEFT JOIN qrels j ON j.query_id = r.query_id AND j.doc_id = r.doc_id""",
)
def relevance_report(ws):
    # Judged first: texts are fetched for the hits and moved no more.
    judged = materialize(evaluation.relevance_report(_lm_run(ws), ws.qrels), "judged-run")
    report = ranking.with_document(judged, ws.documents, "lang", "source", "text")
    return rounded(report.withColumn("rank", F.col("rank").cast("long")), "score")


def _metric(name: str, metric: str) -> None:
    @query(name, f"{_MEASURED} SELECT query_id, round({metric}, 6) AS value FROM pq")
    def one_metric(ws):
        measured = evaluation.per_query_metrics(_lm_run(ws), ws.qrels, ws.queries, CUT)
        return rounded(measured.select("query_id", F.col(metric).alias("value")), "value")


_metric("precision_at", "precision")
_metric("precision_retrieved", "precision_retrieved")
_metric("recall_at", "recall")
_metric("average_precision", "average_precision")


@query(
    "residual_precision",
    f"""WITH {sql.MATCHES}, {sql.ranked(_JM)},
    qrels AS (SELECT b.item_id AS query_id, d.doc_id FROM benchmark b
        JOIN documents d ON contains(lower(d.text), lower(b.text)) ANTI JOIN labels l ON l.doc_id = d.doc_id),
    {sql.measured()} SELECT query_id, round(precision, 6) AS value FROM pq""",
)
def residual_precision(ws):
    """Precision where already labelled documents no longer count as relevant."""
    residual = ws.qrels.join(ws.table("labels").select("doc_id").distinct(), "doc_id", "left_semi")
    measured = evaluation.per_query_metrics(_lm_run(ws), ws.qrels, ws.queries, CUT, residual=residual)
    return rounded(measured.select("query_id", F.col("precision").alias("value")), "value")


_MEANS = ", ".join(f"round(avg({m}), 6) AS mean_{m}" for m in METRICS)


@query("mean_metrics", f"{_MEASURED} SELECT count(*) AS n_queries, {_MEANS} FROM pq")
def mean_metrics(ws):
    measured = evaluation.per_query_metrics(_lm_run(ws), ws.qrels, ws.queries, CUT)
    return rounded(evaluation.mean_metrics(measured), *[f"mean_{m}" for m in METRICS])


_SWEEP = f"""WITH {sql.MATCHES}, {sql.QRELS},
grid AS (SELECT unnest(range(1, 10)) / 10 AS lam),
s AS (SELECT lam, query_id, doc_id, {sql.jm("lam")} AS score FROM m CROSS JOIN grid GROUP BY ALL),
run AS (SELECT lam, query_id, doc_id,
    row_number() OVER (PARTITION BY lam, query_id ORDER BY score DESC, doc_id) AS rank FROM s QUALIFY rank <= 10),
w AS (SELECT r.lam, r.query_id, r.rank, CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END AS rel,
    sum(CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END)
        OVER (PARTITION BY r.lam, r.query_id ORDER BY r.rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
    FROM run r LEFT JOIN qrels j ON j.query_id = r.query_id AND j.doc_id = r.doc_id),
t AS (SELECT lam, query_id, sum(CASE WHEN rel = 1 THEN so_far / rank ELSE 0 END) AS precisions FROM w GROUP BY ALL),
j AS (SELECT query_id, count(*) AS judged FROM qrels GROUP BY query_id),
half AS (SELECT (min(item_id) + max(item_id)) // 2 AS middle FROM benchmark),
pq AS (SELECT g.lam, b.item_id AS query_id, b.item_id <= middle AS train,
        CASE WHEN judged > 0 THEN coalesce(precisions, 0) / judged ELSE 0 END AS value
    FROM benchmark b CROSS JOIN grid g CROSS JOIN half LEFT JOIN t ON t.lam = g.lam AND t.query_id = b.item_id
        LEFT JOIN j ON j.query_id = b.item_id),
means AS (SELECT lam, avg(value) AS mean_value FROM pq WHERE train GROUP BY lam),
best AS (SELECT lam, mean_value FROM means ORDER BY round(mean_value, 9) DESC, lam LIMIT 1)"""


def _sweep(ws, queries):
    return plans.sweep(ws.index, queries, ws.qrels, CUT).select(
        "lam", "query_id", F.col("average_precision").alias("value")
    )


def _part(ws, half: int):
    return ranking.select_queries(ws.queries, ws.query_halves[half])


@query("lambda_sweep", f"{_SWEEP} SELECT lam, query_id, round(value, 6) AS value FROM pq")
def lambda_sweep(ws):
    return rounded(_sweep(ws, ws.queries), "value")


@query("lambda_best", f"{_SWEEP} SELECT lam, round(mean_value, 6) AS mean_value FROM best")
def lambda_best(ws):
    measured = plans.sweep(ws.index, _part(ws, 0), ws.qrels, CUT)
    return rounded(plans.best_lambda(plans.lambda_means(measured, "MAP")), "mean_value")


@query(
    "train_test_jm",
    f"{_SWEEP} SELECT lam, query_id, round(value, 6) AS value FROM pq JOIN best USING (lam) WHERE NOT train",
)
def train_test_jm(ws):
    lam, values = plans.train_test(ws.index, _part(ws, 0), _part(ws, 1), ws.qrels, "MAP", CUT)
    return rounded(values.select(F.lit(lam).alias("lam"), "query_id", "value"), "value")


@query(
    "test_classic",
    f"""WITH {sql.MATCHES}, {sql.ranked(sql.CLASSIC)}, {sql.QRELS}, {sql.measured()}
    SELECT query_id, round(average_precision, 6) AS value FROM pq
    WHERE query_id > (SELECT (min(item_id) + max(item_id)) // 2 FROM benchmark)""",
)
def test_classic(ws):
    _, values = plans.train_test(ws.index, _part(ws, 0), _part(ws, 1), ws.qrels, "MAP", CUT, model="classic")
    return rounded(values, "value")


_LAM_COLUMNS = [f"lambda_{i}" for i in range(1, 10)]


@query(
    "sweep_pivot",
    f"""{_SWEEP}, p AS (SELECT query_id, {", ".join(
        f"max(value) FILTER (WHERE lam = {i} / 10) AS lambda_{i}" for i in range(1, 10))} FROM pq GROUP BY query_id)
    SELECT query_id, {", ".join(f"round({c}, 6) AS {c}" for c in _LAM_COLUMNS)} FROM p
    UNION ALL SELECT NULL, {", ".join(f"round(avg({c}), 6)" for c in _LAM_COLUMNS)} FROM p""",
)
def sweep_pivot(ws):
    values = materialize(_sweep(ws, ws.queries), "sweep")
    return rounded(reports.sweep_table(values, plans.lambda_grid()).toDF("query_id", *_LAM_COLUMNS), *_LAM_COLUMNS)
