"""Readers and writers, each over a whole table written by Spark and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import evaluation, ranking, top_terms
from textloom.operators.postings import stack_fields
from textloom.plans import index as index_plans
from textloom.registry import sql
from textloom.registry.base import query, rounded
from textloom.registry.text_queries import _LINES
from textloom.session import materialize, scratch_path
from textloom.sources import files, records, reports, tables


@query(
    "file_scan",
    f"""WITH f AS (SELECT page_id, 'host=' || regexp_extract(url, '://([^/]+)', 1) AS top_folder, html || chr(10) AS text
        FROM pages),
    l AS (SELECT *, strlen(text) AS size_bytes, {_LINES} AS lines FROM f)
    SELECT page_id, top_folder, 'regular file' AS file_type, CAST(size_bytes AS BIGINT) AS size_bytes,
        CAST(len(lines) AS BIGINT) AS line_count, coalesce(array_to_string(lines[1:2], ' '), '') AS top_lines,
        coalesce(array_to_string(lines[greatest(len(lines) - 1, 1):], ' '), '') AS bottom_lines, md5(text) AS digest
    FROM l""",
)
def file_scan(ws):
    """All pages written as a tree of text files, a folder per host, and scanned."""
    path = scratch_path(ws.spark, "tree")
    host = F.regexp_extract("url", "://([^/]+)", 1).alias("host")
    files.write_tree(ws.table("pages").select("page_id", host, "html"), path, ["host", "page_id"])
    found = files.read_text_tree(ws.spark, path, extensions=["txt"], min_depth=1, max_depth=2)
    docs = files.file_documents(found, n_top=2, n_bottom=2)
    return docs.select(
        F.regexp_extract("rel_path", r"page_id=(\d+)", 1).cast("long").alias("page_id"),
        "top_folder",
        "file_type",
        "size_bytes",
        F.col("line_count").cast("long").alias("line_count"),
        "top_lines",
        "bottom_lines",
        F.md5("text").alias("digest"),
    )


@query(
    "file_scan_filtered",
    """SELECT page_id, 'right' AS top_folder, md5(html || chr(10)) AS digest FROM pages
    UNION ALL SELECT page_id, '_hidden', md5(html || chr(10)) FROM pages""",
)
def file_scan_filtered(ws):
    """All pages in folders that a scan keeps, a hidden one among them, and in files too flat, too deep or of another ending."""
    path = scratch_path(ws.spark, "mixed-tree")
    pages = ws.table("pages").select("page_id", F.lit("deeper").alias("folder"), "html")
    for folder in ("right", "_hidden"):
        files.write_tree(pages.drop("folder"), f"{path}/{folder}", ["page_id"])
    pages.select("html").write.text(f"{path}/flat")
    files.write_tree(pages, f"{path}/deep", ["folder", "page_id"])
    files.write_tree(pages.drop("folder"), f"{path}/wrong", ["page_id"], "csv")
    found = files.read_text_tree(ws.spark, path, extensions=["txt"], min_depth=2, max_depth=2)
    page_id = F.regexp_extract("rel_path", r"page_id=(\d+)", 1).cast("long").alias("page_id")
    return files.file_documents(found).select(page_id, "top_folder", F.md5("text").alias("digest"))


@query(
    "parse_marked_records",
    f"""WITH d AS (SELECT doc_id, regexp_replace(text, '[\\r\\n]+\\z', '') AS text FROM documents),
    l AS (SELECT doc_id, {_LINES} AS lines FROM d)
    SELECT doc_id AS id, coalesce(array_to_string(lines, ' '), '') AS text FROM l""",
)
def parse_marked_records(ws):
    path = scratch_path(ws.spark, "records")
    records.write_marked_records(ws.documents, path)
    return records.read_marked_records(ws.spark, path)


@query("qrels_parse", f"WITH {sql.QRELS} SELECT query_id, doc_id FROM qrels")
def qrels_parse(ws):
    path = scratch_path(ws.spark, "qrels")
    records.write_qrels(ws.qrels, path)
    return records.read_qrels(ws.spark, path)


@query(
    "upsert_documents",
    """WITH incoming AS (SELECT page_id AS doc_id, html AS text FROM pages)
    SELECT doc_id, text FROM documents ANTI JOIN incoming USING (doc_id)
    UNION ALL SELECT doc_id, text FROM incoming""",
)
def upsert_documents(ws):
    """All documents, updated with all pages: some replace a document, some are new."""
    pages = ws.table("pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    return tables.upsert_documents(ws.documents.select("doc_id", "text"), pages)


@query(
    "upsert_repeated_key",
    """WITH incoming AS (SELECT conv_id AS doc_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id)
    SELECT doc_id, text FROM documents ANTI JOIN incoming USING (doc_id)
    UNION ALL SELECT doc_id, text FROM incoming""",
)
def upsert_repeated_key(ws):
    """All turns of the conversations, of which the last one counts."""
    turns = ws.table("conversations").select(F.col("conv_id").alias("doc_id"), "text", "turn")
    return tables.upsert_documents(ws.documents.select("doc_id", "text"), turns, order="turn")


@query(
    "update_collection",
    """SELECT doc_id, text FROM documents ANTI JOIN (SELECT page_id AS doc_id FROM pages) USING (doc_id)
    UNION ALL SELECT page_id AS doc_id, html AS text FROM pages""",
)
def update_collection(ws):
    """Create a stored collection, then create-or-append into a new one."""
    created, updated = scratch_path(ws.spark, "collection"), scratch_path(ws.spark, "collection")
    tables.write_collection(ws.documents.select("doc_id", "text"), created)
    pages = ws.table("pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    tables.update_collection(ws.spark, created, pages, updated, create=True)
    return ws.spark.read.parquet(updated)


@query(
    "update_index",
    f"""WITH c AS (SELECT doc_id, text FROM documents ANTI JOIN (SELECT page_id AS doc_id FROM pages) USING (doc_id)
        UNION ALL SELECT page_id AS doc_id, html AS text FROM pages),
    tok AS (SELECT doc_id, unnest({sql.words("text")}) AS term FROM c), {sql.POST}, {sql.TS}
    SELECT term, df, cf FROM ts""",
)
def update_index(ws):
    """Term statistics after all pages were put into the index of the documents."""
    pages = ws.table("pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    updated = index_plans.update_index(ws.index, stack_fields(pages, ["text"]), scratch_path(ws.spark, "updated-index"))
    return updated.term_stats("text").select("term", "df", "cf")


@query(
    "partitioned_collection",
    "SELECT doc_id, source, lang, n_chars FROM documents",
)
def partitioned_collection(ws):
    """One folder per value, read back with the folder as a column."""
    path = scratch_path(ws.spark, "partial")
    tables.write_collection(ws.documents, path, partition_by="source")
    return ws.spark.read.parquet(path).select("doc_id", F.col("source").cast("string"), "lang", "n_chars")


@query(
    "dump_collection",
    """SELECT doc_id, 'text' AS field, text AS value FROM documents
    UNION ALL SELECT doc_id, 'lang', lang FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents
    UNION ALL SELECT doc_id, 'n_chars', CAST(n_chars AS VARCHAR) FROM documents""",
)
def dump_collection(ws):
    return tables.dump_collection(ws.documents)


@query(
    "report_round_trip",
    f"""WITH {sql.MATCHES}, {sql.ranked(sql.CLASSIC)}, {sql.QRELS}, {sql.measured()}
    SELECT 'classic' AS run_id, query_id, 'MAP' AS metric, CAST(10 AS INTEGER) AS cut,
        round(average_precision, 6) AS value FROM pq""",
)
def report_round_trip(ws):
    """Per-query values written as a report with heading and means, and read back."""
    run = ranking.search(ws.index, ws.queries, "classic", 10)
    values = evaluation.per_query_metrics(run, ws.qrels, ws.queries, 10)
    path = scratch_path(ws.spark, "report")
    table = reports.run_table(values.select("query_id", F.col("average_precision").alias("value")), "classic")
    reports.write_report(table, path, "MAP", 10)
    return rounded(reports.read_run_results(ws.spark, path, "classic"), "value")


@query(
    "named_reports",
    f"""WITH {sql.MATCHES}, {sql.QRELS}, {sql.ranked(sql.CLASSIC, name="c")}, {sql.ranked(sql.jm("0.1::DOUBLE"), name="j")},
    {sql.measured(run="c", name="cq")}, {sql.measured(run="j", name="jq")},
    b AS (SELECT min(item_id) AS test_from, max(item_id) AS test_to FROM benchmark),
    v AS (SELECT 'documents.classic' AS run_id, * FROM cq UNION ALL SELECT 'documents.jm', * FROM jq)
    SELECT run_id, test_from, test_to, 'MAP' AS metric, CAST(10 AS INTEGER) AS cut, query_id,
        round(average_precision, 6) AS value FROM v CROSS JOIN b""",
)
def named_reports(ws):
    """Reports of two runs, told apart by their names alone when read back."""
    models = {"documents.classic": ranking.contribution_of("classic"), "documents.jm": ranking.contribution_of("jm", 0.1)}
    runs = ranking.rank_models(ws.index, ws.queries, models, 10)
    measured = materialize(
        evaluation.per_query_metrics(runs, ws.qrels, ws.queries, 10, by="run_id", by_values=list(models)), "measured"
    )
    bounds = ws.queries.agg(F.min("query_id").alias("low"), F.max("query_id").alias("high")).first()
    folder = scratch_path(ws.spark, "reports")
    for run in models:
        values = measured.where(F.col("run_id") == run).select("query_id", F.col("average_precision").alias("value"))
        name = reports.report_name(run, None, f"{bounds['low']}-{bounds['high']}", "MAP", 10)
        reports.write_report(reports.run_table(values, run), f"{folder}/{name}", "MAP", 10)
    return rounded(reports.read_named_results(ws.spark, folder), "value")


@query(
    "ranking_report_files",
    f"""WITH {sql.MATCHES}, {sql.ranked(sql.CLASSIC, name="c")}, {sql.ranked(sql.jm("0.1::DOUBLE"), name="j")},
    r AS (SELECT 'classic' AS run_id, * FROM c UNION ALL SELECT 'jm', * FROM j)
    SELECT run_id, query_id, rank, doc_id, round(score, 6) AS score FROM r""",
)
def ranking_report_files(ws):
    """Two rankings written as reports, a folder per run, and read back."""
    models = {"classic": ranking.contribution_of("classic"), "jm": ranking.contribution_of("jm", 0.1)}
    path = scratch_path(ws.spark, "rankings")
    reports.write_ranking_report(ranking.rank_models(ws.index, ws.queries, models, 10), path)
    schema = "query_id BIGINT, rank BIGINT, doc_id BIGINT, score DOUBLE, run_id STRING"
    return rounded(ws.spark.read.schema(schema).csv(path, sep=reports.SEPARATOR, header=True), "score")


@query(
    "top_terms_file",
    f"""WITH {sql.TERMS}, w AS (SELECT term, df, cf, 1 + log10((1 + doc_count) / (1 + df)) AS idf FROM ts CROSS JOIN fs)
    SELECT term, df, cf, round(idf, 6) AS idf FROM w ORDER BY round(idf, 9) DESC, term LIMIT 100""",
)
def top_terms_file(ws):
    """Best terms of the collection written to a file and read back."""
    path = scratch_path(ws.spark, "top-terms")
    reports.write_top_terms(top_terms.best_terms_in_collection(ws.index, 100, "idf"), path)
    found = ws.spark.read.schema("term STRING, df BIGINT, cf BIGINT, idf DOUBLE").csv(path, sep="\t", header=True)
    return rounded(found, "idf")
