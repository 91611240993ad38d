"""Stored indexes: several fields, opened again, updated twice, compacted."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import ranking
from textloom.registry import sql
from textloom.registry.base import query, rounded

_UPDATED = f"""WITH turns AS (SELECT conv_id AS doc_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id),
pages_left AS (SELECT page_id AS doc_id, html AS text FROM pages WHERE page_id NOT IN (SELECT doc_id FROM turns)),
c AS (SELECT doc_id, text FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM turns) AND doc_id NOT IN (SELECT page_id FROM pages)
    UNION ALL SELECT * FROM pages_left UNION ALL SELECT * FROM turns),
tok AS (SELECT doc_id, unnest({sql.words("text")}) AS term FROM c), {sql.POST}, {sql.TS}"""
_LENGTHS = """SELECT c.doc_id, CAST(coalesce(sum(tf), 0) AS BIGINT) AS dl, count(tf) AS n_terms
    FROM c LEFT JOIN post USING (doc_id) GROUP BY c.doc_id"""
_TOTALS = """SELECT (SELECT count(DISTINCT doc_id) FROM post) AS doc_count, (SELECT count(*) FROM c) AS max_doc,
    (SELECT count(*) FROM post) AS sum_doc_freq, (SELECT CAST(sum(tf) AS BIGINT) FROM post) AS sum_total_term_freq"""


@query("updated_postings", f"{_UPDATED} SELECT doc_id, term, tf FROM post")
def updated_postings(ws):
    """Postings after two updates, one of them with repeated documents."""
    return ws.updated_index.postings("text").select("doc_id", "term", "tf")


@query("updated_lengths", f"{_UPDATED} {_LENGTHS}")
def updated_lengths(ws):
    return ws.updated_index.doc_stats("text").select("doc_id", "dl", "n_terms")


@query("updated_term_stats", f"{_UPDATED} SELECT term, df, cf FROM ts")
def updated_term_stats(ws):
    """Changed by signed differences."""
    return ws.updated_index.term_stats("text").select("term", "df", "cf")


@query("updated_field_stats", f"{_UPDATED} {_TOTALS}")
def updated_field_stats(ws):
    return ws.updated_index.field_stats("text").drop("field")


@query("compacted_postings", f"{_UPDATED} SELECT doc_id, term, tf FROM post")
def compacted_postings(ws):
    return ws.compacted_index.postings("text").select("doc_id", "term", "tf")


@query("compacted_term_stats", f"{_UPDATED} SELECT term, df, cf FROM ts")
def compacted_term_stats(ws):
    return ws.compacted_index.term_stats("text").select("term", "df", "cf")


_SEARCHED = f"""{_UPDATED}, {sql.DL}, fs AS (SELECT count(*) AS doc_count, CAST(sum(dl) AS BIGINT) AS total FROM dl), {sql.QT},
m AS (SELECT query_id, doc_id, tf, dl, qtf, df, cf, doc_count, total
    FROM qt JOIN post USING (term) JOIN ts USING (term) JOIN dl USING (doc_id) CROSS JOIN fs),
{sql.ranked(sql.jm("0.1::DOUBLE"))}
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM run"""


@query("search_updated", _SEARCHED)
def search_updated(ws):
    """A ranking in the updated index, whose term bounds may be too large but never too small."""
    run = ranking.search(ws.updated_index, ws.queries, "jm", 10, lam=0.1)
    return rounded(run.withColumn("rank", F.col("rank").cast("long")), "score")


_FIELDS = f"""WITH f AS (SELECT doc_id, 'text' AS field, text AS value FROM documents
    UNION ALL SELECT doc_id, 'lang', lang FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents),
t AS (SELECT doc_id, field, unnest({sql.words('value')}) AS term FROM f),
p AS (SELECT doc_id, field, term, count(*) AS tf FROM t GROUP BY ALL)"""


@query(
    "field_term_stats",
    f"{_FIELDS} SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY field, term",
)
def field_term_stats(ws):
    """Terms of three fields from an index that was opened again."""
    return ws.field_index.term_stats()


@query("field_postings", f"{_FIELDS} SELECT doc_id, term, tf FROM p WHERE field = 'source'")
def field_postings(ws):
    """One field of several."""
    return ws.field_index.postings("source").select("doc_id", "term", "tf")


_FOLDERS = f"""WITH c AS (SELECT doc_id, source AS folder, text FROM documents WHERE source <> (SELECT min(source) FROM documents)
    UNION ALL SELECT page_id, (SELECT min(source) FROM documents), html FROM pages),
ft AS (SELECT doc_id, folder, unnest({sql.words("text")}) AS term FROM c),
fp AS (SELECT folder, doc_id, term, count(*) AS tf FROM ft GROUP BY ALL)"""


@query("folder_index", f"{_FOLDERS} SELECT folder, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM fp GROUP BY folder, term")
def folder_index(ws):
    """Term statistics of an index per folder, after one folder was replaced."""
    return ws.folder_indexes.term_stats().select("folder", "term", "df", "cf")


@query("folder_postings", f"{_FOLDERS} SELECT folder, doc_id, term, tf FROM fp")
def folder_postings(ws):
    return ws.folder_indexes.postings().select("folder", "doc_id", "term", "tf")


@query(
    "folder_field_stats",
    f"""{_FOLDERS} SELECT c.folder, (SELECT count(DISTINCT doc_id) FROM fp WHERE fp.folder = c.folder) AS doc_count, count(*) AS max_doc,
        (SELECT count(*) FROM fp WHERE fp.folder = c.folder) AS sum_doc_freq,
        (SELECT CAST(coalesce(sum(tf), 0) AS BIGINT) FROM fp WHERE fp.folder = c.folder) AS sum_total_term_freq
    FROM c GROUP BY c.folder""",
)
def folder_field_stats(ws):
    return ws.folder_indexes.field_stats().drop("field")


@query(
    "folder_search",
    f"""{_FOLDERS}, tok AS (SELECT doc_id, term FROM ft WHERE folder = (SELECT min(source) FROM documents)),
    {sql.POST}, {sql.TS}, {sql.DL}, fs AS (SELECT count(*) AS doc_count, CAST(sum(dl) AS BIGINT) AS total FROM dl), {sql.QT},
    m AS (SELECT query_id, doc_id, tf, dl, qtf, df, cf, doc_count, total
        FROM qt JOIN post USING (term) JOIN ts USING (term) JOIN dl USING (doc_id) CROSS JOIN fs),
    {sql.ranked(sql.jm("0.1::DOUBLE"))}
    SELECT query_id, rank, doc_id, round(score, 6) AS score FROM run""",
)
def folder_search(ws):
    """A ranking within the replaced folder, whose files alone are read."""
    run = ranking.search(ws.folder_indexes.folder(ws.replaced_folder), ws.queries, "jm", 10, lam=0.1)
    return rounded(run.withColumn("rank", F.col("rank").cast("long")), "score")
