"""Tokenizing, line and query expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import postings as ops
from textloom.operators.ranking import select_queries
from textloom.plans.sweep import split_queries
from textloom.registry import sql
from textloom.registry.base import query

_UNIFIED = r"regexp_replace(text, '\r\n|\r', chr(10), 'g')"
_LINES = rf"""CASE WHEN length({_UNIFIED}) = 0 THEN [] ELSE
    string_split(regexp_replace({_UNIFIED}, '\n\z', ''), chr(10)) END"""
_WITH_LINES = f"WITH l AS (SELECT doc_id, {_LINES} AS lines FROM documents) "


@query("tokenize", f"SELECT doc_id, unnest({sql.words('text')}) AS term FROM documents")
def tokenize(ws):
    return ops.tokenize(ws.dealt_texts).select("doc_id", "term")


@query(
    "token_positions",
    f"""WITH w AS (SELECT doc_id, {sql.words('text')} AS words FROM documents)
    SELECT doc_id, unnest(words) AS term, unnest(range(len(words))) AS pos FROM w""",
)
def token_positions(ws):
    return ops.tokenize(ws.dealt_texts).select("doc_id", "term", F.col("pos").cast("long").alias("pos"))


@query(
    "token_offsets",
    f"""WITH w AS (SELECT doc_id, {sql.words('text')} AS words, string_split_regex(lower(text), '{sql.PATTERN}') AS gaps
        FROM documents),
    t AS (SELECT doc_id, unnest(range(len(words))) AS pos, unnest(words) AS term, unnest(gaps[:len(words)]) AS gap FROM w),
    e AS (SELECT doc_id, pos, term, CAST(sum(length(gap) + length(term))
        OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS end_offset
        FROM t)
    SELECT doc_id, pos, term, end_offset - length(term) AS start_offset, end_offset FROM e""",
)
def token_offsets(ws):
    found = ops.token_offsets(ws.texts)
    return found.select("doc_id", F.col("pos").cast("long").alias("pos"), "term", "start_offset", "end_offset")


# The word-break rule without the scripts that the given texts do not have (ideographs, kana).
_EXTEND = r"[\p{M}\p{Cf}]*"
_LETTERS = rf"(?:[\p{{L}}\p{{Nl}}]{_EXTEND})+(?:[{tx.MID_LETTER}{tx.MID_NUM_LET}]{_EXTEND}(?:[\p{{L}}\p{{Nl}}]{_EXTEND})+)*"
_DIGITS = rf"(?:\p{{Nd}}{_EXTEND})+(?:[{tx.MID_NUM}{tx.MID_NUM_LET}]{_EXTEND}(?:\p{{Nd}}{_EXTEND})+)*"
_UNICODE = rf"(?:(?:\p{{Pc}}{_EXTEND})*(?:{_LETTERS}|{_DIGITS}))+(?:\p{{Pc}}{_EXTEND})*".replace("'", "''")


@query(
    "tokenize_unicode",
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '{_UNICODE}') AS words FROM documents),
    c AS (SELECT doc_id, flatten([[w[i * 255 + 1 : i * 255 + 255] FOR i IN range((length(w) + 254) // 255)] FOR w IN words]) AS words FROM w)
    SELECT doc_id, unnest(range(len(words))) AS pos, unnest(words) AS term FROM c""",
)
def tokenize_unicode(ws):
    """Words by the Unicode word-break rule."""
    found = ws.dealt_texts.select("doc_id", F.posexplode(tx.unicode_words("text")).alias("pos", "term"))
    return found.withColumn("pos", F.col("pos").cast("long"))


@query("join_lines", _WITH_LINES + "SELECT doc_id, coalesce(array_to_string(lines, ' '), '') AS joined FROM l")
def join_lines(ws):
    return ws.documents.select("doc_id", tx.join_lines(F.col("text")).alias("joined"))


@query(
    "top_lines", _WITH_LINES + "SELECT doc_id, coalesce(array_to_string(lines[1:2], ' '), '') AS top_lines FROM l"
)
def top_lines(ws):
    return ws.documents.select("doc_id", tx.top_lines(F.col("text"), 2).alias("top_lines"))


@query(
    "bottom_lines",
    _WITH_LINES
    + """SELECT doc_id, coalesce(array_to_string(lines[greatest(len(lines) - 1, 1):], ' '), '') AS bottom_lines FROM l""",
)
def bottom_lines(ws):
    return ws.documents.select("doc_id", tx.bottom_lines(F.col("text"), 2).alias("bottom_lines"))


@query("line_count", _WITH_LINES + "SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines FROM l")
def line_count(ws):
    return ws.documents.select("doc_id", tx.line_count(F.col("text")).cast("long").alias("n_lines"))


@query(
    "time_keys",
    """SELECT event_id, strftime(ts, '%Y%m%d%H%M%S%g') AS millis_key, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso
    FROM events""",
)
def time_keys(ws):
    """Both text forms of all event times, which the table gives as UTC without a zone."""
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    return ws.table("events").select(
        "event_id", tx.to_millis_key(instant).alias("millis_key"), tx.iso_time(instant).alias("iso")
    )


@query("clean_query", f"SELECT item_id AS query_id, {sql.QUERY_TEXT} AS cleaned FROM benchmark")
def clean_query(ws):
    return select_queries(ws.queries, "all").select("query_id", tx.clean_query(F.col("text")).alias("cleaned"))


@query(
    "split_queries",
    """WITH b AS (SELECT min(item_id) AS lo, max(item_id) AS hi FROM benchmark)
    SELECT item_id AS query_id, text, CASE WHEN item_id <= (lo + hi) // 2 THEN 'train' ELSE 'test' END AS part
    FROM benchmark CROSS JOIN b""",
)
def split(ws):
    return split_queries(ws.queries, *ws.query_halves)
