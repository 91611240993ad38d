"""SQL fragments the oracles share (DuckDB dialect)."""

from textloom.functions.text import WORD_PATTERN

PATTERN = WORD_PATTERN.replace("'", "''")


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{PATTERN}')"


TOK = f"tok AS (SELECT doc_id, unnest({words('text')}) AS term FROM documents)"
POST = "post AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term)"
DL = "dl AS (SELECT doc_id, count(*) AS dl FROM tok GROUP BY doc_id)"
TS = "ts AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM post GROUP BY term)"
FS = """fs AS (SELECT count(*) AS doc_count, (SELECT count(*) FROM documents) AS max_doc,
    CAST(sum(dl) AS BIGINT) AS total FROM dl)"""
TERMS = f"{TOK}, {POST}, {DL}, {TS}, {FS}"

QUERY_TEXT = "lower(regexp_replace(text, '[()]', '', 'g'))"
QT = f"""qt AS (SELECT query_id, term, count(*) AS qtf
    FROM (SELECT item_id AS query_id, unnest({words(QUERY_TEXT)}) AS term FROM benchmark) GROUP BY ALL)"""
MATCHES = f"""{TERMS}, {QT},
m AS (SELECT query_id, doc_id, tf, dl, qtf, df, cf, doc_count, total
    FROM qt JOIN post USING (term) JOIN ts USING (term) JOIN dl USING (doc_id) CROSS JOIN fs)"""


def jm(lam: str) -> str:
    """``lam`` is an SQL expression of type DOUBLE."""
    return f"round(sum(qtf * ln(1 + ((1 - {lam}) * tf / dl) / ({lam} * (cf + 1) / (total + 1)))), 9)"


CLASSIC = """round(sum(qtf * sqrt(tf) * pow(1 + ln((doc_count + 1) / (df + 1)), 2) / sqrt(dl)), 9)"""


def ranked(score: str, k: int = 10, name: str = "run", source: str = "m") -> str:
    """CTEs that rank one run into ``name(query_id, rank, doc_id, score)``."""
    return f"""{name}_s AS (SELECT query_id, doc_id, {score} AS score FROM {source} GROUP BY query_id, doc_id),
{name} AS (SELECT query_id, doc_id, score,
        row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
    FROM {name}_s QUALIFY rank <= {k})"""


QRELS = """qrels AS (SELECT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d
    ON contains(lower(d.text), lower(b.text)))"""


def measured(cut: int = 10, run: str = "run", name: str = "pq") -> str:
    """CTEs for all metrics of one run into ``name(query_id, precision, …)``."""
    return f"""{name}_w AS (SELECT r.query_id, r.rank, CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END AS rel,
        sum(CASE WHEN j.doc_id IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY r.query_id ORDER BY r.rank
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
    FROM {run} r LEFT JOIN qrels j ON r.query_id = j.query_id AND r.doc_id = j.doc_id WHERE r.rank <= {cut}),
{name}_t AS (SELECT query_id, sum(rel) AS hits, count(*) AS retrieved,
    sum(CASE WHEN rel = 1 THEN so_far / rank ELSE 0 END) AS precisions FROM {name}_w GROUP BY query_id),
{name}_j AS (SELECT query_id, count(*) AS judged FROM qrels GROUP BY query_id),
{name} AS (SELECT b.item_id AS query_id,
        coalesce(hits, 0) / {cut} AS precision,
        CASE WHEN retrieved > 0 THEN hits / retrieved ELSE 0 END AS precision_retrieved,
        CASE WHEN judged > 0 THEN coalesce(hits, 0) / judged ELSE 0 END AS recall,
        CASE WHEN judged > 0 THEN coalesce(precisions, 0) / judged ELSE 0 END AS average_precision
    FROM benchmark b LEFT JOIN {name}_t t ON t.query_id = b.item_id LEFT JOIN {name}_j j ON j.query_id = b.item_id)"""
