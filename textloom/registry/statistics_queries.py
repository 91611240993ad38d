"""Term, document and field statistics; weights; best terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import postings as ops
from textloom.operators import top_terms, weighting
from textloom.registry import sql
from textloom.registry.base import query, rounded

_IDF = "1 + log10((1 + doc_count) / (1 + df))"


@query("term_vectors", f"WITH {sql.TOK}, {sql.POST} SELECT doc_id, term, tf FROM post")
def term_vectors(ws):
    return ops.term_vectors(ws.dealt_texts).select("doc_id", "term", "tf")


@query("doc_freq", f"WITH {sql.TOK}, {sql.POST}, {sql.TS} SELECT term, df FROM ts")
def doc_freq(ws):
    return ops.doc_freq(ws.dealt_texts).select("term", "df")


@query("collection_freq", f"WITH {sql.TOK}, {sql.POST}, {sql.TS} SELECT term, cf FROM ts")
def collection_freq(ws):
    return ops.collection_freq(ws.dealt_texts).select("term", "cf")


@query(
    "doc_length",
    f"""WITH {sql.TOK}, {sql.POST}
    SELECT d.doc_id, CAST(coalesce(sum(tf), 0) AS BIGINT) AS dl, count(tf) AS n_terms
    FROM documents d LEFT JOIN post USING (doc_id) GROUP BY d.doc_id""",
)
def doc_length(ws):
    return ops.doc_lengths(ws.dealt_texts).select("doc_id", "dl", "n_terms")


@query(
    "field_stats",
    f"""WITH f AS (SELECT doc_id, 'text' AS field, text AS value FROM documents
        UNION ALL SELECT doc_id, 'lang', lang FROM documents
        UNION ALL SELECT doc_id, 'source', source FROM documents),
    t AS (SELECT doc_id, field, unnest({sql.words('value')}) AS term FROM f),
    p AS (SELECT doc_id, field, term, count(*) AS tf FROM t GROUP BY ALL)
    SELECT field, count(DISTINCT doc_id) AS doc_count, (SELECT count(*) FROM documents) AS max_doc,
        count(*) AS sum_doc_freq, CAST(sum(tf) AS BIGINT) AS sum_total_term_freq
    FROM p GROUP BY field""",
)
def field_stats(ws):
    stacked = ops.stack_fields(ops.spread(ws.documents), ["text", "lang", "source"])
    return ops.field_stats(ops.doc_lengths(stacked))


@query(
    "doc_count",
    f"WITH {sql.TOK}, {sql.DL}, {sql.FS} SELECT doc_count, max_doc FROM fs",
)
def doc_count(ws):
    return ops.field_stats(ops.doc_lengths(ws.dealt_texts)).select("doc_count", "max_doc")


@query(
    "partition_counts",
    f"""WITH t AS (SELECT source AS top_folder, doc_id, unnest({sql.words('text')}) AS term FROM documents),
    p AS (SELECT top_folder, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    n AS (SELECT source AS top_folder, count(*) AS max_doc FROM documents GROUP BY source)
    SELECT top_folder, count(DISTINCT doc_id) AS doc_count, any_value(max_doc) AS max_doc,
        count(*) AS sum_doc_freq, CAST(sum(tf) AS BIGINT) AS sum_total_term_freq
    FROM p JOIN n USING (top_folder) GROUP BY top_folder""",
)
def partition_counts(ws):
    """Statistics of each partial collection; ``source`` plays the first-level folder."""
    docs = ops.stack_folders(ops.spread(ws.documents.select("doc_id", "text", "source")), "source")
    return ops.field_stats(ops.doc_lengths(docs)).withColumnRenamed("field", "top_folder")


@query(
    "partial_term_stats",
    f"""WITH t AS (SELECT source AS top_folder, doc_id, unnest({sql.words('text')}) AS term FROM documents),
    p AS (SELECT top_folder, doc_id, term, count(*) AS tf FROM t GROUP BY ALL)
    SELECT top_folder, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY ALL""",
)
def partial_term_stats(ws):
    """Term statistics of each partial index."""
    return ws.partial_indexes.term_stats().withColumnRenamed("field", "top_folder")


@query(
    "invert_index",
    f"""WITH w AS (SELECT doc_id, {sql.words('text')} AS words FROM documents),
    t AS (SELECT doc_id, unnest(words) AS term, unnest(range(len(words))) AS pos FROM w),
    p AS (SELECT doc_id, term, count(*) AS tf, string_agg(pos, ',' ORDER BY pos) AS positions FROM t GROUP BY ALL)
    SELECT term, CAST(doc_id // 1000 AS BIGINT) AS block, count(*) AS n_docs,
        string_agg(doc_id || ':' || tf || ':' || positions, ' ' ORDER BY doc_id) AS entries
    FROM p GROUP BY ALL""",
)
def invert_index(ws):
    return ops.invert_index(ops.term_vectors(ws.dealt_texts, positions=True)).drop("field")


@query("idf_log10", f"WITH {sql.TERMS} SELECT term, df, round({_IDF}, 6) AS idf FROM ts CROSS JOIN fs")
def idf_log10(ws):
    return rounded(top_terms.collection_terms(ws.index, "text").select("term", "df", "idf"), "idf")


@query(
    "tfidf_log10",
    f"""WITH {sql.TERMS} SELECT doc_id, term, round(tf * ({_IDF}), 6) AS tfidf
    FROM post JOIN ts USING (term) CROSS JOIN fs""",
)
def tfidf_log10(ws):
    return rounded(top_terms.weighted_terms(ws.index, "text").select("doc_id", "term", "tfidf"), "tfidf")


@query(
    "tfidf_ratio",
    f"""WITH {sql.TERMS} SELECT doc_id, term, round(tf * (max_doc / df), 6) AS w
    FROM post JOIN ts USING (term) CROSS JOIN fs""",
)
def tfidf_ratio(ws):
    return rounded(weighting.vectorize(ws.index, "text", "tfxidf"), "w")


@query(
    "vector_norms",
    f"""WITH {sql.TERMS} SELECT doc_id, round(sum(tf * (max_doc / df)), 3) AS l1,
        round(sqrt(sum(pow(tf * (max_doc / df), 2))), 3) AS l2
    FROM post JOIN ts USING (term) CROSS JOIN fs GROUP BY doc_id""",
)
def vector_norms(ws):
    """Sums of up to a million: three decimals are left of any order of summation."""
    norms = weighting.vector_norms(weighting.vectorize(ws.index, "text", "tfidf"))
    return norms.withColumns({c: F.round(c, 3) for c in ("l1", "l2")})


@query(
    "terms_by_value",
    f"""WITH {sql.TOK}, {sql.POST} SELECT doc_id, tf AS value, count(*) AS n_terms,
        string_agg(term, ' ' ORDER BY term) AS terms FROM post GROUP BY doc_id, tf""",
)
def terms_by_value(ws):
    grouped = weighting.group_terms_by_value(ws.index.postings("text"), "tf")
    return grouped.withColumn("terms", F.array_join("terms", " "))


@query(
    "collection_terms_by_value",
    f"""WITH {sql.TOK}, {sql.POST}, {sql.TS}
    SELECT df AS value, count(*) OVER (PARTITION BY df) AS n_terms, term FROM ts""",
)
def collection_terms_by_value(ws):
    return weighting.group_collection_terms_by_value(ws.index.term_stats("text"), "df")


def _best_in_docs(order: str) -> None:
    statement = f"""WITH {sql.TERMS}, w AS (SELECT doc_id, term, tf, cf, df, {_IDF} AS idf, tf * ({_IDF}) AS tfidf
        FROM post JOIN ts USING (term) CROSS JOIN fs)
    SELECT doc_id, term, tf, cf, df, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf,
        row_number() OVER (PARTITION BY doc_id ORDER BY round({order}, 9) DESC, term) AS position
    FROM w QUALIFY position <= 10"""

    @query(f"best_terms_doc_{order}", statement)
    def best(ws):
        return rounded(top_terms.best_terms_in_docs(ws.index, 10, order), "idf", "tfidf")


for _order in top_terms.DOC_ORDERS:
    _best_in_docs(_order)


@query(
    "best_terms_one_doc",
    f"""WITH {sql.TERMS}, longest AS (SELECT doc_id FROM dl ORDER BY dl DESC, doc_id LIMIT 1),
    w AS (SELECT doc_id, term, tf, cf, df, {_IDF} AS idf, tf * ({_IDF}) AS tfidf
        FROM post JOIN longest USING (doc_id) JOIN ts USING (term) CROSS JOIN fs)
    SELECT doc_id, term, tf, cf, df, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf,
        row_number() OVER (ORDER BY round(tfidf, 9) DESC, term) AS position FROM w QUALIFY position <= 50""",
)
def best_terms_one_doc(ws):
    """Of the longest document."""
    return rounded(top_terms.best_terms_in_doc(ws.index, ws.longest_document, 50, "tfidf"), "idf", "tfidf")


def _best_in_collection(by: str) -> None:
    ordered = f"ORDER BY round({by}, 9) DESC"

    @query(
        f"best_terms_coll_{by}",
        f"""WITH {sql.TERMS}, w AS (SELECT term, df, cf, {_IDF} AS idf FROM ts CROSS JOIN fs)
        SELECT term, df, cf, round(idf, 6) AS idf FROM w {ordered}, term LIMIT 100""",
    )
    def distinct_terms(ws):
        return rounded(top_terms.best_terms_in_collection(ws.index, 100, by), "idf")

    @query(
        "best_term_occurrences" if by == "idf" else "best_term_occurrences_df",
        f"""WITH {sql.TERMS}, w AS (SELECT doc_id, term, df, {_IDF} AS idf
            FROM post JOIN ts USING (term) CROSS JOIN fs)
        SELECT doc_id, term, df, round(idf, 6) AS idf FROM w {ordered}, doc_id, term LIMIT 100""",
    )
    def occurrences(ws):
        return rounded(top_terms.best_term_occurrences(ws.index, 100, by), "idf")


for _by in ("idf", "df"):
    _best_in_collection(_by)
