"""Best terms of documents and of a collection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import weights
from textloom.operators.joins import is_small, join_on_term, parts_on_term
from textloom.operators.ranking import SCORE_DIGITS
from textloom.session import materialize

DOC_ORDERS = ["tf", "cf", "df", "idf", "tfidf"]


def weighted_terms(index, field: str) -> DataFrame:
    """``(doc_id, term, tf, cf, df, idf, tfidf)`` of every posting of a field."""
    return _weighted(index, field, join_on_term(index.postings(field), index.term_stats(field), index.term_stats_size))


def best_terms_in_docs(
    index, n: int, order: str = "tf", field: str = "text", targets: DataFrame | None = None
) -> DataFrame:
    """The ``n`` best terms of each document, or of the documents in ``targets(doc_id)`` only.

    Greatest value first, ties in byte order of the term; ``position`` counts from 1.
    """
    if order not in DOC_ORDERS:
        raise ValueError(f"unknown order {order!r}; use one of {DOC_ORDERS}")
    postings = index.postings(field)
    if targets is not None:
        postings = postings.join(targets.select("doc_id").distinct(), "doc_id", "left_semi")
    if order == "tf":
        # Known without statistics; only those of the best terms are looked up then.
        best = _best(postings, n, order)
        if not is_small(index.term_stats(field), index.term_stats_size):
            best = materialize(best, "best-terms")
        return _weighted(index, field, join_on_term(best, index.term_stats(field), index.term_stats_size), "position")
    first, *others = parts_on_term(postings, index.term_stats(field), index.term_stats_size)
    # The best of postings that lie by document need no shuffle. The others meet by document before their values are made.
    columns = ["doc_id", "field", "term", "tf", "cf", "df"]
    parts = [first, *(part.select(*columns).repartition("doc_id") for part in others)]
    found = reduce(DataFrame.unionByName, (_best(_weighted(index, field, part), n, order) for part in parts))
    return _best(found, n, order) if others else found


def _weighted(index, field: str, joined: DataFrame, *more: str) -> DataFrame:
    """``(doc_id, term, tf, cf, df, idf, tfidf)`` of postings with ``df`` and ``cf``."""
    idf = weights.idf_log10(F.col("doc_count"), F.col("df"))
    whole = joined.join(F.broadcast(index.field_stats(field)), "field")
    return whole.select("doc_id", "term", "tf", "cf", "df", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"), *more)


def _best(terms: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` of each document, with their ``position``."""
    best_first = Window.partitionBy("doc_id").orderBy(F.desc(F.round(order, SCORE_DIGITS)), "term")
    return terms.withColumn("position", F.row_number().over(best_first).cast("long")).where(F.col("position") <= n)


def best_terms_in_doc(index, doc_id: int, n: int, order: str = "tf", field: str = "text") -> DataFrame:
    """The same for one document given by its id: one bucket of the postings is read, and the statistics of its terms."""
    if order not in DOC_ORDERS:
        raise ValueError(f"unknown order {order!r}; use one of {DOC_ORDERS}")
    own = index.postings(field).where(F.col("doc_id") == F.lit(doc_id))
    # The terms of one text; they look their statistics up, not the other way round.
    known = index.term_stats(field).join(F.broadcast(own), ["field", "term"])
    return _best(_weighted(index, field, known), n, order)


def collection_terms(index, field: str) -> DataFrame:
    """``(term, df, cf, idf)``."""
    joined = index.term_stats(field).join(F.broadcast(index.field_stats(field)), "field")
    return joined.select("term", "df", "cf", weights.idf_log10(F.col("doc_count"), F.col("df")).alias("idf"))


def best_terms_in_collection(index, n: int, by: str = "idf", field: str = "text") -> DataFrame:
    """The ``n`` distinct terms of greatest ``idf`` or ``df``, ties in byte order."""
    _check_value(by)
    return collection_terms(index, field).orderBy(F.desc(F.round(by, SCORE_DIGITS)), "term").limit(n)


def best_term_occurrences(index, n: int, by: str = "idf", field: str = "text") -> DataFrame:
    """The same, but a term counts once for each document it occurs in."""
    _check_value(by)
    terms = weighted_terms(index, field).select("doc_id", "term", "df", "idf")
    return terms.orderBy(F.desc(F.round(by, SCORE_DIGITS)), "doc_id", "term").limit(n)


def _check_value(by: str) -> None:
    if by not in ("idf", "df"):
        raise ValueError("by must be 'idf' or 'df'")
