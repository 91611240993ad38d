"""Term weights and per-term contributions to a document score, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPRESENTATIONS = {"bin": "bin", "tf": "tf", "tfidf": "tfidf", "tf-idf": "tfidf", "tfxidf": "tfidf"}


def idf_log10(doc_count: Column, df: Column) -> Column:
    """``1 + log10((1 + doc_count) / (1 + df))``."""
    return 1 + F.log10((1 + doc_count) / (1 + df))


def tfidf_log10(tf: Column, doc_count: Column, df: Column) -> Column:
    return tf * idf_log10(doc_count, df)


def idf_ratio(num_docs: Column, df: Column) -> Column:
    """``num_docs / df``, without logarithm."""
    return num_docs / df


def tfidf_ratio(tf: Column, num_docs: Column, df: Column) -> Column:
    return tf * idf_ratio(num_docs, df)


def representation(name: str) -> str:
    """The canonical name of a vector representation."""
    if name not in REPRESENTATIONS:
        raise ValueError(f"unknown representation {name!r}; use one of {sorted(REPRESENTATIONS)}")
    return REPRESENTATIONS[name]


def smoothed_likelihood(lam: float) -> Column:
    """Jelinek-Mercer contribution of one query word to a document (Zhai & Lafferty 2001)."""
    if not 0 < lam <= 1:
        raise ValueError("lambda must satisfy 0 < lambda <= 1")
    in_document = (1 - lam) * F.col("tf") / F.col("dl")
    in_collection = lam * (F.col("cf") + 1) / (F.col("sum_total_term_freq") + 1)
    return F.log1p(in_document / in_collection)


def classic_tfidf() -> Column:
    """``sqrt(tf) * idf^2 / sqrt(dl)`` with ``idf = 1 + ln((N + 1) / (df + 1))``, for one query word."""
    idf = 1 + F.log((F.col("doc_count") + 1) / (F.col("df") + 1))
    return F.sqrt("tf") * idf * idf / F.sqrt("dl")
