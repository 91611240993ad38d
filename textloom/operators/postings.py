"""From texts to the flat term tables.

A text is one row, so all that concerns one document (its terms, their counts
and positions, its length) is computed where the text lies. Only statistics
across documents are shuffled, after they are counted within each partition.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as tx


def stack_fields(docs: DataFrame, fields: list[str], doc_id: str = "doc_id") -> DataFrame:
    """One row per document and text field: ``(doc_id, field, text)``; ``doc_id`` identifies a row of ``docs``."""
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *[F.col(f).cast("string") for f in fields])
    if len(fields) == 1:
        return chosen.select("doc_id", F.lit(fields[0]).alias("field"), F.col(fields[0]).alias("text"))
    return chosen.unpivot(["doc_id"], fields, "field", "text")


def stack_folders(docs: DataFrame, folder: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The same with the folder in the place of the field: each folder is a collection of its own."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(folder).alias("field"), F.col(text).alias("text"))


def spread(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Deal out rows that come in fewer splits than there are cores; leave any larger input where it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, key)


def by_document(docs: DataFrame, partitions: int) -> DataFrame:
    """``docs`` partitioned by document id."""
    return docs.repartition(partitions, "doc_id")


def tokenize(stacked: DataFrame, pattern: str = tx.WORD_PATTERN) -> DataFrame:
    """``(doc_id, field, pos, term)``, one row per word. No shuffle."""
    return stacked.select("doc_id", "field", F.posexplode(tx.words("text", pattern)).alias("pos", "term"))


def _held(expression: Column, name: str) -> Column:
    """A column that later expressions refer to without computing it again per element."""
    return F.inline(F.array(F.struct(expression.alias(name))))


def term_vectors(stacked: DataFrame, positions: bool = False, pattern: str = tx.WORD_PATTERN) -> DataFrame:
    """Postings: ``(doc_id, field, term, tf, dl[, positions])``. No shuffle and no hash table.

    The words of a text are sorted within its row, so that each run of equal
    words is one posting. ``dl``, the number of words of the document in the
    field, is carried along, so that ranking needs no join with a document
    table. Positions belong to one text, so their list is bounded by it.
    """
    words = tx.words("text", pattern)
    if positions:
        words = F.transform(words, lambda word, pos: F.struct(word.alias("term"), pos.alias("pos")))

    def term_at(i: Column) -> Column:
        entry = F.get(F.col("sorted"), i)
        return entry["term"] if positions else entry

    texts = stacked.select("doc_id", "field", _held(F.sort_array(words), "sorted")).where(F.size("sorted") > 0)
    first = F.filter(
        F.sequence(F.lit(0), F.size("sorted") - 1), lambda i: (i == 0) | (term_at(i) != term_at(i - 1))
    )
    runs = texts.select("doc_id", "field", "sorted", _held(first, "starts"))

    def posting(start: Column, number: Column) -> Column:
        tf = F.coalesce(F.get("starts", number + 1), F.size("sorted")) - start
        columns = [term_at(start).alias("term"), tf.cast("long").alias("tf"), F.size("sorted").cast("long").alias("dl")]
        if positions:
            run = F.slice("sorted", start + 1, tf)
            columns.append(F.transform(run, lambda entry: entry["pos"]).alias("positions"))
        return F.struct(*columns)

    return runs.select("doc_id", "field", F.inline(F.transform("starts", posting)))


def _ends(lengths: pd.Series) -> pd.Series:
    """Running sums of each list."""
    return lengths.map(lambda n: np.cumsum(n).tolist())


def token_offsets(stacked: DataFrame, pattern: str = tx.WORD_PATTERN) -> DataFrame:
    """``(doc_id, field, pos, term, start_offset, end_offset)``: where each word stands in the stored text. No shuffle.

    Words are found in the text as it is stored, and lower-cased afterwards, as
    lower case can have another length. The text before a word is what splitting
    at the words leaves there, so running sums of both lengths, made within the
    row, are the offsets.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    texts = stacked.select("doc_id", "field", _held(found, "words"), F.split(text, pattern).alias("gaps"))
    lengths = F.transform(F.arrays_zip("gaps", "words"), lambda e: F.length(e["gaps"]) + F.coalesce(F.length(e["words"]), F.lit(0)))
    ends = F.pandas_udf(_ends, "array<long>")(lengths)
    texts = texts.select("doc_id", "field", "words", ends.alias("end_offset"))
    rows = texts.select("doc_id", "field", F.posexplode(F.arrays_zip("words", "end_offset")).alias("pos", "entry"))
    word = F.col("entry.words")
    return rows.where(word.isNotNull()).select(
        "doc_id",
        "field",
        "pos",
        F.lower(word).alias("term"),
        (F.col("entry.end_offset") - F.length(word)).alias("start_offset"),
        F.col("entry.end_offset").alias("end_offset"),
    )


def doc_lengths(stacked: DataFrame) -> DataFrame:
    """``(doc_id, field, dl, n_terms)`` for every document, empty ones included. No shuffle."""
    found = stacked.select("doc_id", "field", tx.words("text").alias("words"))
    return found.select(
        "doc_id",
        "field",
        F.size("words").cast("long").alias("dl"),
        F.size(F.array_distinct("words")).cast("long").alias("n_terms"),
    )


def field_stats(doc_stats: DataFrame) -> DataFrame:
    """Per field: documents with a word in it, all documents, postings, words."""
    return doc_stats.groupBy("field").agg(
        F.count_if(F.col("dl") > 0).alias("doc_count"),
        F.count("*").alias("max_doc"),
        F.sum("n_terms").alias("sum_doc_freq"),
        F.sum("dl").alias("sum_total_term_freq"),
    )


def term_stats(postings: DataFrame) -> DataFrame:
    """``(field, term, df, cf)``; counted within each partition before the shuffle."""
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def doc_freq(stacked: DataFrame) -> DataFrame:
    """Documents per term, straight from the texts: a text's distinct words are found in its row."""
    distinct = stacked.select("doc_id", "field", F.explode(F.array_distinct(tx.words("text"))).alias("term"))
    return distinct.groupBy("field", "term").agg(F.count("*").alias("df"))


def collection_freq(stacked: DataFrame) -> DataFrame:
    """Occurrences per term, straight from the texts."""
    return stacked.select("field", F.explode(tx.words("text")).alias("term")).groupBy("field", "term").agg(
        F.count("*").alias("cf")
    )


def _posting_text(entry: Column) -> Column:
    where = F.array_join(F.transform(entry["positions"], lambda p: p.cast("string")), ",")
    return F.concat_ws(":", entry["doc_id"].cast("string"), entry["tf"].cast("string"), where)


def invert_index(postings: DataFrame, block_docs: int = 1000) -> DataFrame:
    """Export of posting lists: ``(field, term, block, entries)``.

    A block covers ``block_docs`` consecutive document ids. So the list of a term
    that occurs in most documents is spread over many rows, none longer than a
    block, and the whole list is the blocks in order.
    """
    block = F.floor(F.col("doc_id") / block_docs).alias("block")
    listed = postings.groupBy("field", "term", block).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf", "positions"))).alias("postings")
    )
    return listed.select(
        "field",
        "term",
        "block",
        F.size("postings").cast("long").alias("n_docs"),
        F.array_join(F.transform("postings", _posting_text), " ").alias("entries"),
    )
