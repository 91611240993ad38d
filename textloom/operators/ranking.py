"""Ranked retrieval: all queries in one plan."""

from __future__ import annotations

import math
import re
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.functions import weights
from textloom.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small, join_on_term
from textloom.session import materialize

# Scores are compared to this many digits, so that the order of summation cannot break a tie.
SCORE_DIGITS = 9

# Queries that are scored together.
QUERY_BLOCK = 1000

# Pairs of document, query and model that one task holds sums of at a time.
BATCH_ROWS = 2_000_000

# Documents per wanted one that are scored first, to know what the best ones reach.
SEEDS = 10

# Words that cannot make up this share of what the best documents reach are added up last.
LAST_SHARE = 0.3

# Columns of a term that its weights are made of.
STATISTICS = ["field", "term", "df", "cf", "doc_count", "max_doc", "sum_doc_freq", "sum_total_term_freq"]
KNOWN_SCHEMA = "field STRING, term STRING, " + ", ".join(f"{c} BIGINT" for c in [*STATISTICS[2:], "term_no"])
PAIR_SCHEMA = "query_id BIGINT, doc_id BIGINT, "

# Sums of doubles may differ by this with the order of summation.
MARGIN = 1e-6

# Rows of one query that one task may rank.
RANK_ROWS = 1_000_000


def select_queries(queries: DataFrame, spec: str = "all") -> DataFrame:
    """``all``, one id, or an inclusive range ``a-b`` (also given as ``b-a``)."""
    if spec == "all":
        return queries
    found = re.fullmatch(r"(\d+)(?:-(\d+))?", spec)
    if not found:
        raise ValueError(f"no query selection: {spec!r}; use 'all', 'a' or 'a-b'")
    bounds = sorted(int(part) for part in found.groups() if part is not None)
    return queries.where(F.col("query_id").between(bounds[0], bounds[-1]))


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term, qtf)``: a repeated word of a query counts each time."""
    found = queries.select("query_id", F.explode(tx.words(tx.clean_query(F.col("text")))).alias("term"))
    return found.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def asked_terms(index, queries: DataFrame, contributions: list[Column], field: str) -> DataFrame:
    """Query words that occur in the collection, with the statistics of their terms and what they can add at most.

    The greatest contribution ``u0, u1, …`` is that of a document in which the
    term has its ``max_share`` of all words.
    """
    known = index.term_bounds(field).join(query_terms(queries), "term").join(F.broadcast(index.field_stats(field)), "field")
    at_most = known.withColumns({"tf": F.col("max_share"), "dl": F.lit(1.0), "term_class": index.term_class()})
    return at_most.select("query_id", "qtf", "term_class", *STATISTICS, *[c.alias(f"u{i}") for i, c in enumerate(contributions)])


def weighed_postings(index, words: pd.DataFrame, contributions: list[Column], field: str) -> DataFrame:
    """``(doc_id, term_no, c0, c1, …)``: the postings of some words, each weighed once for all queries.

    Read from the files of these terms' classes alone.
    """
    terms = words[[*STATISTICS, "term_no", "term_class"]].drop_duplicates("term_no")
    postings = index.term_postings(sorted({int(c) for c in terms["term_class"]}), field)
    known = index.spark.createDataFrame(terms.drop(columns="term_class"), KNOWN_SCHEMA)
    size = len(terms), int(terms["term"].str.len().sum()) * 4 + 64 * len(terms)
    return join_on_term(postings, known, size).select("doc_id", "term_no", *[c.alias(f"c{i}") for i, c in enumerate(contributions)])


class Asked(NamedTuple):
    """A block of queries as arrays.

    ``entries[level]`` has, per term, the queries that ask for it at that level:
    offsets, positions of queries, and how often each asks. What a query's words
    of this and later levels can add at most is in ``rest[level]`` (a row per
    model). ``least`` are scores that ``k`` documents are known to reach.
    """

    query_ids: np.ndarray
    terms: np.ndarray
    entries: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    rest: list[np.ndarray]
    least: np.ndarray


def _entries(terms: np.ndarray, term: np.ndarray, query: np.ndarray, qtf: np.ndarray):
    order = np.lexsort((query, term))
    first = np.searchsorted(term[order], np.arange(len(terms) + 1))
    return first, query[order], qtf[order].astype(np.float64)


def arrange(query_ids, query, term_no, qtf, bounds: np.ndarray, least: np.ndarray | None = None) -> Asked:
    """Words of queries dealt out to levels by what they can add at most.

    With ``least``, a query's words are put in the order of their bounds. The last
    ones, which together cannot lift a document to ``least``, are not looked for:
    a document found by them alone is out (level 1). Of these, the words that
    cannot make up ``LAST_SHARE`` of it come last (level 2). With several models
    all of them have to agree.
    """
    terms, term = np.unique(term_no, return_inverse=True)
    models, n = len(bounds), len(query_ids)
    zero = np.zeros((models, n))
    if least is None:
        return Asked(query_ids, terms, [_entries(terms, term, query, qtf)], [zero], np.full((models, n), -np.inf))
    order = np.lexsort((bounds.sum(axis=0), query))
    start = np.searchsorted(query[order], np.arange(n + 1))
    so_far = np.cumsum(bounds[:, order], axis=1)
    before = np.concatenate([np.zeros((models, 1)), so_far], axis=1)[:, start[:-1]]
    own = query[order]
    reach = so_far - before[:, own]  # with all words of smaller bounds
    level = np.zeros(len(query), np.int64)
    level[order[(reach < least[:, own] - MARGIN).all(axis=0)]] = 1
    level[order[(reach < LAST_SHARE * least[:, own] - MARGIN).all(axis=0)]] = 2
    entries, rest = [], []
    for k in range(3):
        at = level == k
        entries.append(_entries(terms, term[at], query[at], qtf[at]))
        later = level > k
        rest.append(np.stack([np.bincount(query[later], weights=b[later], minlength=n) for b in bounds]))
    return Asked(query_ids, terms, entries, rest, least)


def _scored(asked: Asked, k: int, document, term_no, weights: np.ndarray, least: np.ndarray):
    """Scores of some whole documents for all queries that can have them among their best ``k``.

    Returns documents, queries and their scores, a row per model, and the raised
    ``least``. After each level pairs are dropped that the words still to come
    cannot lift to ``least``.
    """
    ids, doc = np.unique(document, return_inverse=True)
    n = len(asked.query_ids)
    term = np.searchsorted(asked.terms, term_no)
    total = np.zeros((len(weights), len(ids) * n))
    alive = np.zeros(len(ids) * n, dtype=bool)
    for level, (first, query, qtf) in enumerate(asked.entries):
        count = first[term + 1] - first[term]
        posting = np.repeat(np.arange(len(term)), count)
        entry = np.arange(len(posting)) - np.repeat(np.cumsum(count) - count, count) + first[term][posting]
        cell = doc[posting] * n + query[entry]
        if level:
            wanted = alive[cell]
            posting, entry, cell = posting[wanted], entry[wanted], cell[wanted]
        else:
            alive[cell] = True
        for m, w in enumerate(weights):
            total[m] += np.bincount(cell, weights=w[posting] * qtf[entry], minlength=total.shape[1])
        reach = (total.reshape(len(weights), len(ids), n) + asked.rest[level][:, None]) >= least[:, None] - MARGIN
        alive &= reach.any(axis=0).ravel()
    at = np.flatnonzero(alive)
    if len(ids) >= k:  # so many documents are enough to raise what is known
        masked = np.where(alive, total, -np.inf).reshape(len(weights), len(ids), n)
        least = np.maximum(least, np.partition(masked, len(ids) - k, axis=1)[:, len(ids) - k])
    return ids[at // n], asked.query_ids[at % n], total[:, at], least


def _score_documents(shared, k: int, models: int):
    """Scores batches of postings that come sorted by document, ``BATCH_ROWS`` pairs of document and query at a time."""

    def score(batches):
        asked = shared.value
        least = asked.least
        held: list[pa.RecordBatch] = []

        def out(table: pa.Table):
            nonlocal least
            weights = np.stack([table[f"c{i}"].to_numpy() for i in range(models)])
            doc, query, total, least = _scored(asked, k, table["doc_id"].to_numpy(), table["term_no"].to_numpy(), weights, least)
            total = np.round(total, SCORE_DIGITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(doc), *map(pa.array, total)], ["query_id", "doc_id", *[f"s{i}" for i in range(models)]]
            )

        def whole_documents(last: bool):
            nonlocal held
            table = pa.Table.from_batches(held)
            doc = table["doc_id"].to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(doc, prepend=doc[0] - 1)), len(doc))
            step = max(1, BATCH_ROWS // (max(1, len(asked.query_ids)) * models))
            n = len(cuts) - 1 if last else len(cuts) - 2  # the last document may go on in the next batch
            done = 0
            while done < n and (last or n - done >= step):
                upto = min(done + step, n)
                yield from out(table.slice(cuts[done], cuts[upto] - cuts[done]))
                done = upto
            held = table.slice(cuts[done]).to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                yield from whole_documents(False)
        if held:
            yield from whole_documents(True)

    return score


def score_pairs(index, postings: DataFrame, asked: Asked, k: int, models: int) -> DataFrame:
    """``(query_id, doc_id, s0, s1, …)``: every pair that can be among a query's best ``k``, and what else was not ruled out."""
    shared = index.spark.sparkContext.broadcast(asked)
    placed = postings.repartition(index.buckets, "doc_id").sortWithinPartitions("doc_id")
    schema = PAIR_SCHEMA + ", ".join(f"s{i} DOUBLE" for i in range(models))
    return placed.mapInArrow(_score_documents(shared, k, models), schema)


def _seen_scores(index, words: pd.DataFrame, models: int, k: int, postings_of, asked: Asked) -> np.ndarray:
    """Scores that ``k`` documents are known to reach, per model and query of a block.

    They are the ``k``-th best whole scores of the documents that look best by the
    rarest words of each query: so many words that they find some ``SEEDS * k``.
    """
    ordered = words.sort_values(["query", "df", "term_no"])
    before = ordered.groupby("query")["df"].cumsum() - ordered["df"]
    rare = ordered[before < SEEDS * k]
    least = np.full((models, len(asked.query_ids)), -np.inf)
    # Bounded by the block of queries.
    few = index.spark.createDataFrame(rare[["query_id", "term_no", "qtf"]].astype({"qtf": float}), "query_id BIGINT, term_no BIGINT, qtf DOUBLE")
    found = postings_of(rare).select("doc_id", "term_no", "c0").join(F.broadcast(few), "term_no")
    found = found.groupBy("query_id", "doc_id").agg(F.sum(F.col("qtf") * F.col("c0")).alias("score"))
    seeds = top_k(found, SEEDS * k, parts=parts_for(index, SEEDS * k)).select("doc_id").distinct()
    bounded = SEEDS * k * len(asked.query_ids) <= MAX_BROADCAST_ROWS
    postings = postings_of(words).join(F.broadcast(seeds) if bounded else seeds, "doc_id", "left_semi")
    seen = score_pairs(index, postings, asked, k, models)
    best = top_k(_by_model(seen, list(range(models)), "model"), k, "model", parts=parts_for(index, k))
    for row in best.where(F.col("rank") == k).collect():  # one per query of the block and model
        least[row["model"], np.searchsorted(asked.query_ids, row["query_id"])] = row["score"]
    return least


def block_pairs(index, words: pd.DataFrame, models: int, k: int, postings_of) -> DataFrame:
    """The scored pairs of one block of queries.

    ``words (query_id, term, df, qtf, u0, …)``: how much a query asks for a term,
    and the greatest contribution of the term per model. ``postings_of(words)``
    gives the weighed postings ``(doc_id, term_no, c0, …)`` of some of them.
    """
    words = words.sort_values(["query_id", "term"], ignore_index=True)
    words["term_no"] = np.unique(words["term"].to_numpy(dtype=str), return_inverse=True)[1]
    query_ids, words["query"] = np.unique(words["query_id"].to_numpy(), return_inverse=True)
    qtf = words["qtf"].to_numpy()
    most = np.stack([words[f"u{i}"].to_numpy() * qtf for i in range(models)])
    columns = query_ids, words["query"].to_numpy(), words["term_no"].to_numpy(), qtf, most
    least = _seen_scores(index, words, models, k, postings_of, arrange(*columns))
    return score_pairs(index, postings_of(words), arrange(*columns, least), k, models)


def scored_pairs(index, queries: DataFrame, contributions: list[Column], k: int, field: str) -> DataFrame:
    """``(query_id, doc_id, s0, s1, …)``: the pairs that are left for the ranking, with their whole scores.

    Any one word retrieves a document. Not all pairs are scored, though: rare
    words are scored first, and the ``k``-th best of the documents they find gives
    a score that a query's best ``k`` reach (``_seen_scores``). With the greatest
    contribution of each word that tells which words are not worth looking for,
    and which documents can be dropped before all their words are added up
    (``arrange``, ``_scored``). For that a contribution must not be negative and
    must not fall as ``tf / dl`` rises.

    Postings are read by the classes of the asked words, weighed once for all
    queries and moved to their documents. Queries come in blocks of about
    ``QUERY_BLOCK``, so that what the driver and a task hold of them is bounded;
    each block reads the postings of its words.
    """
    spark = index.spark
    asked = asked_terms(index, queries, contributions, field)
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    if blocks > 1:
        asked = materialize(asked, "query-terms")
    block_of = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    models, results = len(contributions), []
    for number in range(blocks):
        words = asked.where(block_of == number).toPandas()
        if len(words):
            results.append(block_pairs(index, words, models, k, lambda w: weighed_postings(index, w, contributions, field)))
    if not results:
        return spark.createDataFrame([], PAIR_SCHEMA + ", ".join(f"s{i} DOUBLE" for i in range(models)))
    return reduce(DataFrame.unionByName, results)


def top_k(scores: DataFrame, k: int, *keys: str, parts: int = 1) -> DataFrame:
    """At most ``k`` documents per query, best score first, ties by document id.

    Spark keeps only the best ``k`` of each partition before it shuffles, so one
    task sees ``k`` rows per partition of the input. ``parts`` > 1 ranks that
    many shares of the documents first, each in its own task.
    """

    def ranked(rows: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), "doc_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    group = [*keys, "query_id"]
    if parts > 1:
        share = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
        scores = ranked(scores.withColumn("part", share), *group, "part").drop("part", "rank")
    return ranked(scores, *group).select(*group, "rank", "doc_id", "score")


def parts_for(index, k: int) -> int:
    """Shares needed so that no task ranks more than ``RANK_ROWS`` rows of a query."""
    return max(1, math.ceil(index.buckets * k / RANK_ROWS))


def contribution_of(model: str, lam: float = 0.5) -> Column:
    if model == "jm":
        return weights.smoothed_likelihood(lam)
    if model == "classic":
        return weights.classic_tfidf()
    raise ValueError(f"unknown model {model!r}; use 'jm' or 'classic'")


def _by_model(scored: DataFrame, names: list, label: str) -> DataFrame:
    """One row per model instead of one column."""
    per_model = [F.struct(F.lit(name).alias(label), F.col(f"s{i}").alias("score")) for i, name in enumerate(names)]
    return scored.select("query_id", "doc_id", F.inline(F.array(*per_model)))


def rank_models(
    index, queries: DataFrame, contributions: dict, k: int, label: str = "run_id", field: str = "text"
) -> DataFrame:
    """Rankings of several models: ``(label, query_id, rank, doc_id, score)``; queries are matched once, with one sum per model."""
    scored = scored_pairs(index, queries, list(contributions.values()), k, field)
    return top_k(_by_model(scored, list(contributions), label), k, label, parts=parts_for(index, k))


def search(index, queries: DataFrame, model: str, k: int, field: str = "text", lam: float = 0.5) -> DataFrame:
    """``(query_id, rank, doc_id, score)`` for all queries."""
    if k < 1:
        raise ValueError("k must be positive")
    scored = scored_pairs(index, queries, [contribution_of(model, lam)], k, field)
    return top_k(scored.withColumnRenamed("s0", "score"), k, parts=parts_for(index, k))


def with_document(run: DataFrame, docs: DataFrame, *columns: str) -> DataFrame:
    """Stored columns of the hits, fetched after the ranking is cut to its top."""
    chosen = docs.select("doc_id", *columns)
    return chosen.join(broadcast_if_small(run), "doc_id")
