"""Indexes per folder beside the plain index of the same texts."""

import os
import re

import pytest

from textloom.operators import ranking, top_terms
from textloom.plans.folders import build_folder_indexes, open_folder_indexes, replace_folders
from textloom.plans.index import build_index

SCHEMA = "doc_id BIGINT, folder STRING, field STRING, text STRING"
# One folder holds most texts; a hot word stands in all; names that a path would escape.
ROWS = [(i, "big", "text", f"hot word{i % 7} only{i} hot") for i in range(60)]
ROWS += [(100, "a/b=c d%", "text", "hot tea"), (101, "a/b=c d%", "text", ""), (102, "a/b=c d%", "text", None)]
ROWS += [(100, "a/b=c d%", "title", "tea"), (103, "ü", "text", "hot ä"), (104, None, "text", "root file")]


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def files_of(df, part):
    return {f.split(f"/{part}/")[1] for f in df.inputFiles()}


@pytest.fixture(scope="module")
def stacked(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def folders(spark, stacked):
    from textloom.session import scratch_path

    return build_folder_indexes(stacked, scratch_path(spark, "folders"), bucket_bytes=300)


def test_each_folder_is_an_index_of_its_own(spark, stacked, folders, new_path):
    assert {r["folder"] for r in folders.folders().collect()} == {"big", "a/b=c d%", "ü"}
    for name in ("big", "a/b=c d%", "ü"):
        own = folders.folder(name)
        plain = build_index(stacked.where(stacked.folder == name).drop("folder"), new_path("plain"), buckets=2)
        assert rows(own.postings()) == rows(plain.postings())
        assert rows(own.doc_stats()) == rows(plain.doc_stats())
        assert rows(own.term_bounds()) == rows(plain.term_bounds())
        assert rows(own.field_stats()) == rows(plain.field_stats())
        assert rows(own.term_postings(list(range(own.buckets)))) == rows(plain.postings())
        assert own.term_stats_size == plain.term_stats_size
        assert rows(own.postings("title")) == rows(plain.postings("title"))


def test_searches_and_best_terms_work_within_a_folder(spark, stacked, folders, new_path):
    queries = spark.createDataFrame([(1, "hot word3"), (2, "only7 tea")], "query_id BIGINT, text STRING")
    own = folders.folder("big")
    plain = build_index(stacked.where("folder = 'big'").drop("folder"), new_path("plain"), buckets=2)
    for model in ("jm", "classic"):
        assert rows(ranking.search(own, queries, model, 5)) == rows(ranking.search(plain, queries, model, 5))
    assert rows(top_terms.best_terms_in_docs(own, 2, "tfidf")) == rows(top_terms.best_terms_in_docs(plain, 2, "tfidf"))


def test_a_large_folder_has_more_buckets(folders):
    buckets = {r["folder"]: r["buckets"] for r in folders.folders().collect()}
    assert buckets["big"] > 3 and buckets["ü"] == buckets["a/b=c d%"] == 1
    directory = f"{folders.path}/postings/folder_key={folders.folder('big').key}"
    found = [sum(f.endswith(".parquet") for f in os.listdir(f"{directory}/{d}")) for d in os.listdir(directory) if "=" in d]
    assert len(found) > 3 and set(found) == {1}


def test_only_files_of_the_folder_are_read(folders):
    own = folders.folder("big")
    for part, df in {"postings": own.postings(), "doc_stats": own.doc_stats(), "term_stats": own.term_stats()}.items():
        names = files_of(df, part)
        assert names and all(n.startswith(f"folder_key={own.key}/") for n in names)
    one = own.document(7)
    assert {r["doc_id"] for r in one.collect()} == {7} and one.count() == 3
    for df, column in ((one, "bucket"), (own.term_postings([0]), "term_class")):
        assert re.search(rf"PartitionFilters: \[[^\]]*{column}", df._jdf.queryExecution().executedPlan().toString())


def test_folders_are_replaced_added_and_removed(spark, stacked, folders, new_path):
    incoming = spark.createDataFrame([(7, "big", "text", "new words"), (8, "more", "text", "words")], SCHEMA)
    before = {f: os.path.getmtime(f"{folders.path}/{f}") for f in os.listdir(folders.path)}
    changed = replace_folders(folders, incoming, new_path("changed"), removed=["ü"])
    again = open_folder_indexes(spark, changed.path)
    assert {r["folder"] for r in again.folders().collect()} == {"big", "more", "a/b=c d%"}
    assert rows(again.folder("big").term_stats()) == [(1, 1, "text", "new"), (1, 1, "text", "words")]
    with pytest.raises(KeyError):
        again.folder("ü")
    # Those that were not given are read from where they were.
    kept = again.folder("a/b=c d%")
    assert kept.path == folders.path and rows(kept.postings()) == rows(folders.folder("a/b=c d%").postings())
    assert {f: os.path.getmtime(f"{folders.path}/{f}") for f in os.listdir(folders.path)} == before
    every = sorted({(r["folder"], r["doc_id"]) for r in again.postings().collect()})
    assert every == [("a/b=c d%", 100), ("big", 7), ("more", 8)]
    assert {(r["folder"], r["max_doc"]) for r in again.field_stats().where("field = 'text'").collect()} == {("a/b=c d%", 3), ("big", 1), ("more", 1)}
    # The list that was there before still gives the old state.
    assert folders.folder("big").doc_stats().count() == 60
    with pytest.raises(ValueError):
        replace_folders(folders, incoming, folders.path)


def test_no_texts_and_texts_without_words(spark, new_path):
    empty = build_folder_indexes(spark.createDataFrame([], SCHEMA), new_path("empty"))
    assert empty.folders().count() == empty.postings().count() == empty.field_stats().count() == 0
    blank = build_folder_indexes(spark.createDataFrame([(1, "x", "text", None)], SCHEMA), new_path("blank"))
    assert rows(blank.folder("x").doc_stats()) == [(0, 1, "text", 0)]
    assert blank.folder("x").postings().count() == blank.folder("x").term_stats().count() == 0
