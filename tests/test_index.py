import random
import time

import pytest
from pyspark.sql import functions as F

from textloom.operators import postings as ops
from textloom.operators import top_terms, weighting
from textloom.operators.joins import join_on_term, parts_on_term
from textloom.plans.index import build_index, compact_index, default_buckets, open_index, update_index
from textloom.session import CLEANUP_SETTING, materialize
from textloom.sources.tables import upsert_documents

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_micro_statistics(index):
    stats = index.field_stats("text").first()
    assert (stats["doc_count"], stats["max_doc"], stats["sum_doc_freq"], stats["sum_total_term_freq"]) == (3, 4, 5, 8)
    terms = {r["term"]: r for r in top_terms.collection_terms(index, "text").collect()}
    assert {t: (r["df"], r["cf"], round(r["idf"], 6)) for t, r in terms.items()} == {
        "red": (1, 2, 1.301030),
        "blue": (2, 2, 1.124939),
        "green": (2, 4, 1.124939),
    }


def test_empty_document_is_counted_but_has_no_terms(index):
    lengths = {r["doc_id"]: (r["dl"], r["n_terms"]) for r in index.doc_stats("text").collect()}
    assert lengths == {0: (3, 2), 1: (2, 2), 2: (3, 1), 3: (0, 0)}


def test_unknown_field_gives_no_row(index):
    assert index.field_stats("title").count() == 0
    assert index.postings("title").count() == 0


def test_totals_agree(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    postings = ops.term_vectors(ops.stack_fields(docs, ["text"]))
    stats = ops.field_stats(ops.doc_lengths(ops.stack_fields(docs, ["text"]))).first()
    terms = ops.term_stats(postings).agg(F.sum("df"), F.sum("cf")).first()
    assert tuple(terms) == (stats["sum_doc_freq"], stats["sum_total_term_freq"])


def test_reopened_index_has_the_same_tables(spark, docs, new_path):
    path = new_path("reopened")
    built = build_index(ops.stack_fields(docs, ["text"]), path, buckets=3)
    expected = rows(built.postings()), rows(built.doc_stats())
    for part in ("postings", "doc_stats"):
        # The table entry belongs to a session; dropping it leaves the external files.
        spark.sql(f"DROP TABLE {built._table_name(part)}")
    opened = open_index(spark, path)
    assert opened.buckets == 3 and opened.term_stats_size == built.term_stats_size
    assert (rows(opened.postings()), rows(opened.doc_stats())) == expected
    assert rows(opened.term_stats()) == rows(built.term_stats())


@pytest.mark.parametrize("buckets", [1, 5])
def test_buckets_do_not_change_results(spark, docs, index, new_path, buckets):
    other = build_index(ops.stack_fields(docs, ["text"]), new_path("buckets"), buckets=buckets)
    assert rows(other.postings()) == rows(index.postings())
    assert rows(other.field_stats()) == rows(index.field_stats())


def test_grouping_by_document_needs_no_shuffle(index, capsys):
    index.postings().groupBy("doc_id", "term").agg(F.sum("tf")).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_updated_index_equals_a_new_one(spark, docs, index, new_path):
    incoming = spark.createDataFrame([(1, "red"), (3, ""), (7, "new blue")], "doc_id BIGINT, text STRING")
    updated = update_index(index, ops.stack_fields(incoming, ["text"]), new_path("updated"))
    whole = upsert_documents(docs, incoming)
    rebuilt = build_index(ops.stack_fields(whole, ["text"]), new_path("rebuilt"))
    for table in ("postings", "doc_stats", "term_stats", "field_stats"):
        assert rows(getattr(updated, table)()) == rows(getattr(rebuilt, table)())
    assert updated.field_stats("text").first()["max_doc"] == 5
    # Both kinds of files of a bucket are read together: grouping by document still needs no shuffle.
    assert rows(weighting.vector_norms(weighting.vectorize(updated, "text", "tf"))) == rows(
        weighting.vector_norms(weighting.vectorize(rebuilt, "text", "tf"))
    )
    with pytest.raises(ValueError):
        update_index(index, ops.stack_fields(incoming, ["text"]), index.path)


def test_large_vocabulary_gives_the_same_index(spark, docs, index, new_path, monkeypatch):
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 0)
    other = build_index(ops.stack_fields(docs, ["text"]), new_path("large"), buckets=2)
    assert rows(other.postings()) == rows(index.postings())
    assert rows(other.doc_stats()) == rows(index.doc_stats())


def test_weights_need_no_shuffle(index, capsys):
    weighting.vector_norms(weighting.vectorize(index, "text", "tfidf")).explain()
    top_terms.best_terms_in_docs(index, 3, "tfidf").explain()
    plans = capsys.readouterr().out
    # Postings hold no statistics of their terms; while these are small they are broadcast and nothing is moved.
    assert "Exchange" not in plans.replace("BroadcastExchange", "") and "term_stats" in plans


def test_salted_join_equals_broadcast_join(spark, capsys):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    postings = ops.term_vectors(ops.stack_fields(docs, ["text"]))
    stats = ops.term_stats(postings)
    whole = join_on_term(postings, stats)
    salted = join_on_term(postings, stats, max_rows=0, hot_share=50)
    salted.explain(True)
    assert "salt" in capsys.readouterr().out
    assert whole.exceptAll(salted).count() == 0 and salted.exceptAll(whole).count() == 0


def test_postings_of_frequent_terms_stay_where_they_are(spark, new_path, monkeypatch, capsys):
    rows_of = lambda i: " ".join([f"t{j}" for j in range(12) if i % (j + 1) == 0] + [f"own{i}", f"own{i}"])
    docs = spark.createDataFrame([(i, rows_of(i)) for i in range(200)] + [(200, "")], "doc_id BIGINT, text STRING")
    index = build_index(ops.stack_fields(docs, ["text"]), new_path("frequent"), buckets=3)
    small = {o: rows(top_terms.best_terms_in_docs(index, 3, o)) for o in top_terms.DOC_ORDERS}
    norms = rows(weighting.vector_norms(weighting.vectorize(index, "text", "tfidf")).selectExpr("doc_id", "round(l2, 6)"))
    # Room for the twelve frequent terms, not for the two hundred others.
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 50 * 12)
    first, others = parts_on_term(index.postings("text"), index.term_stats("text"), index.term_stats_size)
    assert {r["term"] for r in first.select("term").distinct().collect()} == {f"t{j}" for j in range(12)}
    assert others.count() == 200
    first.groupBy("doc_id").count().explain()
    assert "Exchange" not in capsys.readouterr().out.replace("BroadcastExchange", "")
    assert {o: rows(top_terms.best_terms_in_docs(index, 3, o)) for o in top_terms.DOC_ORDERS} == small
    assert rows(weighting.vector_norms(weighting.vectorize(index, "text", "tfidf")).selectExpr("doc_id", "round(l2, 6)")) == norms
    targets = docs.where("doc_id IN (6, 7)")
    for order in ("tf", "idf"):
        found = rows(top_terms.best_terms_in_docs(index, 3, order, targets=targets))
        assert found == [r for r in small[order] if r[0] in (6, 7)]
    # All in bounds but for the given size, and nothing in bounds.
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 50 * 300)
    assert parts_on_term(index.postings(), index.term_stats(), (10, 50 * 400))[1].count() == 0
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 0)
    assert {o: rows(top_terms.best_terms_in_docs(index, 3, o)) for o in top_terms.DOC_ORDERS} == small


def test_best_terms_by_tf_are_chosen_before_statistics_are_joined(index, monkeypatch, capsys):
    small, kept = rows(top_terms.best_terms_in_docs(index, 1, "tf")), []
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(top_terms, "materialize", lambda df, name: kept.append(df) or materialize(df, name))
    assert rows(top_terms.best_terms_in_docs(index, 1, "tf")) == small
    kept[0].explain()
    # One row per document meets the statistics; choosing it moved no posting.
    assert "Exchange" not in capsys.readouterr().out and kept[0].count() == len(small) == 3


def test_an_index_leaves_no_shuffle_behind(spark, new_path):
    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        named = (found.apply(i) for i in range(found.size()))
        return {f.getName(): f.length() for f in named if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}

    before, setting = shuffles(), spark.conf.get(CLEANUP_SETTING)
    chance = random.Random(3)
    table = [(i, " ".join(f"w{chance.randrange(9000)}" for _ in range(300))) for i in range(400)]
    docs = materialize(spark.createDataFrame(table, "doc_id BIGINT, text STRING").repartition(5, "doc_id"), "moved")
    build_index(ops.stack_fields(docs, ["text"]), new_path("released"), buckets=4)
    end = time.time() + 20
    left = lambda: sum(n for name, n in shuffles().items() if name not in before)
    # Counts that the driver asks for may stay.
    while left() > 20_000 and time.time() < end:
        time.sleep(0.5)
    assert left() <= 20_000 and spark.conf.get(CLEANUP_SETTING) == setting


def test_folders_are_collections_of_their_own(spark, new_path):
    docs = spark.createDataFrame([(0, "a", "x x y"), (1, "b", "x"), (2, "b", "z")], "doc_id BIGINT, folder STRING, text STRING")
    partial = build_index(ops.stack_folders(docs, "folder"), new_path("folders"))
    assert rows(partial.term_stats()) == [("a", "x", 1, 2), ("a", "y", 1, 1), ("b", "x", 1, 1), ("b", "z", 1, 1)]
    assert partial.field_stats("b").first()["max_doc"] == 2


def test_best_terms(index):
    best = top_terms.best_terms_in_docs(index, 5, "tfidf").where("doc_id = 0").orderBy("position").collect()
    assert [(r["term"], r["tf"], r["cf"], r["df"]) for r in best] == [("red", 2, 2, 1), ("blue", 1, 2, 2)]
    # Equal values are in byte order of the term.
    tied = top_terms.best_terms_in_docs(index, 1, "tf").where("doc_id = 1").first()
    assert tied["term"] == "blue"
    assert [r["term"] for r in top_terms.best_terms_in_collection(index, 2, "df").collect()] == ["blue", "green"]
    found = top_terms.best_term_occurrences(index, 3, "df").collect()
    assert [(r["doc_id"], r["term"]) for r in found] == [(0, "blue"), (1, "blue"), (1, "green")]
    with pytest.raises(ValueError):
        top_terms.best_terms_in_docs(index, 1, "length")


def test_best_terms_of_chosen_documents(spark, index):
    chosen = spark.createDataFrame([(2,)], "doc_id BIGINT")
    found = top_terms.best_terms_in_docs(index, 5, "cf", targets=chosen).collect()
    assert [(r["doc_id"], r["term"], r["position"]) for r in found] == [(2, "green", 1)]


def test_representations(index):
    tf = {(r["doc_id"], r["term"]): r["w"] for r in weighting.vectorize(index, "text", "tf").collect()}
    assert tf[(2, "green")] == 3.0
    for name in ("tf-idf", "tfxidf", "tfidf"):
        ratio = {(r["doc_id"], r["term"]): r["w"] for r in weighting.vectorize(index, "text", name).collect()}
        assert ratio[(0, "red")] == 2 * 4 / 1 and ratio[(0, "blue")] == 4 / 2
    with pytest.raises(ValueError):
        weighting.vectorize(index, "text", "boolean")


def test_terms_grouped_by_value(index):
    grouped = weighting.group_terms_by_value(index.postings("text"), "tf").where("doc_id = 1").first()
    assert (grouped["value"], grouped["terms"]) == (1, ["blue", "green"])
    flat = weighting.group_collection_terms_by_value(index.term_stats("text"), "df")
    assert rows(flat) == [(1, 1, "red"), (2, 2, "blue"), (2, 2, "green")]


def test_reopened_index_does_not_trust_an_old_catalog_entry(spark, new_path):
    from textloom.operators.postings import stack_fields
    from textloom.plans.index import build_index, open_index

    docs = spark.createDataFrame([(i, f"word{i} shared") for i in range(200)], "doc_id BIGINT, text STRING")
    path = new_path("rebuilt")
    build_index(stack_fields(docs, ["text"]), path, buckets=6)
    part = f"{path}/postings"
    name = open_index(spark, path)._table_name("postings")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.table(name).schema)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (doc_id) INTO 4 BUCKETS LOCATION '{part}'")
    index = open_index(spark, path)
    assert index.buckets == 6
    assert index.postings().groupBy("doc_id").count().count() == 200


def files_read(df):
    """Files that the scans of a plan without shuffle read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def stored_files(spark, path):
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return [r["path"].rsplit("/", 1)[1] for r in listed.select("path").collect()]


def test_a_query_reads_the_files_of_its_words_alone(spark, new_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    index = build_index(ops.stack_fields(docs, ["text"]), new_path("classes"), buckets=16)
    stored = stored_files(spark, f"{index.path}/term_postings")
    classes = [r[0] for r in spark.createDataFrame([("the",), ("of",)], "term STRING").select(index.term_class()).collect()]
    found = index.term_postings(classes, "text").where("term IN ('the', 'of')")
    assert 0 < files_read(found) < len(stored) / 4
    assert rows(found) == rows(index.postings("text").where("term IN ('the', 'of')"))
    assert rows(index.term_postings(list(range(16)))) == rows(index.postings())


def test_one_document_reads_one_bucket(spark, new_path, capsys):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    index = build_index(ops.stack_fields(docs, ["text"]), new_path("one"), buckets=16)
    index.postings("text").where("doc_id = 7").groupBy("doc_id").count().explain()
    assert "SelectedBucketsCount: 1 out of 16" in capsys.readouterr().out
    for order in ("tf", "tfidf"):
        every = top_terms.best_terms_in_docs(index, 5, order).where("doc_id = 7")
        assert rows(top_terms.best_terms_in_doc(index, 7, 5, order)) == rows(every.select(top_terms.best_terms_in_doc(index, 7, 5, order).columns))
    assert top_terms.best_terms_in_doc(index, -1, 5).collect() == []
    with pytest.raises(ValueError):
        top_terms.best_terms_in_doc(index, 7, 5, "length")


def test_hot_terms_are_dealt_out_by_term_too(spark, new_path):
    docs = spark.createDataFrame([(i, f"hot w{i}") for i in range(2000)], "doc_id BIGINT, text STRING")
    index = build_index(ops.stack_fields(docs, ["text"]), new_path("hot"), buckets=8)
    hot_class = spark.createDataFrame([("hot",)], "term STRING").select(index.term_class()).first()[0]
    assert len(stored_files(spark, f"{index.path}/term_postings/term_class={hot_class}")) > 1
    assert index.term_postings([hot_class]).where("term = 'hot'").count() == 2000


def test_tasks_write_equal_shares_by_term(spark, new_path):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(40))) for i in range(500)], "doc_id BIGINT, text STRING")
    index = build_index(ops.stack_fields(docs, ["text"]), new_path("shares"), buckets=8)
    written = spark.read.parquet(f"{index.path}/term_postings").select(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task"))
    shares = [r["count"] for r in written.groupBy("task").count().collect()]
    assert sum(shares) == index.postings().count()
    assert max(shares) < 1.5 * sum(shares) / 8


def test_buckets_follow_the_bytes_of_text(spark, docs, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    long = spark.createDataFrame([(1, "word " * 1000), (2, None)], "doc_id BIGINT, text STRING").coalesce(1)
    monkeypatch.setattr("textloom.plans.index.BUCKET_BYTES", 100)
    assert default_buckets(ops.stack_fields(long, ["text"])) == 50
    assert default_buckets(ops.stack_fields(docs, ["text"])) == cores


def frame(spark, texts):
    return ops.stack_fields(spark.createDataFrame(texts, "doc_id BIGINT, text STRING"), ["text"])


def test_updates_and_compaction(spark, docs, index, new_path):
    texts = {0: "red red blue", 1: "blue green", 2: "green green green", 3: ""}
    steps = [{1: "red", 7: "new blue"}, {7: "newer", 2: None, 8: "blue " * 5}, {1: "green red", 9: "x", 8: "y y"}]
    updated = index
    for step in steps:
        updated = update_index(updated, frame(spark, list(step.items())), new_path("step"))
        texts |= step
        rebuilt = build_index(frame(spark, list(texts.items())), new_path("whole"))
        for table in ("postings", "doc_stats", "term_stats", "field_stats"):
            assert rows(getattr(updated, table)()) == rows(getattr(rebuilt, table)()), table
        assert rows(updated.term_postings(list(range(updated.buckets)))) == rows(rebuilt.postings())
        # Bounds may stay too large, never too small.
        exact = {r["term"]: r["max_share"] for r in rebuilt.term_bounds().collect()}
        assert all(r["max_share"] >= exact[r["term"]] for r in updated.term_bounds().collect())
    # An update writes the incoming documents alone.
    assert len(updated.generations) == 4
    own = spark.read.parquet(f"{updated.generations[-1][1]}/postings")
    assert {r["doc_id"] for r in own.select("doc_id").collect()} == {1, 8, 9}
    compacted = compact_index(updated, new_path("compacted"))
    buckets = [name.rsplit("_", 1)[1].split(".")[0] for name in stored_files(spark, f"{compacted.path}/postings")]
    assert len(buckets) == len(set(buckets)) and len(compacted.generations) == 1
    opened = open_index(spark, compacted.path)
    for table in ("postings", "doc_stats", "term_stats", "term_bounds", "field_stats"):
        assert rows(getattr(opened, table)()) == rows(getattr(rebuilt, table)()), table
    reopened = open_index(spark, updated.path)
    assert rows(reopened.postings()) == rows(rebuilt.postings())
    with pytest.raises(ValueError):
        compact_index(updated, updated.path)


def test_generations_are_grouped_without_a_shuffle(spark, index, new_path, capsys):
    updated = update_index(index, frame(spark, [(1, "red"), (7, "new blue")]), new_path("updated"))
    updated.postings().groupBy("doc_id", "term").agg(F.sum("tf")).explain()
    assert "Exchange" not in capsys.readouterr().out.replace("BroadcastExchange", "")


def test_update_beyond_the_broadcast_bound(spark, index, new_path, monkeypatch):
    incoming = frame(spark, [(1, "red"), (7, "new blue")])
    expected = update_index(index, incoming, new_path("updated"))
    monkeypatch.setattr("textloom.operators.joins.MAX_BROADCAST_BYTES", 0)
    other = update_index(index, incoming, new_path("updated"))
    for table in ("postings", "doc_stats", "term_stats", "field_stats"):
        assert rows(getattr(other, table)()) == rows(getattr(expected, table)())


def test_repeated_documents_of_an_update(spark, index, new_path):
    repeated = spark.createDataFrame(
        [(5, "text", "old words", 1), (5, "text", "last", 3), (5, "text", "middle", 2), (6, "text", "nothing", None)],
        "doc_id BIGINT, field STRING, text STRING, place INT",
    )
    updated = update_index(index, repeated, new_path("last"), order="place")
    assert {r["term"] for r in updated.postings().where("doc_id = 5").collect()} == {"last"}
    assert updated.doc_stats().where("doc_id = 5").count() == 1
    with pytest.raises(Exception, match="more than once"):
        update_index(index, repeated.drop("place"), new_path("error"))
