import glob
import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from textloom.session import scratch_root
from textloom.sources import files, records, reports, tables


def read_parts(path):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for name, text in {
        "root.txt": "one\ntwo\nthree\n",
        "mytxt": "not text",
        "a/first.md": "# title\n",
        "a/single.txt": "only",
        "a/deep/lower.txt": "ünder\n",
        "b/blank.txt": "\n",
        "b/zero.txt": "",  # Spark's file listing leaves files of zero bytes out
    }.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text, encoding="utf-8")
    return str(root)


# What Spark's own listing gives.
plain_files = partial(files.read_text_tree, every_file=False)


def names(df):
    return sorted(r["rel_path"] for r in df.select("rel_path").collect())


def test_tree_is_scanned_with_its_folders(spark, tree):
    found = {r["rel_path"]: (r["depth"], r["top_folder"]) for r in plain_files(spark, tree).collect()}
    assert found == {
        "root.txt": (0, None),
        "mytxt": (0, None),
        "a/first.md": (1, "a"),
        "a/single.txt": (1, "a"),
        "a/deep/lower.txt": (2, "a"),
        "b/blank.txt": (1, "b"),
    }


def test_root_may_be_given_with_a_scheme(spark, tree):
    plain = names(plain_files(spark, tree))
    assert names(plain_files(spark, f"file://{tree}/")) == names(plain_files(spark, f"file:{tree}")) == plain


def test_extensions_and_depth(spark, tree):
    assert names(plain_files(spark, tree, extensions=[".txt"])) == [
        "a/deep/lower.txt",
        "a/single.txt",
        "b/blank.txt",
        "root.txt",
    ]
    assert names(plain_files(spark, tree, extensions=["md", "txt"], min_depth=1, max_depth=1)) == [
        "a/first.md",
        "a/single.txt",
        "b/blank.txt",
    ]
    assert names(plain_files(spark, tree, min_depth=2)) == ["a/deep/lower.txt"]
    with pytest.raises(ValueError):
        plain_files(spark, tree, max_depth=0)


def test_every_file_is_a_document(spark, tmp_path):
    texts = {"a.txt": "a", "empty.txt": "", "_h.txt": "h\n", ".dot.txt": "dot", "_b/c/x y{1}.txt": "ünder", ".b/_empty.txt": "", "_h.md": "no", "h=1/d.txt": "d"}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        docs = files.file_documents(files.read_text_tree(spark, root, extensions=["txt"], every_file=True))
        found = {r["rel_path"]: (r["text"], r["size_bytes"], r["top_folder"]) for r in docs.collect()}
        want = {n: (t, len(t.encode()), n.split("/")[0] if "/" in n else None) for n, t in texts.items() if n != "_h.md"}
        assert found == want and docs.count() == len(want)
    assert names(files.read_text_tree(spark, str(tmp_path), every_file=True)) == sorted(texts)
    assert names(files.read_text_tree(spark, str(tmp_path), ["txt"], min_depth=1, every_file=True)) == [".b/_empty.txt", "_b/c/x y{1}.txt", "h=1/d.txt"]


def test_empty_files_are_documents_by_default(spark, tree):
    found = {r["rel_path"]: r["content"] for r in files.read_text_tree(spark, tree).collect()}
    assert len(found) == 7 and found["b/zero.txt"] == b""


def test_levels_are_listed_as_deep_as_asked(spark, tmp_path):
    for depth in range(4):
        folder = tmp_path / "/".join(["_d"] * depth)
        folder.mkdir(exist_ok=True)
        (folder / "x.txt").write_text(str(depth))
        (folder / f"empty{depth}").write_text("")
    (tmp_path / "none").mkdir()
    base = f"file:{tmp_path}/"
    listed = lambda n: sorted(r["rel_path"] for r in files._listed_by_tasks(spark, base, ("",), n).collect())
    assert listed(0) == ["empty0"]
    assert listed(1) == ["_d/empty1", "_d/x.txt", "empty0"]
    assert listed(None) == listed(9) and len(listed(None)) == 7
    found = files.read_text_tree(spark, str(tmp_path), min_depth=1, max_depth=2)
    assert sorted((r["depth"], r["content"]) for r in found.collect()) == [(1, b""), (1, b"1"), (2, b""), (2, b"2")]


def test_driver_lists_a_store_that_tasks_cannot_open(spark, tmp_path, monkeypatch):
    for name, text in {"a.txt": "a", "empty.txt": "", "_b/c.txt": "c", "_b/c.md": "no"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    assert not files._tasks_open("viewfs://store/in/") and files._tasks_open(f"file:{tmp_path}/")
    by_tasks = files.read_text_tree(spark, str(tmp_path), ["txt"]).orderBy("path").collect()
    monkeypatch.setattr(files, "_tasks_open", lambda base: False)
    assert files.read_text_tree(spark, str(tmp_path), ["txt"]).orderBy("path").collect() == by_tasks
    assert [r["content"] for r in by_tasks] == [b"c", b"a", b""]


def test_listing_does_not_open_files(spark, tmp_path):
    (tmp_path / "_h.txt").write_text("h")
    plan = files.read_text_tree(spark, str(tmp_path)).select("rel_path", "size_bytes")._jdf.queryExecution().optimizedPlan().toString()
    assert "content_of" not in plan


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}/x.txt").write_text(str(i))
    found = files.read_text_tree(spark, str(tmp_path), ["txt"], min_depth=1)
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(int(r["content"]) for r in found.collect()) == list(range(300))


@pytest.mark.parametrize("kind", ["text", "csv"])
def test_tasks_write_the_files_that_spark_writes(spark, tmp_path, kind):
    hosts = ["a.b", "a.b", "A.B", None, "", "x:80/%1", "ü {1}[2]^'#*?=\\\x01\x7f~", "a.b"]
    texts = ["one", 'two, "2"', " spaces ", None, "", "lines\nof\ttext\r\n", "a\\b 'c'", "one"]
    rows = [(h, i // 2 if i < 7 else 0, t) for i, (h, t) in enumerate(zip(hosts, texts))] + [("n", None, "x"), ("n", None, "w")]
    table = spark.createDataFrame(rows, "host STRING, id LONG, text STRING")

    def written(root):
        found = {}
        for folder, _, names in os.walk(root):
            for name in names:
                if not name.startswith((".", "_")):
                    part, ending = name.split("-")[1], name.rpartition(".")[2]
                    found[os.path.relpath(folder, root), part, ending] = open(f"{folder}/{name}", "rb").read()
        return found

    for splits in (1, 3, 20):
        dealt = table.coalesce(1) if splits == 1 else table.repartition(splits, F.col("text"))
        ours, sparks = f"{tmp_path}/ours{splits}", f"{tmp_path}/sparks{splits}"
        files.write_tree(dealt, ours, ["host", "id"], kind)
        getattr(dealt.write.partitionBy("host", "id"), kind)(sparks)
        assert written(ours) == written(sparks) and len(written(ours)) >= 7
    assert sorted(os.listdir(tmp_path)) == sorted(f"{who}{n}" for who in ("ours", "sparks") for n in (1, 3, 20))
    assert not glob.glob(f"{tmp_path}/ours*/**/.*", recursive=True)  # no process per file, so no checksum beside it
    files.write_tree(table.limit(0), f"{tmp_path}/none", ["host", "id"], kind)
    assert files.read_text_tree(spark, f"{tmp_path}/none").count() == 0


def test_file_documents(spark, tree):
    docs = files.file_documents(files.read_text_tree(spark, tree), n_top=2, n_bottom=2)
    found = {r["rel_path"]: r for r in docs.collect()}
    root = found["root.txt"]
    assert (root["line_count"], root["top_lines"], root["bottom_lines"]) == (3, "one two", "two three")
    assert (root["size_bytes"], root["file_type"]) == (14, "regular file")
    assert found["a/deep/lower.txt"]["size_bytes"] == 7
    blank = found["b/blank.txt"]
    assert (blank["line_count"], blank["top_lines"], blank["text"]) == (1, "", "\n")
    assert root["modified_iso"].endswith("Z") and len(root["modified_key"]) == 17


def test_partial_collections_leave_out_the_root(spark, tree, new_path):
    docs = tables.partition_by_top_folder(plain_files(spark, tree).drop("top_folder"))
    path = new_path("partial")
    tables.write_collection(docs.drop("content"), path, partition_by="top_folder")
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["top_folder=a", "top_folder=b"]
    assert names(spark.read.parquet(path).where("top_folder = 'b'")) == ["b/blank.txt"]


def test_marked_records(spark, tmp_path):
    text = ".I 1\n.W\nfirst line of record one\nsecond line\n.I 2\n.W\nonly line (with a .I bracket\n\n.I 3\n.W\n.I 4\n.W\nlast"
    (tmp_path / "records").write_text(text)
    found = {r["id"]: r["text"] for r in records.read_marked_records(spark, str(tmp_path / "records")).collect()}
    assert found == {
        1: "first line of record one second line",
        2: "only line (with a .I bracket",
        3: "",
        4: "last",
    }


def test_marked_records_with_other_line_ends(spark, tmp_path):
    (tmp_path / "records").write_bytes(b".I 1\r\n.W\r\none\r\ntwo\r\n.I 2\r\n.W\r\nthree\r\n")
    found = records.read_marked_records(spark, str(tmp_path / "records")).collect()
    assert sorted(map(tuple, found)) == [(1, "one two"), (2, "three")]


def test_records_split_over_tasks(spark, tmp_path):
    text = "".join(f".I {i}\n.W\nline {i}\nmore {i}\n" for i in range(2000))
    (tmp_path / "many").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = records.read_marked_records(spark, str(tmp_path / "many"))
        assert found.rdd.getNumPartitions() > 4
        assert {r["id"]: r["text"] for r in found.collect()} == {i: f"line {i} more {i}" for i in range(2000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_judgements(spark, tmp_path):
    (tmp_path / "judged").write_text("1 0 13 1\n1 0 14 1\n2 0 80 1\n2 0 80 1\n\n\n")
    assert sorted(map(tuple, records.read_qrels(spark, str(tmp_path / "judged")).collect())) == [(1, 13), (1, 14), (2, 80)]


def test_upsert_replaces_and_adds(spark, new_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id BIGINT, text STRING")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "doc_id BIGINT, text STRING")
    source, target, fresh = new_path("old"), new_path("new"), new_path("fresh")
    tables.write_collection(old, source)
    tables.update_collection(spark, source, new, target)
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(Exception):
        tables.update_collection(spark, new_path("missing"), new, fresh)
    tables.update_collection(spark, new_path("missing"), new, fresh, create=True)
    assert spark.read.parquet(fresh).count() == 2
    with pytest.raises(ValueError):
        tables.update_collection(spark, source, new, source)


def test_create_drops_what_exists(spark, new_path):
    path = new_path("created")
    tables.write_collection(spark.range(5), path)
    tables.write_collection(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_dump(spark, docs, new_path):
    path = new_path("dump")
    tables.write_dump(docs.where("doc_id = 1").withColumn("lang", F.lit("en")), path)
    assert read_parts(path) == "\ndocID 1\ntext: blue green\nlang: en\n"
    assert tables.dump_collection(docs).count() == 4


def test_sweep_report(spark, new_path):
    rows = [(0.1, 21, 0.5), (0.1, 22, 0.25), (0.2, 21, 1.0), (0.2, 22, 0.0)]
    table = reports.sweep_table(spark.createDataFrame(rows, "lam DOUBLE, query_id BIGINT, value DOUBLE"), [0.1, 0.2])
    path = new_path("sweep-report")
    reports.write_report(table, path, "MAP", 10)
    lines = [line for line in read_parts(path).splitlines() if not line.startswith("Corte")]
    assert lines == ["query 21;0.5;1.0", "query 22;0.25;0.0", "Promedio:;0.375;0.5"]
    assert "Corte=10 & metrica=MAP;lambda 0.1;lambda 0.2" in read_parts(path)


def test_run_report_is_read_back(spark, new_path):
    values = spark.createDataFrame([(21, 0.5), (22, 0.25)], "query_id BIGINT, value DOUBLE")
    path = new_path("run-report")
    reports.write_report(reports.run_table(values, "lambda 0.1"), path, "MAP", 10)
    found = reports.read_run_results(spark, path, "jm").orderBy("query_id").collect()
    assert [tuple(r) for r in found] == [("jm", 21, "MAP", 10, 0.5), ("jm", 22, "MAP", 10, 0.25)]


def test_reports_of_the_other_layout_are_read(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Corte=10 & metrica=MAP;lambda 0.1;\nquery 21;0.5;\nquery 22;0.25;\nPromedio:;0.375\n")
    found = reports.read_run_results(spark, str(tmp_path / "r.csv"), "x").collect()
    assert sorted((r["query_id"], r["value"]) for r in found) == [(21, 0.5), (22, 0.25)]
    (tmp_path / "other.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError):
        reports.read_run_results(spark, str(tmp_path / "other.csv"), "x")


def test_report_names(spark):
    jm = reports.report_name("docs.jm", "1-20", "21-30", "MAP", 10)
    classic = reports.report_name("docs.classic", None, "21-30", "MAP", 10)
    row = spark.createDataFrame([(jm,)], "name STRING").select(*reports.parse_run_name(F.col("name"))).first()
    assert tuple(row) == ("docs.jm", 21, 30, "MAP", 10)
    assert reports.comparable(jm, classic)
    assert not reports.comparable(jm, reports.report_name("docs.jm", None, "21-30", "P", 10))
    assert not reports.comparable("a.csv", "a.csv")


def test_all_reports_of_a_folder_are_read_in_one_scan(spark, new_path):
    folder = new_path("reports")
    for run, value in (("docs.jm", 0.5), ("docs.classic", 0.25)):
        values = spark.createDataFrame([(21, value), (22, value / 2)], "query_id BIGINT, value DOUBLE")
        name = reports.report_name(run, None, "21-22", "MAP", 10)
        reports.write_report(reports.run_table(values, run), f"{folder}/{name}", "MAP", 10)
    found = sorted(map(tuple, reports.read_named_results(spark, folder).collect()))
    assert found == [
        ("docs.classic", 21, 22, "MAP", 10, 21, 0.25),
        ("docs.classic", 21, 22, "MAP", 10, 22, 0.125),
        ("docs.jm", 21, 22, "MAP", 10, 21, 0.5),
        ("docs.jm", 21, 22, "MAP", 10, 22, 0.25),
    ]


def test_ranking_report_has_a_folder_per_run(spark, new_path):
    run = spark.createDataFrame([("a", 1, 1, 5, 0.5), ("b", 1, 1, 6, 0.4)], "run_id STRING, query_id BIGINT, rank INT, doc_id BIGINT, score DOUBLE")
    path = new_path("ranking")
    reports.write_ranking_report(run, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["run_id=a", "run_id=b"]


def test_top_terms_keep_their_order(spark, new_path):
    path = new_path("terms")
    reports.write_top_terms(spark.createDataFrame([("b", 2), ("a", 1)], "term STRING, df BIGINT").orderBy(F.desc("df")), path)
    assert [line for line in read_parts(path).splitlines() if line != "term\tdf"] == ["b\t2", "a\t1"]


def test_scratch_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (named.rstrip("/") if named else scratch_root(spark))


def test_record_without_a_number_is_an_error(spark):
    from textloom.sources.records import parse_marked_records

    good = spark.createDataFrame([(".I 1\n.W\none",), ("2\n.W\ntwo\n",), ("",)], "value STRING")
    assert [(r["id"], r["text"]) for r in parse_marked_records(good).collect()] == [(1, "one"), (2, "two")]
    bad = spark.createDataFrame([("x2\n.W\ntext",)], "value STRING")
    with pytest.raises(Exception, match="without a numeric id"):
        parse_marked_records(bad).collect()


def test_upsert_with_a_repeated_key(spark):
    from textloom.sources.tables import upsert_documents

    existing = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id BIGINT, text STRING")
    incoming = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (3, "c", 1)], "doc_id BIGINT, text STRING, at INT")
    got = upsert_documents(existing, incoming, order="at")
    assert sorted(map(tuple, got.collect())) == [(1, "new"), (2, "b"), (3, "c")]
    with pytest.raises(Exception, match="more than once"):
        upsert_documents(existing, incoming.drop("at")).collect()
