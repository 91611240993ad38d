"""Registration, and the tables that queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.joins import broadcast_if_small, is_small
from textloom.operators.postings import spread, stack_fields, stack_folders
from textloom.plans.folders import FolderIndexes, build_folder_indexes, open_folder_indexes, replace_folders
from textloom.plans.index import TextIndex, build_index, compact_index, open_index, update_index
from textloom.session import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Decimals of the values handed out.
DIGITS = 6


def query(name: str, sql: str | None = None):
    """Register ``function(workspace)`` under ``name``."""

    def register(function: Callable[[Workspace], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: function(workspace(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


class Workspace:
    """The tables of one folder, with the stored index and judgements made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.kept: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @property
    def texts(self) -> DataFrame:
        """``(doc_id, field, text)`` of the field ``text``."""
        return stack_fields(self.documents, ["text"])

    @property
    def dealt_texts(self) -> DataFrame:
        """The same, for operators that work on each text where it lies."""
        return spread(self.texts)

    @property
    def queries(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").alias("query_id"), "text")

    @cached_property
    def index(self) -> TextIndex:
        return build_index(self.texts, scratch_path(self.spark, "index"))

    @cached_property
    def partial_indexes(self) -> TextIndex:
        """Statistics by ``source``, which plays the first-level folder."""
        return build_index(stack_folders(self.documents, "source"), scratch_path(self.spark, "partial-index"))

    @cached_property
    def field_index(self) -> TextIndex:
        """An index of three fields, opened again from its files."""
        path = scratch_path(self.spark, "field-index")
        build_index(stack_fields(self.documents, ["text", "lang", "source"]), path)
        return open_index(self.spark, path)

    @cached_property
    def replaced_folder(self) -> str | None:
        """The source whose documents ``folder_indexes`` has replaced."""
        return self.documents.agg(F.min("source")).first()[0]

    @cached_property
    def folder_indexes(self) -> FolderIndexes:
        """An index per ``source``, of which one was replaced by all pages, opened again."""
        columns = [F.lit("text").alias("field"), "text"]
        documents = self.documents.select("doc_id", F.col("source").alias("folder"), *columns)
        built = build_folder_indexes(documents, scratch_path(self.spark, "folder-indexes"))
        pages = self.table("pages").select(F.col("page_id").alias("doc_id"), F.lit(self.replaced_folder).alias("folder"), F.col("html").alias("text"))
        changed = replace_folders(built, pages.select("doc_id", "folder", *columns), scratch_path(self.spark, "folder-indexes"))
        return open_folder_indexes(self.spark, changed.path)

    @cached_property
    def updated_index(self) -> TextIndex:
        """The index of the documents after two updates: all pages, then all turns of conversations, of which the last counts."""
        pages = self.table("pages").select(F.col("page_id").alias("doc_id"), F.lit("text").alias("field"), F.col("html").alias("text"))
        turns = self.table("conversations").select(F.col("conv_id").alias("doc_id"), F.lit("text").alias("field"), "text", "turn")
        first = update_index(self.index, pages, scratch_path(self.spark, "updated-index"))
        return update_index(first, turns, scratch_path(self.spark, "updated-index"), order="turn")

    @cached_property
    def compacted_index(self) -> TextIndex:
        return compact_index(self.updated_index, scratch_path(self.spark, "compacted-index"))

    @cached_property
    def qrels(self) -> DataFrame:
        """``(query_id, doc_id)``: the document's text contains the query's, ignoring case."""
        return materialize(containing_documents(self.documents, self.queries), "qrels")

    @cached_property
    def longest_document(self) -> int:
        """The target of similarity queries: the document of most words, the first of equals."""
        return self.index.doc_stats("text").orderBy(F.desc("dl"), "doc_id").first()["doc_id"]

    @cached_property
    def query_halves(self) -> tuple[str, str]:
        """Two id ranges that split the query set in the middle."""
        row = self.queries.agg(F.min("query_id").alias("lo"), F.max("query_id").alias("hi")).first()
        middle = (row["lo"] + row["hi"]) // 2
        return f"{row['lo']}-{middle}", f"{middle + 1}-{row['hi']}"


ANCHOR_WORDS = 3


def _runs(words, n):
    """All runs of ``n`` words of a list."""
    starts = F.sequence(F.lit(1), F.size(words) - n + 1)
    found = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
    return F.when(F.size(words) >= n, found).otherwise(F.array().cast("array<string>"))


def containing_documents(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Pairs where the document's whole text contains the query's whole text, ignoring case.

    Not by comparing every pair: words with a blank on both sides inside the
    query text appear as the same words in a text that contains it. So the
    longest run of three such words (of two, or one, in a shorter query) is an
    equi-join key, and only documents with that run are then searched for the
    whole text. Queries without such a word are looked for in every text; their
    number is checked.
    """
    needles = queries.select("query_id", F.lower("text").alias("needle")).where(F.length("needle") > 0)
    parts = needles.select("query_id", "needle", F.split("needle", " ").alias("parts"))
    inner = parts.select("query_id", "needle", F.slice("parts", 2, F.greatest(F.size("parts") - 2, F.lit(0))).alias("inner"))
    longest = F.coalesce(
        *[
            F.array_max(F.transform(_runs(F.col("inner"), n), lambda s: F.struct(F.length(s).alias("n"), s.alias("run"))))
            for n in range(ANCHOR_WORDS, 0, -1)
        ]
    )
    width = F.least(F.size("inner"), F.lit(ANCHOR_WORDS))
    anchors = materialize(inner.select("query_id", "needle", longest["run"].alias("run"), width.alias("width")), "anchors")
    words = spread(docs.select("doc_id", "text")).select("doc_id", F.split(F.lower("text"), " ").alias("words"))
    widths = [r["width"] for r in anchors.where("width > 0").select("width").distinct().orderBy("width").collect()]
    candidates = None
    for n in widths:
        # Each word with the ones after it, as columns: no text is made of a run. Runs beyond the end have a null.
        names = [f"word_{i}" for i in range(n)]
        shifted = [F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(0))).alias(names[i]) for i in range(n)]
        found = words.select("doc_id", F.inline(F.arrays_zip(*shifted)).alias(*names))
        run = F.split("run", " ")
        wanted = anchors.where(F.col("width") == n).select("query_id", *[F.get(run, F.lit(i)).alias(names[i]) for i in range(n)])
        pairs = found.join(broadcast_if_small(wanted), names).select("query_id", "doc_id").distinct()
        candidates = pairs if candidates is None else candidates.unionByName(pairs)
    short = anchors.where("width = 0").select("query_id", "needle")
    if not short.isEmpty():
        if not is_small(short):
            raise ValueError("too many queries of fewer than three words")
        rows = short.orderBy("query_id").collect()
        array = F.array(*[F.struct(F.lit(r["query_id"]).alias("query_id"), F.lit(r["needle"]).alias("needle")) for r in rows])
        lowered = docs.select("doc_id", F.lower("text").alias("text"))
        hits = F.filter(array, lambda s: F.contains(F.col("text"), s["needle"]))
        pairs = lowered.select("doc_id", F.explode(hits).alias("hit")).select(F.col("hit.query_id").alias("query_id"), "doc_id")
        candidates = pairs if candidates is None else candidates.unionByName(pairs)
    if candidates is None:
        return docs.select("doc_id").limit(0).select(F.lit(0).cast("long").alias("query_id"), "doc_id")
    candidates = materialize(candidates, "candidates")
    checked = docs.select("doc_id", "text").join(broadcast_if_small(candidates), "doc_id")
    checked = checked.join(broadcast_if_small(anchors.select("query_id", "needle")), "query_id")
    return checked.where(F.contains(F.lower("text"), F.col("needle"))).select("query_id", "doc_id")


_workspaces: dict[tuple, Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """The workspace of ``folder``, reused as long as session and files are the same."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    state = (
        listing.load(folder)
        .select("path", "length", "modificationTime")
        .agg(F.count("*"), F.sum("length"), F.max("modificationTime"), F.sum(F.hash("path", "length")))
        .first()
    )
    key = (spark.sparkContext.applicationId, folder, tuple(state))
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark, folder)
    return _workspaces[key]
