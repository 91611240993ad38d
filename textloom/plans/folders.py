"""One index per first-level folder of a collection, all built in one pass.

The stored tables lie in a directory per folder, and below it in one per bucket
of documents or class of terms. A folder has as many of these as its texts need,
so a large one is dealt out to many tasks and a small one is one file. A list of
folders names the place of each: opening a folder reads its directories alone,
and replacing one writes new directories and a new list. What other folders have
is neither read nor written then.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import postings as ops
from textloom.operators.joins import broadcast_if_small, measured_size
from textloom.plans import index as plain

#: Bytes of text in one bucket of a folder.
BUCKET_BYTES = plain.BUCKET_BYTES

CATALOG_SCHEMA = "folder STRING, folder_key STRING, buckets INT, words BIGINT, location STRING"
FIELD_STATS_SCHEMA = f"folder_key STRING, {plain.FIELD_STATS_SCHEMA}"

# Tables with a directory per folder: their columns, and the column of the directories below it.
STORED = {
    "postings": (plain.POSTINGS_SCHEMA, "bucket"),
    "doc_stats": (plain.DOC_STATS_SCHEMA, "bucket"),
    "term_postings": (plain.POSTINGS_SCHEMA, "term_class"),
    "term_stats": (plain.TERM_BOUNDS_SCHEMA, "term_class"),
}
TERM_STATS = ["field", "term", "df", "cf"]


def _columns(part: str) -> list[str]:
    return [c.split()[0] for c in STORED[part][0].split(", ")]


@dataclass(frozen=True)
class FolderIndex:
    """The index of one folder; takes the place of a ``TextIndex`` in searches, weights and best terms."""

    spark: SparkSession
    folder: str
    key: str
    buckets: int
    words: int
    path: str

    def _stored(self, part: str) -> DataFrame:
        schema, split = STORED[part]
        if not self.words and part != "doc_stats":  # texts without words have no directory there
            return self.spark.createDataFrame([], f"{schema}, {split} INT")
        # The folder's own directory, so that Spark does not even list others.
        return self.spark.read.schema(f"{schema}, {split} INT").parquet(f"{self.path}/{part}/folder_key={self.key}")

    def _of(self, part: str, field: str | None) -> DataFrame:
        return plain._of_field(self._stored(part).select(*_columns(part)), field)

    def postings(self, field: str | None = None) -> DataFrame:
        """``(doc_id, field, term, tf, dl)``."""
        return self._of("postings", field)

    def document(self, doc_id: int, field: str | None = None) -> DataFrame:
        """The postings of one document, from its bucket alone."""
        bucket = F.pmod(F.xxhash64(F.lit(doc_id).cast("long")), F.lit(self.buckets)).cast("int")
        own = self._stored("postings").where((F.col("bucket") == bucket) & (F.col("doc_id") == doc_id))
        return plain._of_field(own.select(*_columns("postings")), field)

    def doc_stats(self, field: str | None = None) -> DataFrame:
        """``(doc_id, field, dl, n_terms)``."""
        return self._of("doc_stats", field)

    def term_postings(self, classes: list[int], field: str | None = None) -> DataFrame:
        """The postings of some classes of terms, read from these classes' files alone."""
        chosen = self._stored("term_postings").where(F.col("term_class").isin(classes))
        return plain._of_field(chosen.select(*_columns("term_postings")), field)

    def term_bounds(self, field: str | None = None) -> DataFrame:
        """``(field, term, df, cf, max_share)``."""
        return self._of("term_stats", field)

    def term_stats(self, field: str | None = None) -> DataFrame:
        """``(field, term, df, cf)``."""
        return self.term_bounds(field).select(*TERM_STATS)

    @cached_property
    def term_stats_size(self) -> tuple[int, int]:
        return measured_size(self.term_stats())

    def field_stats(self, field: str | None = None) -> DataFrame:
        """One row per field."""
        rows = self.spark.read.schema(FIELD_STATS_SCHEMA).parquet(f"{self.path}/field_stats")
        return plain._of_field(rows.where(F.col("folder_key") == self.key).drop("folder_key"), field)

    def term_class(self, term: str | Column = "term") -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class FolderIndexes:
    """All folders of a collection, through their list below ``path``."""

    spark: SparkSession
    path: str

    def folders(self) -> DataFrame:
        """``(folder, folder_key, buckets, words, location)``."""
        return self.spark.read.schema(CATALOG_SCHEMA).parquet(f"{self.path}/folders")

    def folder(self, name: str) -> FolderIndex:
        found = self.folders().where(F.col("folder") == name).first()
        if found is None:
            raise KeyError(f"no index of a folder {name!r}")
        return FolderIndex(self.spark, name, found["folder_key"], found["buckets"], found["words"], found["location"])

    def _every(self, part: str, schema: str, *columns: str) -> DataFrame:
        """A stored table of all folders, with ``folder`` first; directories that were replaced are pruned."""
        live = self.folders()
        places = [r["location"] for r in live.select("location").distinct().orderBy("location").collect()]
        frames = []
        for place in places:
            here = live.where(F.col("location") == place).select("folder", "folder_key")
            rows = self.spark.read.schema(schema).parquet(f"{place}/{part}").join(broadcast_if_small(here), "folder_key")
            frames.append(rows.select("folder", *columns))
        if not frames:
            return self.spark.createDataFrame([], f"folder STRING, {schema}").select("folder", *columns)
        return reduce(DataFrame.unionByName, frames)

    def _stored(self, part: str) -> DataFrame:
        schema, split = STORED[part]
        return self._every(part, f"{schema}, folder_key STRING, {split} INT", *_columns(part))

    def postings(self) -> DataFrame:
        """``(folder, doc_id, field, term, tf, dl)``."""
        return self._stored("postings")

    def doc_stats(self) -> DataFrame:
        """``(folder, doc_id, field, dl, n_terms)``."""
        return self._stored("doc_stats")

    def term_stats(self) -> DataFrame:
        """``(folder, field, term, df, cf)``: statistics within each folder."""
        return self._stored("term_stats").select("folder", *TERM_STATS)

    def field_stats(self) -> DataFrame:
        """One row per folder and field."""
        return self._every("field_stats", FIELD_STATS_SCHEMA, "field", *plain.FIELD_SUMS)


def build_folder_indexes(stacked: DataFrame, path: str, bucket_bytes: int = BUCKET_BYTES) -> FolderIndexes:
    """The indexes of all folders of ``(doc_id, folder, field, text)``, below ``path``.

    Rows without a folder, those of files directly in the root, are left out. A
    text is moved and tokenized once.
    """
    _store(stacked, path, bucket_bytes).write.mode("overwrite").parquet(f"{path}/folders")
    return open_folder_indexes(stacked.sparkSession, path)


def open_folder_indexes(spark: SparkSession, path: str) -> FolderIndexes:
    """Folders that were built or replaced below ``path``, in any later session."""
    return FolderIndexes(spark, path.rstrip("/"))


def replace_folders(
    indexes: FolderIndexes, stacked: DataFrame, path: str, removed: list[str] | None = None, bucket_bytes: int = BUCKET_BYTES
) -> FolderIndexes:
    """New indexes below ``path``: folders that ``stacked`` has replace those of the same name or are added, ``removed`` ones go.

    Only the texts of these folders are read and written. The files of the others
    stay where they are, and must.
    """
    if path.rstrip("/") == indexes.path:
        raise ValueError("the changed indexes need a new path")
    new = _store(stacked, path, bucket_bytes)
    kept = indexes.folders().join(broadcast_if_small(new.select("folder")), "folder", "left_anti")
    if removed:
        kept = kept.where(~F.col("folder").isin(removed))
    kept.unionByName(new).write.mode("overwrite").parquet(f"{path}/folders")
    return open_folder_indexes(stacked.sparkSession, path)


def _store(stacked: DataFrame, path: str, bucket_bytes: int) -> DataFrame:
    """Writes the tables of all folders of ``stacked``; returns their rows in the list of folders."""
    path = path.rstrip("/")
    spark = stacked.sparkSession
    texts = stacked.where(F.col("folder").isNotNull()).withColumn("folder_key", F.md5("folder"))
    sizes = texts.groupBy("folder", "folder_key").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"))
    sizes.write.mode("overwrite").parquet(f"{path}/sizes")
    sizes = spark.read.schema("folder STRING, folder_key STRING, bytes BIGINT").parquet(f"{path}/sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    # A folder of several buckets holds more than this, so there are at most MAX_BUCKETS such folders.
    step = max(bucket_bytes, total // plain.MAX_BUCKETS, 1)
    buckets = F.greatest(F.ceil(F.col("bytes") / F.lit(step)), F.lit(1)).cast("int").alias("buckets")
    new = sizes.select("folder", "folder_key", buckets, F.lit(path).alias("location"))
    wide = F.broadcast(new.where("buckets > 1").select("folder_key", "buckets"))
    parts = min(max(new.agg(F.sum("buckets")).first()[0] or 0, spark.sparkContext.defaultParallelism), plain.MAX_BUCKETS)

    def split(rows: DataFrame, by: str, name: str) -> DataFrame:
        number = F.pmod(F.xxhash64(by), F.coalesce(F.col("buckets"), F.lit(1))).cast("int")
        return rows.join(wide, "folder_key", "left").withColumn(name, number).drop("buckets")

    def write(rows: DataFrame, part: str, *order: str) -> DataFrame:
        directory = ["folder_key", STORED[part][1]]
        ordered = rows.select(*_columns(part), *directory).sortWithinPartitions(*directory, *order)
        ordered.write.mode("overwrite").partitionBy(*directory).parquet(f"{path}/{part}")
        return spark.read.schema(f"{STORED[part][0]}, folder_key STRING, {STORED[part][1]} INT").parquet(f"{path}/{part}")

    def deal(rows: DataFrame, *order) -> DataFrame:
        """By ranges, whose bounds Spark draws from the rows: hashes of few buckets would meet in some tasks and miss others."""
        return rows.repartitionByRange(parts, *order)

    placed = split(texts.select("doc_id", "folder_key", "field", "text"), "doc_id", "bucket")
    dealt = deal(placed, "folder_key", "bucket").sortWithinPartitions("folder_key", "bucket", "doc_id", "field")
    # The place of a text rides along in the column that vectors are made within.
    place = F.struct("folder_key", "bucket", "field")
    vectors = ops.term_vectors(dealt.select("doc_id", place.alias("field"), "text"))
    vectors = vectors.select("doc_id", "term", "tf", "dl", "field.folder_key", "field.bucket", "field.field")
    postings = write(vectors, "postings", "doc_id", "field", "term")

    keys = ["folder_key", "bucket", "doc_id", "field"]
    counted = postings.groupBy(*keys).agg(F.min("dl").alias("dl"), F.count("*").alias("n_terms"))
    lengths = placed.select(*keys).join(counted, keys, "left")
    lengths = lengths.select(*keys, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("dl", "n_terms")])
    doc_stats = write(deal(lengths, "folder_key", "bucket"), "doc_stats", "doc_id", "field")

    # A hot term is dealt out by its documents.
    by_term = split(postings.select("folder_key", *plain.VECTOR_COLUMNS), "term", "term_class")
    by_term = write(deal(by_term, "folder_key", "term_class", "field", "term", "doc_id"), "term_postings", "field", "term", "doc_id")
    stats = by_term.groupBy("folder_key", "term_class", "field", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max(F.col("tf") / F.col("dl")).alias("max_share")
    )
    write(deal(stats, "folder_key", "term_class"), "term_stats", "field", "term")

    fields = doc_stats.groupBy("folder_key", "field").agg(
        F.count_if(F.col("dl") > 0).alias("doc_count"),
        F.count("*").alias("max_doc"),
        F.sum("n_terms").alias("sum_doc_freq"),
        F.sum("dl").alias("sum_total_term_freq"),
    )
    fields.write.mode("overwrite").parquet(f"{path}/field_stats")
    words = spark.read.schema(FIELD_STATS_SCHEMA).parquet(f"{path}/field_stats").groupBy("folder_key").agg(F.sum("sum_total_term_freq").alias("words"))
    return new.join(words, "folder_key").select("folder", "folder_key", "buckets", "words", "location")
