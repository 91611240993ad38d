"""The stored term tables of a collection.

A text is moved once, to the bucket of its document, and tokenized once. Its
postings are stored twice: ``postings``, bucketed and sorted by document, for
all that is grouped by document; and ``term_postings``, in classes of terms, for
a query, which reads the classes of its words alone. Statistics of terms and
fields are counted from the stored postings, those of terms from the latter, so
that a task has few terms.

An index is a list of generations. An update writes the postings of the incoming
documents as a new generation and changes the statistics by signed differences;
what it replaces stays in the files of older generations and is left out when
they are read. ``compact_index`` writes one generation again, with one sorted
file per bucket.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators import postings as ops
from textloom.operators.joins import broadcast_if_small, is_small, measured_size
from textloom.session import shuffles_released

MAX_BUCKETS = 100_000

#: Bytes of text in one bucket.
BUCKET_BYTES = 32 << 20

#: Of the postings, which take as much room as the texts.
COMPRESSION = "zstd"

POSTINGS_SCHEMA = "doc_id BIGINT, field STRING, term STRING, tf BIGINT, dl BIGINT"
DOC_STATS_SCHEMA = "doc_id BIGINT, field STRING, dl BIGINT, n_terms BIGINT"
TERM_STATS_SCHEMA = "field STRING, term STRING, df BIGINT, cf BIGINT"
TERM_BOUNDS_SCHEMA = f"{TERM_STATS_SCHEMA}, max_share DOUBLE"
FIELD_STATS_SCHEMA = (
    "field STRING, doc_count BIGINT, max_doc BIGINT, sum_doc_freq BIGINT, sum_total_term_freq BIGINT"
)
FIELD_SUMS = ["doc_count", "max_doc", "sum_doc_freq", "sum_total_term_freq"]
VECTOR_COLUMNS = ["doc_id", "field", "term", "tf", "dl"]
REPLACED_SCHEMA = "doc_id BIGINT, generation INT"
GENERATIONS_SCHEMA = "generation INT, location STRING"
LAYOUT_SCHEMA = "buckets INT, terms BIGINT, term_bytes BIGINT, replaced BIGINT, replaced_bytes BIGINT"

# Stored tables that are bucketed by document: their schemas and the order within a bucket.
BUCKETED = {
    "postings": (POSTINGS_SCHEMA, ("doc_id", "field", "term")),
    "doc_stats": (DOC_STATS_SCHEMA, ("doc_id", "field")),
}


@dataclass(frozen=True)
class TextIndex:
    """Handles on the stored tables, with the measured sizes of the term table and of the list of replaced documents."""

    spark: SparkSession
    path: str
    buckets: int
    term_stats_size: tuple[int, int]
    generations: tuple[tuple[int, str], ...]
    replaced_size: tuple[int, int]

    def _table_name(self, part: str) -> str:
        """Of the newest generation."""
        return _table_name(self.generations[-1][1], part)

    def _live(self, frames: list[DataFrame]) -> DataFrame:
        """Rows of all generations, without those of documents that a later generation has."""
        last, out = self.generations[-1][0], []
        for (generation, _), rows in zip(self.generations, frames):
            if generation < last:
                later = self.replaced().where(F.col("generation") > generation).select("doc_id")
                later = F.broadcast(later) if is_small(later, self.replaced_size) else later
                rows = rows.join(later, "doc_id", "left_anti")
            out.append(rows)
        return reduce(DataFrame.unionByName, out)

    def _bucketed(self, part: str) -> DataFrame:
        return self._live([self.spark.table(_table_name(location, part)) for _, location in self.generations])

    def postings(self, field: str | None = None) -> DataFrame:
        """``(doc_id, field, term, tf, dl)``; bucketed by document, all generations alike."""
        return _of_field(self._bucketed("postings"), field)

    def doc_stats(self, field: str | None = None) -> DataFrame:
        """``(doc_id, field, dl, n_terms)``; bucketed by document."""
        return _of_field(self._bucketed("doc_stats"), field)

    def term_postings(self, classes: list[int], field: str | None = None) -> DataFrame:
        """The postings of some classes of terms (see ``term_class``), read from these classes' files alone."""
        schema = f"{POSTINGS_SCHEMA}, term_class INT"
        frames = [self.spark.read.schema(schema).parquet(f"{location}/term_postings") for _, location in self.generations]
        chosen = [f.where(F.col("term_class").isin(classes)).drop("term_class") for f in frames]
        return _of_field(self._live(chosen), field)

    def replaced(self) -> DataFrame:
        """``(doc_id, generation)``: documents that were replaced, and the newest generation that has them."""
        return self.spark.read.schema(REPLACED_SCHEMA).parquet(f"{self.path}/replaced")

    def term_bounds(self, field: str | None = None) -> DataFrame:
        """Term statistics with ``max_share``, which no posting's ``tf / dl`` exceeds."""
        return _of_field(self.spark.read.schema(TERM_BOUNDS_SCHEMA).parquet(f"{self.path}/term_stats"), field)

    def term_stats(self, field: str | None = None) -> DataFrame:
        """``(field, term, df, cf)``."""
        return _of_field(self.spark.read.schema(TERM_STATS_SCHEMA).parquet(f"{self.path}/term_stats"), field)

    def field_stats(self, field: str | None = None) -> DataFrame:
        """One row per field, so its size is that of the schema."""
        return _of_field(self.spark.read.schema(FIELD_STATS_SCHEMA).parquet(f"{self.path}/field_stats"), field)

    def term_class(self, term: str | Column = "term") -> Column:
        """The class of a term: as many classes as buckets."""
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")


def _of_field(df: DataFrame, field: str | None) -> DataFrame:
    return df if field is None else df.where(F.col("field") == field)


def _table_name(path: str, part: str) -> str:
    return f"textloom_{part}_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def _write_bucketed(df: DataFrame, path: str, part: str, buckets: int) -> DataFrame:
    name = _table_name(path, part)
    with shuffles_released(df.sparkSession):
        (
            df.write.mode("overwrite")
            .format("parquet")
            .option("path", f"{path}/{part}")
            .option("compression", COMPRESSION)
            .bucketBy(buckets, "doc_id")
            .sortBy(*BUCKETED[part][1])
            .saveAsTable(name)
        )
    return df.sparkSession.table(name)


def default_buckets(stacked: DataFrame) -> int:
    """As many buckets as the texts need, at least one per core.

    Counted from the texts themselves: splits of the input say little about them,
    as files are compressed and of any number.
    """
    found = stacked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(-(-found // BUCKET_BYTES), stacked.sparkSession.sparkContext.defaultParallelism), MAX_BUCKETS)


def build_index(stacked: DataFrame, path: str, buckets: int | None = None) -> TextIndex:
    """Tokenize the texts ``(doc_id, field, text)`` and store the term tables below ``path``.

    Statistics are kept apart by ``field``. ``stack_fields`` gives several text
    columns of a collection; ``stack_folders`` makes each first-level folder a
    collection of its own.
    """
    buckets = buckets or default_buckets(stacked)
    # In the order of the buckets already, so that sorting the many postings of a bucket finds nothing to move.
    placed = ops.by_document(stacked, buckets).sortWithinPartitions("doc_id", "field")
    return _store_whole(ops.term_vectors(placed), placed.select("doc_id", "field"), path, buckets)


def _store_whole(vectors: DataFrame, documents: DataFrame, path: str, buckets: int) -> TextIndex:
    """One generation, with statistics from what is stored of it."""
    spark = vectors.sparkSession
    by_term, doc_stats = _write_generation(vectors, documents, path, buckets)
    with shuffles_released(spark):
        _term_deltas(by_term).write.mode("overwrite").parquet(f"{path}/term_stats")
    ops.field_stats(doc_stats).write.mode("overwrite").parquet(f"{path}/field_stats")
    nothing = spark.createDataFrame([], REPLACED_SCHEMA)
    return _finish(spark, path, buckets, ((0, path),), nothing)


def _write_generation(vectors: DataFrame, documents: DataFrame, path: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Writes the postings of some documents, by document and by term; returns the latter and the documents' lengths."""
    postings = _write_bucketed(vectors.select(*VECTOR_COLUMNS), path, "postings", buckets)
    counted = postings.groupBy("doc_id", "field").agg(F.min("dl").alias("dl"), F.count("*").alias("n_terms"))
    doc_stats = documents.join(counted, ["doc_id", "field"], "left").select(
        "doc_id", "field", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("dl", "n_terms")]
    )
    doc_stats = _write_bucketed(doc_stats, path, "doc_stats", buckets)
    return _write_by_term(postings, path, buckets), doc_stats


def _write_by_term(postings: DataFrame, path: str, classes: int) -> DataFrame:
    """Postings in a folder per class of terms, where those of a term stand together; a hot term is dealt out to several tasks.

    Dealt by ranges of the order they are stored in, whose bounds Spark draws from
    the postings: hashes of few classes would meet in some tasks and miss others.
    The order is that of a number, as texts are slow to compare.
    """
    term_class = F.pmod(F.xxhash64("term"), F.lit(classes))
    place = F.shiftleft(term_class, 40) + F.shiftrightunsigned(F.xxhash64("term"), 24)
    order = [place, "field", "term", "doc_id"]
    dealt = postings.select(*VECTOR_COLUMNS).repartitionByRange(classes, *order).sortWithinPartitions(*order)
    classed = dealt.withColumn("term_class", term_class.cast("int"))
    with shuffles_released(postings.sparkSession):
        classed.write.mode("overwrite").option("compression", COMPRESSION).partitionBy("term_class").parquet(f"{path}/term_postings")
    return postings.sparkSession.read.schema(f"{POSTINGS_SCHEMA}, term_class INT").parquet(f"{path}/term_postings")


def _term_deltas(postings: DataFrame, sign: int = 1) -> DataFrame:
    """What these postings add to the statistics of their terms, or take away."""
    counted = postings.groupBy("field", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max(F.col("tf") / F.col("dl")).alias("max_share")
    )
    return counted.select("field", "term", *[(F.col(c) * sign).alias(c) for c in ("df", "cf")], "max_share")


def last_of_each(incoming: DataFrame, order: str | None) -> DataFrame:
    """One row per document and field: the last by the column ``order``; without ``order`` a repeated one is an error."""
    key = ["doc_id", "field"]
    if order:
        last = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(order).desc_nulls_last()))
        return incoming.withColumn("_place", last).where("_place = 1").select(*key, "text")
    repeated = F.raise_error(F.concat(F.lit("doc_id comes more than once: "), F.col("doc_id").cast("string")))
    rows = F.count("*").over(Window.partitionBy(*key))
    once = F.when(F.col("_rows") > 1, repeated.cast("boolean")).otherwise(True)
    return incoming.withColumn("_rows", rows).where(once).select(*key, "text")


def update_index(index: TextIndex, incoming: DataFrame, path: str, order: str | None = None) -> TextIndex:
    """A new index below ``path``: ``incoming (doc_id, field, text)`` replaces documents of the same id, others are added.

    A document is replaced with all its fields. Of several incoming rows of one
    document and field the last by the column ``order`` counts; without it they
    are an error.

    Only the incoming texts are tokenized and written. Statistics change by what
    the incoming postings add and what the replaced ones took part with; the
    latter are found bucket by bucket, without a shuffle of the old postings.
    ``max_share`` may stay too large where a posting went; it is a bound still.
    The files of ``index`` are read by the new index too and must stay.
    """
    if path.rstrip("/") == index.path.rstrip("/"):
        raise ValueError("the updated index needs a new path")
    spark, generation = index.spark, index.generations[-1][0] + 1
    placed = ops.by_document(last_of_each(incoming, order), index.buckets).sortWithinPartitions("doc_id", "field")
    by_term, doc_stats = _write_generation(ops.term_vectors(placed), placed.select("doc_id", "field"), path, index.buckets)

    came = doc_stats.select("doc_id").distinct()
    gone_documents = index.doc_stats().join(broadcast_if_small(came), "doc_id", "left_semi")
    gone = gone_documents.select("doc_id", F.lit(generation).alias("generation"))
    replaced = index.replaced().unionByName(gone).groupBy("doc_id").agg(F.max("generation").alias("generation"))
    replaced.write.mode("overwrite").parquet(f"{path}/replaced")
    now = spark.read.schema(REPLACED_SCHEMA).parquet(f"{path}/replaced").where(F.col("generation") == generation).select("doc_id")
    gone_postings = index.postings().join(broadcast_if_small(now), "doc_id", "left_semi")

    changed = index.term_bounds().unionByName(_term_deltas(by_term)).unionByName(_term_deltas(gone_postings, -1))
    merged = changed.groupBy("field", "term").agg(
        F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.max("max_share").alias("max_share")
    )
    with shuffles_released(spark):
        merged.where("df > 0").write.mode("overwrite").parquet(f"{path}/term_stats")

    less = ops.field_stats(gone_documents).select("field", *[(-F.col(c)).alias(c) for c in FIELD_SUMS])
    fields = index.field_stats().unionByName(ops.field_stats(doc_stats)).unionByName(less)
    fields = fields.groupBy("field").agg(*[F.sum(c).alias(c) for c in FIELD_SUMS]).where("max_doc > 0")
    fields.write.mode("overwrite").parquet(f"{path}/field_stats")
    return _finish(spark, path, index.buckets, (*index.generations, (generation, path)), None)


def compact_index(index: TextIndex, path: str) -> TextIndex:
    """The same index as one generation below ``path``: one sorted file per bucket, replaced rows gone, exact bounds."""
    if path.rstrip("/") == index.path.rstrip("/"):
        raise ValueError("the compacted index needs a new path")
    # An expression of the same value: Spark leaves a plain repartition out where the buckets are the same,
    # and then reads them in splits of any size, which gives a bucket several files.
    same = F.col("doc_id").bitwiseOR(F.lit(0))
    vectors = index.postings().repartition(index.buckets, same)
    documents = index.doc_stats().select("doc_id", "field").repartition(index.buckets, same)
    return _store_whole(vectors, documents, path, index.buckets)


def _finish(
    spark: SparkSession, path: str, buckets: int, generations: tuple[tuple[int, str], ...], replaced: DataFrame | None
) -> TextIndex:
    """Measure and write what an opened index has to know."""
    if replaced is not None:
        replaced.write.mode("overwrite").parquet(f"{path}/replaced")
    terms = measured_size(spark.read.schema(TERM_STATS_SCHEMA).parquet(f"{path}/term_stats"))
    gone = measured_size(spark.read.schema(REPLACED_SCHEMA).parquet(f"{path}/replaced"))
    spark.createDataFrame(list(generations), GENERATIONS_SCHEMA).write.mode("overwrite").json(f"{path}/generations")
    spark.createDataFrame([(buckets, *terms, *gone)], LAYOUT_SCHEMA).write.mode("overwrite").json(f"{path}/layout")
    return TextIndex(spark, path, buckets, terms, generations, gone)


def open_index(spark: SparkSession, path: str) -> TextIndex:
    """Open the tables that an index below ``path`` consists of, in any later session."""
    layout = spark.read.schema(LAYOUT_SCHEMA).json(f"{path}/layout").first()
    listed = spark.read.schema(GENERATIONS_SCHEMA).json(f"{path}/generations").orderBy("generation").collect()
    generations = tuple((r["generation"], r["location"]) for r in listed)
    for _, location in generations:
        for part, (schema, sort) in BUCKETED.items():
            name = _table_name(location, part)
            # An entry of an earlier build at this path may have another number of buckets; the files stay.
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            spark.sql(
                f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (doc_id) SORTED BY ({', '.join(sort)}) "
                f"INTO {layout['buckets']} BUCKETS LOCATION '{location}/{part}'"
            )
    sizes = (layout["terms"], layout["term_bytes"]), (layout["replaced"], layout["replaced_bytes"])
    return TextIndex(spark, path, layout["buckets"], sizes[0], generations, sizes[1])
