"""The training-data pipeline: from documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet and reads it back as the next stage's ``docs``. All but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.decontaminate import decontaminated
from textloom.llm.language_id import with_language
from textloom.llm.mixing import mixed
from textloom.llm.ngram_join import representatives
from textloom.llm.queries import language_model, table, tokenizer_file
from textloom.llm.token_output import read_ids, write_ids
from textloom.session import materialize, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return with_language(docs, language_model(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays."""
    return representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token ids in files, and where each document stands in them."""
    path = scratch_path(spark, "corpus-ids")
    write_ids(docs, path, tokenizer_file("byte_bpe_50k.json"))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: SQL can express neither the learned model nor the random choice of the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
