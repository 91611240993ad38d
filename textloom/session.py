"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Scratch folder per application, used only where the setting is absent (tests).
_local_scratch: dict[str, str] = {}


def local_session(cores: int | str = "*", memory: str = "12g", app_name: str = "textloom") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    shuffle_partitions = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Without that setting a
    temporary folder is used in local mode only: on a cluster the executors
    would not see it, so that case is refused.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="textloom-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written within deletes the files of its shuffles at its end; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP_SETTING)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
