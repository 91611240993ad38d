"""A tree of text files as a collection, one document per regular file."""

from __future__ import annotations

import itertools
import os
import re
import uuid
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.session import materialize, scratch_path

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
#: Files of one part of a listing.
LISTED = 10_000
#: Folders that one task lists in a round: no more than the former while cores are idle, no more than the latter ever.
FEW_FOLDERS, FOLDERS = 200, 2_000
#: Files and bytes that one task reads.
READ_FILES, READ_BYTES = 2_000, 32 << 20
ENTRY_SCHEMA = "rel_path string, is_folder boolean, hidden boolean, millis long, length long"


def read_text_tree(
    spark: SparkSession,
    path: str,
    extensions: list[str] | None = None,
    min_depth: int | None = None,
    max_depth: int | None = None,
    every_file: bool = True,
) -> DataFrame:
    """``(path, rel_path, depth, top_folder, size_bytes, modified, content)``, lazily.

    ``extensions`` (``txt`` or ``.txt``) restricts the listing itself, so other
    files are never opened. Depth counts the folders between the root and the
    file. ``min_depth`` keeps files in or below folders that deep, ``max_depth``
    files that are not deeper.

    Spark's listing leaves out files of zero bytes and those that are hidden or in
    a hidden folder (``.`` or ``_`` first). With ``every_file`` these are documents
    as well: tasks list the tree at the call, level by level, and read what they
    found. Without it Spark lists and reads, and they are left out. Nothing is
    listed twice, but in a store that only Spark's reader opens (``_tasks_open``).
    """
    for depth in (min_depth, max_depth):
        if depth is not None and depth < 1:
            raise ValueError("a depth must be positive")
    base = _qualified(spark, path)
    if every_file and _tasks_open(base):
        listed_files = _read_by_tasks(spark, base, _endings(extensions), min_depth, max_depth)
    else:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        if extensions:
            reader = reader.option("pathGlobFilter", "*.{%s}" % ",".join(e.lstrip(".") for e in extensions))
        listed_files = reader.load(path)
        if every_file:
            skipped = _copied_by_driver(spark, path, base, _endings(extensions))
            listed_files = listed_files.where("length > 0").unionByName(skipped)
    # Given and listed paths may write the scheme in different ways, so both are compared without it.
    root = re.sub(SCHEME, "", path).rstrip("/") + "/"
    listed = F.regexp_replace("path", SCHEME, "")
    rel_path = F.substring(listed, F.instr(listed, F.lit(root)) + F.lit(len(root)), F.length(listed))
    parts = F.split("rel_path", "/")
    files = listed_files.select(
        "path",
        rel_path.alias("rel_path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
        "content",
    )
    files = files.withColumn("depth", F.size(parts) - 1).withColumn(
        "top_folder", F.when(F.size(parts) > 1, F.get(parts, F.lit(0)))
    )
    if min_depth is not None:
        files = files.where(F.col("depth") >= min_depth)
    if max_depth is not None:
        files = files.where(F.col("depth") <= max_depth)
    return files


#: What Spark's writers escape in the name of a folder, and the value of one without a value.
ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: What ends the name of the folder beside a tree where tasks keep files that are not whole yet.
UNFINISHED = ".unfinished"
#: Spark's tasks move what they wrote to its place; else the driver moves one file after the other.
MOVED_BY_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def write_tree(rows: DataFrame, path: str, folders: list[str], kind: str = "text") -> None:
    """The files that ``rows.write.partitionBy(*folders)`` writes as ``text`` or ``csv`` of the one other column, below a new ``path``.

    A file holds the rows of one split of ``rows`` and one value of each of ``folders``.
    Tasks write the files themselves: Spark's writer starts two processes for each on a
    mounted folder, which takes more time than all the rest. It writes where tasks cannot.
    """
    spark = rows.sparkSession
    base = _qualified(spark, path)
    if not _tasks_open(base):
        getattr(rows.write.options(**MOVED_BY_TASKS).partitionBy(*folders), kind)(path)
        return
    (value,) = (c for c in rows.columns if c not in folders)
    line = F.concat(F.to_csv(F.struct(value)) if kind == "csv" else F.col(value), F.lit("\n"))
    # A null is an empty line of a text and no line of a table.
    line = F.when(F.col(value).isNotNull(), line).otherwise(F.lit("" if kind == "csv" else "\n"))
    names = [F.col(c).cast("string").alias(f"folder_{i}") for i, c in enumerate(folders)]
    place = F.monotonically_increasing_id().alias("place")
    lines = rows.select(*names, F.spark_partition_id().alias("split"), place, line.cast("binary").alias("line"))
    keys = [f"folder_{i}" for i in range(len(folders))]
    cores = spark.sparkContext.defaultParallelism
    if lines.rdd.getNumPartitions() < cores:
        lines = lines.repartition(cores, "split", *keys)
    jvm = spark.sparkContext._jvm
    root, unfinished = (jvm.org.apache.hadoop.fs.Path(base.rstrip("/") + end) for end in ("", UNFINISHED))
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(root)
    written = lines.sortWithinPartitions(*keys, "split", "place").mapInArrow(_write_files(base, folders, kind), "files BIGINT")
    written.agg(F.sum("files")).collect()
    store.delete(unfinished, True)


def _write_files(base: str, folders: list[str], kind: str):
    """Writes a file of each run of rows of the same folders and split; it gets its name when it is whole, as attempts may end early."""
    ending = {"text": "txt"}.get(kind, kind)
    call = uuid.uuid4()

    def folder(*values: str | None) -> str:
        escaped = (ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", v) if v else NO_VALUE for v in values)
        return "/".join(f"{name}={value}" for name, value in zip(folders, escaped))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            *keys, lines = (batch.column(i) for i in (*range(len(folders) + 1), len(folders) + 2))
            yield from zip(zip(*(k.to_pylist() for k in keys)), lines)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(base)
        root, attempt, n = root.rstrip("/"), uuid.uuid4(), 0
        store.create_dir(f"{root}{UNFINISHED}")
        for (*values, split), run in itertools.groupby(rows(batches), key=lambda row: row[0]):
            own, unfinished = f"{root}/{folder(*values)}", f"{root}{UNFINISHED}/{attempt}"
            store.create_dir(own)
            with store.open_output_stream(unfinished) as stream:
                for _, line in run:
                    stream.write(line.as_buffer())
            store.move(unfinished, f"{own}/part-{split:05d}-{call}.c000.{ending}")
            n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    return written


def _is_skipped(name: str) -> bool:
    """Whether Spark's listing leaves out a file or folder of this name, as ``HadoopFSUtils.shouldFilterOutPathName`` does."""
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_common_metadata", "_metadata"))


def _endings(extensions: list[str] | None) -> tuple[str, ...]:
    """What a kept file's name ends with; every name ends with the empty text."""
    return tuple("." + e.lstrip(".") for e in extensions) if extensions else ("",)


def _store(base: str) -> tuple[pafs.FileSystem, str]:
    """The store below ``base`` as a task opens it, and the folder in it."""
    if base.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(SCHEME, "", base)
    return pafs.FileSystem.from_uri(quote(base, safe=":/@"))


def _tasks_open(base: str) -> bool:
    """Whether tasks can list a tree themselves: it lies in a mounted folder or in a store that Arrow knows."""
    try:
        _store(base)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _entries(base: str, folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """``(name, is_folder, millis, length)`` of what stands in one folder."""
    store, root = _store(base)
    path = f"{root.rstrip('/')}/{folder}"
    if isinstance(store, pafs.LocalFileSystem):
        with os.scandir(path) as found:
            for entry in found:
                if entry.is_dir():
                    yield entry.name, True, 0, 0
                elif entry.is_file():
                    status = entry.stat()
                    yield entry.name, False, status.st_mtime_ns // 1_000_000, status.st_size
        return
    for info in store.get_file_info(pafs.FileSelector(path.rstrip("/"))):
        if info.type == pafs.FileType.Directory:
            yield info.base_name, True, 0, 0
        elif info.type == pafs.FileType.File:
            yield info.base_name, False, (info.mtime_ns or 0) // 1_000_000, info.size


def _list_folders(base: str, endings: tuple[str, ...], skipped_only: bool):
    """Lists folders ``(rel_path, hidden)``: their folders and files, of the latter only those that Spark's listing leaves out, or all."""

    def rows(batch: pd.DataFrame) -> Iterator[tuple]:
        for folder, hidden in zip(batch["rel_path"], batch["hidden"]):
            for name, is_folder, millis, length in _entries(base, folder):
                below = bool(hidden) or _is_skipped(name)
                if is_folder or (below or length == 0 or not skipped_only) and name.endswith(endings):
                    yield (f"{folder}/{name}" if folder else name), is_folder, below, millis, length

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in ENTRY_SCHEMA.split(", ")]
        for batch in batches:
            held = []
            for row in rows(batch):
                held.append(row)
                if len(held) >= LISTED:
                    yield pd.DataFrame(held, columns=names)
                    held = []
            if held:
                yield pd.DataFrame(held, columns=names)

    return listed


def _listed_by_tasks(
    spark: SparkSession, base: str, endings: tuple[str, ...], max_depth: int | None, skipped_only: bool = True
) -> DataFrame:
    """``(rel_path, millis, length)`` of the files that Spark's listing leaves out, or of all.

    The folders of one level are a table in the shared folder, dealt out to tasks,
    which list them into the next level. The driver sees their number.
    """
    folders = spark.createDataFrame([("", False)], "rel_path string, hidden boolean")
    levels, n = [], 1
    while n and (max_depth is None or len(levels) <= max_depth):
        tasks = max(n // FOLDERS, min(n // FEW_FOLDERS, spark.sparkContext.defaultParallelism)) + 1
        dealt = folders.repartition(tasks, "rel_path")
        level = materialize(dealt.mapInPandas(_list_folders(base, endings, skipped_only), ENTRY_SCHEMA), "tree-level")
        levels.append(level.where("NOT is_folder").select("rel_path", "millis", "length"))
        folders = level.where("is_folder").select("rel_path", "hidden")
        n = folders.count()
    return reduce(DataFrame.unionByName, levels)


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme and a final ``/``, as Spark writes it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(conf).makeQualified(root).toString().rstrip("/") + "/"


def _read_by_tasks(
    spark: SparkSession, base: str, endings: tuple[str, ...], min_depth: int | None, max_depth: int | None
) -> DataFrame:
    """``(path, modificationTime, length, content)`` of the regular files below ``base``.

    A file's content is read by the task that needs it. Files are dealt out by
    their number and bytes; Spark's reader would make a task of every few small ones.
    """
    found = _listed_by_tasks(spark, base, endings, max_depth, skipped_only=False)
    if min_depth is not None:
        found = found.where(F.size(F.split("rel_path", "/")) > min_depth)
    n, length = found.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    found = found.repartition(max(n // READ_FILES, length // READ_BYTES, spark.sparkContext.defaultParallelism), "rel_path")

    def content_of(rel_path):
        store, folder = _store(base)
        with store.open_input_stream(f"{folder.rstrip('/')}/{rel_path}", compression=None) as stream:
            return stream.read()

    # A column, so that a plan that does not ask for it opens no file.
    content = F.when(F.col("length") > 0, F.udf(content_of, "binary")("rel_path")).otherwise(F.lit(b""))
    return found.select(
        F.concat(F.lit(base), "rel_path").alias("path"),
        F.timestamp_millis("millis").alias("modificationTime"),
        "length",
        content.alias("content"),
    )


def _copied_by_driver(spark: SparkSession, path: str, base: str, endings: tuple[str, ...]) -> DataFrame:
    """The same for stores that tasks cannot open themselves.

    The walk keeps no more than ``LISTED`` rows on the driver. Only Spark's reader
    reaches such a store from a task, and it refuses hidden names, so hidden files
    are copied, as streams, to names without them in the shared folder.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(conf)
    copies, listing = scratch_path(spark, "hidden-files"), scratch_path(spark, "skipped-files")
    scratch = jvm.org.apache.hadoop.fs.Path(copies)
    scratch_store = scratch.getFileSystem(conf)
    scratch_store.mkdirs(scratch)
    schema = "copy string, path string, millis long, length long"
    spark.createDataFrame([], schema).write.parquet(listing)
    rows: list[tuple] = []
    n_copies = 0
    walk = store.listFiles(root, True)
    while walk.hasNext():
        status = walk.next()
        own, length = status.getPath(), status.getLen()
        full = own.toString()
        hidden = any(_is_skipped(name) for name in full.removeprefix(base).split("/"))
        if not full.endswith(endings) or length > 0 and not hidden:
            continue
        copy = None
        if length > 0:
            # Folders of bounded size.
            copy = f"{n_copies // LISTED}/{n_copies}"
            n_copies += 1
            jvm.org.apache.hadoop.fs.FileUtil.copy(store, own, scratch_store, jvm.org.apache.hadoop.fs.Path(f"{copies}/{copy}"), False, conf)
        rows.append((copy, full, status.getModificationTime(), length))
        if len(rows) >= LISTED:
            spark.createDataFrame(rows, schema).write.mode("append").parquet(listing)
            rows = []
    if rows:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(listing)
    found = spark.read.schema(schema).parquet(listing).select(
        "copy", "path", F.timestamp_millis("millis").alias("modificationTime"), "length"
    )
    empty = found.where("length = 0").select("path", "modificationTime", "length", F.lit(b"").alias("content"))
    if not n_copies:
        return empty
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(copies)
    contents = contents.select(F.regexp_extract("path", "([0-9]+/[0-9]+)$", 1).alias("copy"), "content")
    return empty.unionByName(found.join(contents, "copy").select("path", "modificationTime", "length", "content"))


def file_documents(files: DataFrame, n_top: int | None = None, n_bottom: int | None = None) -> DataFrame:
    """One record per file: path, type, text, size, times, optionally first and last lines."""
    text = F.decode("content", "UTF-8")
    docs = files.select(
        "path",
        "rel_path",
        "top_folder",
        F.lit("regular file").alias("file_type"),
        "size_bytes",
        "modified",
        tx.iso_time(F.col("modified")).alias("modified_iso"),
        tx.to_millis_key(F.col("modified")).alias("modified_key"),
        text.alias("text"),
    )
    docs = docs.withColumn("line_count", tx.line_count(F.col("text")))
    if n_top is not None:
        docs = docs.withColumn("top_lines", tx.top_lines(F.col("text"), n_top))
    if n_bottom is not None:
        docs = docs.withColumn("bottom_lines", tx.bottom_lines(F.col("text"), n_bottom))
    return docs
