"""Stored objects: listing a folder, and reading objects whole as text or bytes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfspace.sinks.files import located

# Executors need Spark and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOUND = "path STRING, length BIGINT, folder BOOLEAN"
LISTED = 50_000
# What a task holds of contents before it hands them on.
HELD_BYTES, HELD_OBJECTS = 8 * 1024 * 1024, 2_000


def list_objects(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every object below a folder; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def read_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per object: ``path`` and its whole text as ``payload``.

    Spark passes zero-byte objects over; who expects an object has to look for its row.
    """
    return read_bytes(spark, paths).select("path", F.col("content").cast("string").alias("payload"))


def read_bytes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per object: ``path`` and its bytes as ``content``."""
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def qualified(spark: SparkSession, path: str) -> str | None:
    """A path for pyarrow's file systems, or None if they do not know it."""
    from pyarrow import fs

    files, location = located(spark, path)
    whole = files.makeQualified(location).toString()
    if whole.startswith("file:"):
        return whole.removeprefix("file:")
    try:
        fs.FileSystem.from_uri(whole)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    return whole


def _opened(path: str):
    """A path's file system, the path in it, and what stands before it in ``path``."""
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem(), path, "file:"
    target, inner = fs.FileSystem.from_uri(path)
    return target, inner, path[: path.index(inner)] if inner in path else ""


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _entries(path: str, recursive: bool) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    target, inner, before = _opened(path)
    inner = inner.rstrip("/")
    found = target.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=recursive))
    for at in range(0, len(found), LISTED):
        some = [f for f in found[at : at + LISTED] if not any(map(_hidden, f.path[len(inner) + 1 :].split("/")))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([before + f.path for f in some], pa.string()),
                pa.array([f.size for f in some], pa.int64()),
                pa.array([f.type == fs.FileType.Directory for f in some], pa.bool_()),
            ],
            ["path", "length", "folder"],
        )


def list_by_tasks(spark: SparkSession, root: str) -> DataFrame | None:
    """Path and length of the objects below a folder, listed by a task for each folder in it.

    The driver gets none of them. Names that begin with ``_`` or ``.`` are passed over, as by
    Spark; objects of zero bytes are not. None if pyarrow does not know the file system.
    """
    path = qualified(spark, root)
    if path is None:
        return None

    def below(recursive: bool):
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    yield from _entries(folder.removeprefix("file:"), recursive)

        return listed

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = spark.createDataFrame([(path,)], "path STRING").mapInArrow(below(False), FOUND)
    folders = top.where("folder").select("path").repartition(tasks, "path")
    deep = folders.mapInArrow(below(True), FOUND)
    return top.unionByName(deep).where("NOT folder").select("path", "length")


def read_texts_below(spark: SparkSession, root: str) -> DataFrame:
    """One row per object below a folder, as ``read_texts`` gives it, for objects of any number.

    Listed and read by the tasks, many objects each; ``read_texts`` lists them in the
    driver and plans each one. Objects of zero bytes are passed over here too.
    """
    found = list_by_tasks(spark, root)
    if found is None:
        return read_texts(spark, f"{root.rstrip('/')}/*")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, contents, held = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target, inner, _ = _opened(path.removeprefix("file:"))
                with target.open_input_stream(inner, compression=None) as source:
                    contents.append(source.read())
                paths.append(path)
                held += len(contents[-1])
                if held >= HELD_BYTES or len(paths) >= HELD_OBJECTS:
                    yield _contents(paths, contents)
                    paths, contents, held = [], [], 0
        yield _contents(paths, contents)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = found.where("length > 0").select("path").repartition(tasks, "path")
    return spread.mapInArrow(read, "path STRING, content BINARY").select(
        "path", F.col("content").cast("string").alias("payload")
    )


def _contents(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
