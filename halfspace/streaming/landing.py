"""Incremental landing as a file stream.

The stream's checkpoint remembers the files it has read, so each call lands the files
that are new since the last one and then ends. A file that is rewritten under its old
name is not read again, which is the same skip rule as landing by key. Files are known
by name whatever their time, so the driver keeps one entry for each file ever landed,
some hundred bytes; sources of many million files should be landed by key instead.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from halfspace.plans.medallion import LANDED_TABLE, RAW_ROW_GROUP, Lake
from halfspace.sinks import append_rows, remove
from halfspace.sinks.files import located
from halfspace.sources import read_table_or_empty
from halfspace.sources.feeds import LOOKUP_TASKS, OPEN_COST, PATHS_PER_LOOKUP, SMALL
from halfspace.sources.json_documents import elements
from halfspace.sources.objects import list_by_tasks
from halfspace.workspace import setting


# Without it, files a week older than the newest one seen would never be landed.
NO_AGE_LIMIT = "36500d"


# Micro-batches beyond which one takes more files than asked for, and how many at most.
BATCHES, MOST_FILES = 16, 20_000


class EmptyFileError(Exception):
    """Raised when files of zero bytes lie in a source; the others have landed."""


def _files(spark: SparkSession, array_files: bool, files_per_batch: int) -> DataStreamReader:
    return (
        spark.readStream.schema("value STRING")
        .format("text")
        .option("wholetext", array_files)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", NO_AGE_LIMIT)
    )


def empty_files(spark: SparkSession, source: str) -> list[str]:
    """Files of zero bytes below a folder, which Spark's file sources pass over."""
    listed = list_by_tasks(spark, source)
    if listed is not None:
        return sorted(row.path for row in listed.where("length = 0").collect())
    files, location = located(spark, source)
    found, left = [], files.listFiles(location, True)
    while left.hasNext():
        status = left.next()
        name = status.getPath().getName()
        if status.getLen() == 0 and not name.startswith(("_", ".")):
            found.append(status.getPath().toString())
    return sorted(found)


def _refuse_empty_files(spark: SparkSession, source: str) -> None:
    empty = empty_files(spark, source)
    if empty:
        raise EmptyFileError(f"{len(empty)} files of zero bytes: {empty[:5]}")


def _files_a_batch(spark: SparkSession, source: str, wanted: int) -> int:
    """Files for a micro-batch, so that very many files do not take as many micro-batches."""
    listed = list_by_tasks(spark, source)
    there = listed.count() if listed is not None else 0
    return max(wanted, min(math.ceil(there / BATCHES), MOST_FILES))


def land_new_files(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    array_files: bool = True,
    files_per_batch: int = 20_000,
) -> None:
    """Land the documents of new files below ``source``, then end.

    With ``array_files`` each file is a JSON array and its rows carry the file's name
    as ``name``; otherwise each line is a document. The table's own log takes in a
    batch as a whole or not at all, so a batch that is run again adds nothing twice. A
    blank array file fails the stream. Array files of zero bytes, which Spark's sources pass
    over, raise ``EmptyFileError`` when the others have landed.
    """
    lines = _files(spark, array_files, files_per_batch).load(source).select(
        F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1).alias("name"),
        F.col("value").alias("payload"),
    )
    query = (
        (elements(lines, "name") if array_files else lines)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(table)
    )
    query.awaitTermination()
    if array_files:
        _refuse_empty_files(spark, source)


def land_event_files(
    spark: SparkSession, lake: Lake, source: str, checkpoint: str, files_per_batch: int = 20_000
) -> None:
    """Land new files ``{match_id}.json`` below ``source`` as a lake's raw events, then end.

    They are rows like those that a run lands, in the same manifest, so a match that the
    stream has landed is checked and published by a run as soon as a list names it. Each
    micro-batch is a landing batch whose name follows from the checkpoint and the batch's
    number. A micro-batch that is run again finds itself in the manifest, or writes its
    folder anew, so nothing lands twice. A match that has landed already is left alone.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def land(files: DataFrame, number: int) -> None:
        batch = f"s{stream}-{number:012d}"
        folder = lake.path(f"raw/events/batch={batch}")
        manifest = read_table_or_empty(files.sparkSession, lake.path("raw/landed"), LANDED_TABLE)
        if not manifest.where(F.col("batch") == batch).isEmpty():
            return
        # What an attempt that broke off has left is in no manifest.
        remove(files.sparkSession, folder)
        named = files.withColumn("match_id", _match_id())
        # Without a pass for the keys alone, which would read the files twice.
        new = named.join(manifest.select("match_id").distinct(), "match_id", "left_anti")
        rows = elements(new.select("match_id", F.col("value").alias("payload")), "match_id")
        append_rows(rows, folder, row_group=RAW_ROW_GROUP)
        landed = read_table_or_empty(files.sparkSession, folder, "match_id INT").distinct()
        append_rows(landed.select("match_id", F.lit(batch).alias("batch")), lake.path("raw/landed"))

    some = _files_a_batch(spark, source, files_per_batch)
    files = _files(spark, True, some).load(source).select("value", F.col("_metadata.file_path").alias("path"))
    # The stream keeps the settings that it begins with.
    with setting(spark, LOOKUP_TASKS, str(math.ceil(some / PATHS_PER_LOOKUP))), setting(spark, OPEN_COST, SMALL):
        query = (
            files.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    _refuse_empty_files(spark, source)


def _match_id() -> Column:
    """The match that a file is named after; a file of another name fails."""
    text = F.regexp_extract("path", r"/(-?\d+)\.json$", 1)
    wrong = F.raise_error(F.concat(F.lit("not named after a match: "), "path")).cast("int")
    return F.when(text != "", text.cast("int")).otherwise(wrong)
