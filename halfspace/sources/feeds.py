"""Feeds: where a run gets its raw documents from.

A feed offers the catalog, the match lists of the wanted scopes, and the events of the
matches asked for. All three are rows of JSON text, one per array element; an empty
array is a row without text, so a list that became empty still replaces the old one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halfspace.functions import parse_json
from halfspace.sinks import remove
from halfspace.sources.json_documents import elements
from halfspace.sources.objects import list_objects, read_texts
from halfspace.sources.tables import read_table_or_empty
from halfspace.workspace import fresh_dir, setting

Scope = tuple[int, int]

LOOKUP_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
PATHS_PER_LOOKUP = 100
# Jobs beyond which a job takes more matches than asked for, and how many at most.
JOBS, MOST_PATHS = 32, 50_000
# What opening a small file counts for. By default a task takes some 30 files.
OPEN_COST, SMALL = "spark.sql.files.openCostInBytes", "512k"

KEYS = "match_id INT"
EVENTS_FILE = r"/(-?\d+)(?:\.(\d+))?\.json$"


@dataclass(frozen=True)
class Batch:
    """Matches landed together: their keys and number, and rows of match_id, pos and payload.

    In a ``complete`` batch each key has a row, that of an empty array included; otherwise
    a match without rows has no events.
    """

    keys: DataFrame
    events: DataFrame
    matches: int
    complete: bool


@dataclass(frozen=True)
class FileFeed:
    """Array files below a folder: ``competitions.json``,
    ``matches/{competition}/{season}.json`` and ``events/{match_id}.json``.

    With ``numbered``, no events file has more than so many elements: those that follow are
    in ``events/{match_id}.1.json`` and so on, and which files there are is looked up.
    """

    root: str
    # Matches read and appended per job, and so the paths the driver holds at a time. If that
    # gives very many jobs, each takes more, but no more than ``MOST_PATHS``.
    batch: int = 50_000
    numbered: int | None = None

    def catalog(self, spark: SparkSession) -> DataFrame:
        expected = spark.createDataFrame([(1,)], "file INT")
        found = read_texts(spark, f"{self.root}/competitions.json")
        # A zero-byte file gives no row; here it is one without text, which fails.
        return elements(expected.join(found.withColumn("file", F.lit(1)), "file", "left"))

    def match_lists(self, spark: SparkSession, scopes: Sequence[Scope]) -> DataFrame:
        paths = [f"{self.root}/matches/{c}/{s}.json" for c, s in scopes]
        scope_of = [
            F.regexp_extract("path", r"(\d+)/(\d+)\.json$", group).cast("int").alias(name)
            for group, name in ((1, "competition_id"), (2, "season_id"))
        ]
        documents = read_texts(spark, paths).select("payload", *scope_of)
        expected = spark.createDataFrame(list(scopes), "competition_id INT, season_id INT")
        listed = expected.join(documents, ["competition_id", "season_id"], "left")
        return elements(listed, "competition_id", "season_id")

    def events(self, spark: SparkSession, keys: DataFrame, count: int) -> Iterator[Batch]:
        """The events of ``count`` keyed matches, a batch of matches at a time.

        A match names its file, so nothing is listed and no other file is opened. The
        keys are written once, spread over the batches, and each batch is read back by
        itself: the driver holds the paths of one batch, whatever the number of matches.
        """
        plan = fresh_dir(spark, "landing")
        batches = max(1, math.ceil(count / self._matches_a_job(count)))
        # Keys are distinct, so the batches are of like size, and each becomes one file.
        spread = F.pmod(F.xxhash64("match_id"), F.lit(batches)).cast("int")
        numbered = keys.withColumn("batch", spread).repartition("batch")
        numbered.write.partitionBy("batch").parquet(plan)
        try:
            yield from self._batches(spark, plan, batches)
        finally:
            remove(spark, plan)

    def _matches_a_job(self, count: int) -> int:
        return max(self.batch, min(math.ceil(count / JOBS), MOST_PATHS))

    def _batches(self, spark: SparkSession, plan: str, batches: int) -> Iterator[Batch]:
        found = self._numbered_files(spark, plan) if self.numbered else None
        for number in range(batches):
            listed = read_table_or_empty(spark, f"{plan}/batch={number}", KEYS)
            ids = [row.match_id for row in listed.collect()]
            if not ids:
                continue
            if self.numbered:
                mine = read_table_or_empty(spark, f"{found}/batch={number}", "path STRING")
                paths = [row.path for row in mine.collect()]
            else:
                paths = [f"{self.root}/events/{match_id}.json" for match_id in ids]
            # Batches may still be landing when the plan's files are gone.
            keys = spark.createDataFrame([(match_id,) for match_id in ids], KEYS)
            yield Batch(keys, self._read(spark, paths), len(ids), complete=True)

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], f"{KEYS}, pos INT, payload STRING")
        # By default 10,000 tasks look the paths up, which takes longer than reading.
        lookups = str(math.ceil(len(paths) / PATHS_PER_LOOKUP))
        with setting(spark, LOOKUP_TASKS, lookups):
            documents = read_texts(spark, paths)
        named = [
            F.regexp_extract("path", EVENTS_FILE, 1).cast("int").alias("match_id"),
            F.coalesce(F.try_to_number(F.regexp_extract("path", EVENTS_FILE, 2), F.lit("999999999")), F.lit(0))
            .cast("int")
            .alias("number"),
        ]
        rows = elements(documents.select("payload", *named), "match_id", "number")
        pos = F.col("pos") + F.col("number") * F.lit(self.numbered or 0)
        return rows.select("match_id", pos.alias("pos"), "payload")

    def _numbered_files(self, spark: SparkSession, plan: str) -> str:
        """The events files that there are for the keys, by batch, from one listing."""
        found = list_objects(spark, f"{self.root}/events", "*.json").select(
            "path", F.regexp_extract("path", EVENTS_FILE, 1).alias("key")
        )
        keys = spark.read.parquet(plan).select("batch", F.col("match_id").cast("string").alias("key"))
        files = found.join(keys, "key").select("path", "batch").repartition("batch")
        path = f"{plan}/files"
        with setting(spark, OPEN_COST, SMALL):
            files.write.partitionBy("batch").parquet(path)
        return path


@dataclass(frozen=True)
class TableFeed:
    """Documents already held as rows, each in a struct column ``document``.

    ``matches`` also has ``competition_id``, ``season_id`` and ``pos``, ``documents``
    has ``match_id`` and ``pos``. Text is made of the documents asked for only.
    """

    competitions: DataFrame
    matches: DataFrame
    documents: DataFrame

    def catalog(self, spark: SparkSession) -> DataFrame:
        return self.competitions.select("pos", _payload())

    def match_lists(self, spark: SparkSession, scopes: Sequence[Scope]) -> DataFrame:
        wanted = spark.createDataFrame(list(scopes), "competition_id INT, season_id INT")
        lists = self.matches.join(F.broadcast(wanted), ["competition_id", "season_id"], "left_semi")
        entries = lists.select("competition_id", "season_id", "pos", _payload())
        # A row without a document for each scope, as an empty list file gives.
        return entries.unionByName(wanted, allowMissingColumns=True)

    def events(self, spark: SparkSession, keys: DataFrame, count: int) -> Iterator[Batch]:
        wanted = self.documents.join(keys, "match_id").select("match_id", "pos", _payload())
        yield Batch(keys, wanted, count, complete=False)


def _payload() -> Column:
    return F.to_json("document").alias("payload")


def listed_matches(match_lists: DataFrame) -> DataFrame:
    """Match lists with each entry's ``match_id``; an entry without one fails."""
    parsed = parse_json("payload", "match_id INT").getField("match_id")
    missing = F.raise_error(F.lit("a listed match has no match_id")).cast("int")
    return match_lists.withColumn(
        "match_id", F.when(F.col("payload").isNotNull(), F.coalesce(parsed, missing))
    )
