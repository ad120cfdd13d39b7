"""The medallion run: land raw documents, check them, publish trusted tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Collection, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from halfspace.formats import (
    DEFAULT_COMPETITION_ID,
    DEFAULT_SEASON_ID,
    PITCH_X,
    PITCH_Y,
    RANGE_TOLERANCE,
)
from halfspace.operators import (
    AtLeastRows,
    InRange,
    NotNull,
    QualityGateError,
    check,
    check_suite,
    gate,
    key_check,
    landing_counts,
    unlanded_keys,
)
from halfspace.operators.key_checks import KeyCheck
from halfspace.operators.quality import Check
from halfspace.plans import published
from halfspace.plans.trusted import trusted_events, trusted_matches
from halfspace.sinks import append_rows, remove, replace_partitions, replace_table
from halfspace.sinks.versions import (
    Version,
    commit,
    current_version,
    first_version,
    new_part,
    read_version,
)
from halfspace.sources import FileFeed, TableFeed, read_table, read_table_or_empty
from halfspace.sources.feeds import OPEN_COST, SMALL, Batch, Scope, listed_matches
from halfspace.workspace import setting

SCOPE = ["competition_id", "season_id"]
GROUPS = ("ingestion", "validation", "transformation")

# JSON text shrinks about twentyfold in a table, and parsing it is the work of a run.
# Small row groups let a scan hand that work to more tasks than whole 128 MB blocks.
RAW_ROW_GROUP = 4 * 1024 * 1024

RAW_EVENTS_TABLE = "match_id INT, pos INT, payload STRING, batch STRING"
LANDED_TABLE = "match_id INT, batch STRING"
MATCHES_TABLE = "match_id INT, competition_id INT, season_id INT, batch STRING"
FOLDERS = "ARRAY<STRUCT<partition: STRING, part: STRING>>"
PASSED_TABLE = (
    f"state STRING, over INT, added {FOLDERS}, dropped {FOLDERS}, metrics MAP<STRING, STRING>, "
    "finished TIMESTAMP"
)
BEGUN_TABLE = "part STRING"
RUNS_TABLE = "run_id STRING, stage STRING, finished TIMESTAMP, metrics MAP<STRING, STRING>"

EVENT_CHECKS: tuple[Check, ...] = (
    AtLeastRows(1),
    NotNull("event_id"),
    NotNull("period"),
    InRange("loc_x", *PITCH_X, mostly=RANGE_TOLERANCE),
    InRange("loc_y", *PITCH_Y, mostly=RANGE_TOLERANCE),
)

MATCH_CHECKS: tuple[Check, ...] = (NotNull("match_id"),)

# Bad values that the report of a failed check shows.
SHOWN_VALUES = 20

# Parts of a season beyond which its rows are written together again.
MOST_PARTS = 32

Metrics = dict[str, str]
T = TypeVar("T")
R = TypeVar("R")


@dataclass(frozen=True)
class Lake:
    """Where the tables are, and what a run covers.

    ``sample_matches`` limits the checks to the first matches of each list; without
    it, every event of the scopes is checked. ``match_checks`` are made of the match lists
    before they are published.
    """

    root: str
    scopes: tuple[Scope, ...] = ((DEFAULT_COMPETITION_ID, DEFAULT_SEASON_ID),)
    sample_matches: int | None = None
    checks: tuple[Check, ...] = EVENT_CHECKS
    match_checks: tuple[Check | KeyCheck, ...] = MATCH_CHECKS
    # Checks of the events' keys; ``Referenced`` may name the table ``matches``.
    key_checks: tuple[KeyCheck, ...] = ()
    # Landing batches that run at a time.
    jobs: int = 4

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def in_scope(self, df: DataFrame) -> DataFrame:
        """Rows of the scopes; on a partitioned table, only their folders are read."""
        wanted = F.lit(False)
        for competition, season in self.scopes:
            wanted = wanted | (
                (F.col("competition_id") == competition) & (F.col("season_id") == season)
            )
        return df.where(wanted)


def trusted_views(spark: SparkSession, lake: Lake) -> None:
    """Offer the trusted tables to SQL as the views ``events`` and ``matches``."""
    for name in ("events", "matches"):
        read_table(spark, lake.path(f"trusted/{name}")).createOrReplaceTempView(name)


def _documents(raw: DataFrame) -> DataFrame:
    """The rows of a raw table that hold a document; those of empty arrays hold none."""
    return raw.where("payload IS NOT NULL")


def _listed(spark: SparkSession, lake: Lake) -> DataFrame:
    """Entries of the scopes' match lists."""
    return lake.in_scope(_documents(read_table(spark, lake.path("raw/matches"))))


def _landed(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per landed match, with the batch that holds its events.

    The manifest alone says what has landed. Rows of a batch that was not finished are
    in no manifest and never read; of a match that two runs landed, one batch counts.
    """
    manifest = read_table_or_empty(spark, lake.path("raw/landed"), LANDED_TABLE)
    return manifest.groupBy("match_id").agg(F.min("batch").alias("batch"))


def _landed_in_scope(spark: SparkSession, lake: Lake, only_sampled: bool = False) -> DataFrame:
    """match_id, batch and scope of landed matches, once for each scope that lists them."""
    listed = (_sampled if only_sampled else _listed)(spark, lake)
    return listed.select("match_id", *SCOPE).distinct().join(_landed(spark, lake), "match_id")


def landed_events(
    spark: SparkSession, lake: Lake, matches: DataFrame | None = None
) -> DataFrame:
    """Raw events of the scopes' landed matches; other batches' folders are not read.

    ``matches`` may give these matches as a written table. Spark then knows its size when
    it plans the join, and sends it to the events if it is small.
    """
    matches = _landed_in_scope(spark, lake) if matches is None else matches
    batches = [row.batch for row in matches.select("batch").distinct().collect()]
    raw = read_table_or_empty(spark, lake.path("raw/events"), RAW_EVENTS_TABLE)
    wanted = raw.where(F.col("batch").isin(batches))
    return _documents(wanted).join(matches, ["match_id", "batch"]).drop("batch")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows, and their number of documents, which the pass that writes them takes."""
    counts = Observation()
    documents = F.count("pos").alias("documents")
    # The first element of each file, and the row of each empty one, stand for the file.
    files = F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("files")
    return df.observe(counts, documents, files), counts


def land_catalog(spark: SparkSession, lake: Lake, feed: FileFeed | TableFeed) -> Metrics:
    """Land the catalog anew."""
    path = lake.path("raw/competitions")
    rows, counts = _counted(feed.catalog(spark))
    replace_table(rows, path)
    return {"competition_count": str(counts.get["documents"]), "path": path}


def land_matches(spark: SparkSession, lake: Lake, feed: FileFeed | TableFeed) -> Metrics:
    """Land the scopes' match lists anew, leaving other scopes alone."""
    path = lake.path("raw/matches")
    rows, counts = _counted(listed_matches(feed.match_lists(spark, lake.scopes)))
    replace_partitions(rows, path, SCOPE)
    return {"match_count": str(counts.get["documents"]), "scopes": str(lake.scopes), "path": path}


class IncompleteBatchError(Exception):
    """Raised when files of a landing batch gave no rows; nothing of it has landed."""


def _land_batch(spark: SparkSession, lake: Lake, landing: Batch) -> int:
    """Write a batch of events and then its manifest; returns its number of matches.

    The pass that writes the events counts their files, so they are not read again.
    """
    batch = f"b{uuid.uuid4().hex}"
    folder = lake.path(f"raw/events/batch={batch}")
    rows, counts = _counted(landing.events)
    append_rows(rows, folder, row_group=RAW_ROW_GROUP)
    if landing.complete and counts.get["files"] != landing.matches:
        written = read_table_or_empty(spark, folder, "match_id INT").distinct()
        gone = landing.keys.join(written, "match_id", "left_anti").orderBy("match_id").limit(5)
        missing, names = landing.matches - counts.get["files"], [r.match_id for r in gone.collect()]
        raise IncompleteBatchError(f"{missing} matches without rows: {names}")
    append_rows(landing.keys.select("match_id", F.lit(batch).alias("batch")), lake.path("raw/landed"))
    return landing.matches


def side_by_side(work: Callable[[T], R], items: Iterator[T], jobs: int) -> Iterator[R]:
    """Results of a few jobs that run at a time; the next item is taken when one has ended.

    When one fails, no further one is begun, and those that run are waited for.
    """
    with ThreadPoolExecutor(jobs) as pool:
        running: set[Future] = set()
        for item in items:
            running.add(pool.submit(work, item))
            if len(running) == jobs:
                ended, running = wait(running, return_when=FIRST_COMPLETED)
                for one in ended:
                    yield one.result()
        for one in running:
            yield one.result()


def land_events(spark: SparkSession, lake: Lake, feed: FileFeed | TableFeed) -> Metrics:
    """Land the events of listed matches that have not landed yet.

    What is new is decided by the manifest, one row per match; landed events are not read.
    """
    listed, landed = _listed(spark, lake), _landed(spark, lake)
    counts = landing_counts(listed, landed, "match_id").first()
    ingested = 0
    if counts.ingested:
        new = unlanded_keys(listed, landed, "match_id")
        batches = feed.events(spark, new, counts.ingested)
        with setting(spark, OPEN_COST, SMALL):
            ingested = sum(side_by_side(lambda batch: _land_batch(spark, lake, batch), batches, lake.jobs))
    return {
        "ingested": str(ingested),
        "skipped_existing": str(counts.total - ingested),
        "total_matches": str(counts.total),
    }


def _sampled(spark: SparkSession, lake: Lake) -> DataFrame:
    """Entries of the match lists whose events are checked."""
    listed = _listed(spark, lake)
    if lake.sample_matches is None:
        return listed
    return listed.where(F.col("pos") < lake.sample_matches)


EVENTS = "trusted/events"
# Parts are written here before a version of the trusted table names them.
EVENTS_DATA = "../../parts/events"


def _trusted_version(spark: SparkSession, lake: Lake) -> Version:
    """The published version of the events, or what a table of them begins with."""
    now = current_version(spark, lake.path(EVENTS))
    if now:
        return now
    nothing = spark.createDataFrame([], f"{RAW_EVENTS_TABLE}, competition_id INT, season_id INT")
    return first_version(trusted_events(nothing, keep=[*SCOPE, "match_id"]), SCOPE, EVENTS_DATA)


def _state(spark: SparkSession, lake: Lake) -> str:
    """What would be published, and how it is checked, as a short text."""
    landed = _landed_in_scope(spark, lake)
    row = F.xxhash64(*landed.columns).cast("decimal(38,0)")
    count, digest = landed.agg(F.count("*"), F.sum(row)).first()
    checked = f"{lake.sample_matches} {lake.checks} {lake.key_checks}"
    return f"{count} {digest} {sorted(lake.scopes)} {checked}"


def _staging(lake: Lake, name: str) -> str:
    """A path in the scopes' own staging folder."""
    return lake.path(f"staging/{_scopes_key(lake)}/{name}")


def _scopes_key(lake: Lake) -> str:
    return hashlib.sha256(repr(sorted(lake.scopes)).encode()).hexdigest()[:16]


def _published_as(now: Version, lake: Lake, state: str) -> Metrics | None:
    """The metrics of the validation, if the version has just this state of the scopes."""
    known = json.loads(now.properties.get(_scopes_key(lake), "{}"))
    return known["metrics"] if known.get("state") == state else None


def _with_state(now: Version, lake: Lake, state: str, metrics: Metrics) -> Version:
    """The version with its state of these scopes, and without those of overlapping ones."""
    mine = [list(scope) for scope in sorted(set(lake.scopes))]
    others = {
        key: text
        for key, text in now.properties.items()
        if not any(scope in mine for scope in json.loads(text)["scopes"])
    }
    known = json.dumps({"scopes": mine, "state": state, "metrics": metrics})
    return replace(now, properties={**others, _scopes_key(lake): known})


def _passed(spark: SparkSession, lake: Lake, state: str) -> Row | None:
    """The last passed validation of a state over the published version."""
    passed = read_table_or_empty(spark, _staging(lake, "passed"), PASSED_TABLE)
    over = _trusted_version(spark, lake).number
    wanted = (F.col("state") == state) & (F.col("over") == over)
    return passed.where(wanted).orderBy(F.desc("finished")).first()


def checked_batch(spark: SparkSession, lake: Lake, staged: DataFrame) -> DataFrame:
    """The flattened events that the checks see: all that will be published, or a sample.

    A sample's matches are few by definition; the scan gets their ids.
    """
    if lake.sample_matches is None:
        return staged
    sampled = _landed_in_scope(spark, lake, only_sampled=True)
    wanted = F.lit(False)
    for competition, season in lake.scopes:
        mine = sampled.where(
            (F.col("competition_id") == competition) & (F.col("season_id") == season)
        )
        ids = sorted(row.match_id for row in mine.select("match_id").collect())
        wanted = wanted | (
            (F.col("competition_id") == competition)
            & (F.col("season_id") == season)
            & F.col("match_id").isin(ids)
        )
    return staged.where(wanted)


def _stage(spark: SparkSession, lake: Lake, now: Version) -> published.Change:
    """Write a part with the rows of what has landed since the published version.

    Matches that were published from the same batch are left as they are. Folders with a
    match that is listed no more are replaced by their other rows, which are typed
    already. So are those of a season with many parts.
    """
    path, wanted = lake.path(EVENTS), _staging(lake, "matches")
    append_rows(_landed_in_scope(spark, lake), wanted)
    new = listed = read_table_or_empty(spark, wanted, MATCHES_TABLE)
    live = published.folders_of(now, lake.scopes)
    keys, dropped = ["match_id", *SCOPE, "batch"], set()
    if live:
        there = published.matches(spark, path, now, live)
        gone = there.join(listed, keys, "left_anti").select("partition", "part").distinct()
        dropped = {tuple(row) for row in gone.collect()} | published.crowded(live, MOST_PARTS)
        fresh = _staging(lake, "fresh")
        append_rows(listed.join(there, keys, "left_anti").select(*keys), fresh)
        new = read_table_or_empty(spark, fresh, MATCHES_TABLE)
    if not dropped and new.isEmpty():
        return published.Change()
    rows = trusted_events(landed_events(spark, lake, new), keep=[*SCOPE, "match_id"])
    known = new
    if dropped:
        kept = published.matches(spark, path, now, dropped).select(*keys).join(listed, keys, "left_semi")
        known = new.unionByName(kept)
        old = read_version(spark, path, now.only(dropped))
        rows = rows.unionByName(old.join(kept.select("match_id", *SCOPE), ["match_id", *SCOPE], "left_semi"))
    # Sorted by type inside each task, so the filters of the queries skip other types.
    rows = rows.sortWithinPartitions(*SCOPE, "event_type")
    # Noted first, so that the part of a run that dies is removed by the next one.
    part = new_part()
    append_rows(spark.createDataFrame([(part,)], BEGUN_TABLE), _staging(lake, "begun"))
    return published.write(rows, known, lake.checks, lake.scopes, path, now, dropped, part)


def validate_events(spark: SparkSession, lake: Lake) -> Metrics:
    """Flatten what has landed since the last publishing to a part of its own, and check it.

    Raises ``QualityGateError`` on a failure. Only rows that passed can be published, and
    they are the rows that were checked. A season is judged as a whole: counts of the new
    part, taken while it is written, are added to those of the published parts. What has
    passed and is not yet published is not flattened again.
    """
    state = _state(spark, lake)
    before = _passed(spark, lake, state)
    if before:
        return dict(before.metrics)
    path, now = lake.path(EVENTS), _trusted_version(spark, lake)
    _discard_begun(spark, lake, now)
    metrics = _published_as(now, lake, state)
    staged = published.Change()
    if metrics is None:
        staged = _stage(spark, lake, now)
        after = now.without_folders(staged.dropped).plus(staged.added)
        try:
            metrics = _gate(spark, lake, after)
        except BaseException:
            _discard_begun(spark, lake, now)
            raise
    finished = datetime.now(timezone.utc)
    passed = (state, now.number, sorted(staged.added), sorted(staged.dropped), metrics, finished)
    append_rows(spark.createDataFrame([passed], PASSED_TABLE), _staging(lake, "passed"))
    return metrics


def _with_values(live: DataFrame, lake: Lake, report: list[dict]) -> list[dict]:
    """A failed report, with the commonest bad values of the checks that failed."""
    failed = {entry["check"] for entry in report if not entry["success"]}
    checks = [c for c in lake.checks if c.name in failed]
    if not checks:
        return report
    found = {
        (*(row[column] for column in SCOPE), row["check"]): [tuple(value) for value in row["commonest"]]
        for row in check(live, checks, SCOPE, commonest=SHOWN_VALUES).collect()
    }
    keyed = [((*(entry.get(column) for column in SCOPE), entry["check"]), entry) for entry in report]
    return [{**entry, "commonest": found[key]} if key in found else entry for key, entry in keyed]


def _discard_begun(spark: SparkSession, lake: Lake, now: Version) -> None:
    """Remove the staging folder, and parts written for it that were not published."""
    begun = read_table_or_empty(spark, _staging(lake, "begun"), BEGUN_TABLE)
    published.discard(spark, lake.path(EVENTS), now, [row.part for row in begun.collect()])
    remove(spark, _staging(lake, ""))


def _gate(spark: SparkSession, lake: Lake, after: Version) -> Metrics:
    """Judge the scopes' rows of a version that may be published."""
    path = lake.path(EVENTS)
    if lake.sample_matches is None:
        live = published.folders_of(after, lake.scopes)
        report = published.report(spark, path, after, live, lake.checks)
    else:
        rows = lake.in_scope(read_version(spark, path, after))
        report = check(checked_batch(spark, lake, rows), lake.checks, by=SCOPE)
    live = lake.in_scope(read_version(spark, path, after))
    tables = {"matches": _listed(spark, lake)} if lake.key_checks else {}
    for c in lake.key_checks:
        report = report.unionByName(key_check(live, c, SCOPE, tables))
    try:
        entries = gate(report, by=SCOPE, expected=lake.scopes)
    except QualityGateError as error:
        raise QualityGateError(_with_values(live, lake, error.report)) from None
    rows = {tuple(entry[column] for column in SCOPE): entry["rows"] for entry in entries}
    return {
        "rows_validated": str(sum(rows.values())),
        "matches_sampled": str(_sampled(spark, lake).count()),
    }


class NotValidatedError(Exception):
    """Raised when what would be published has not passed the checks."""


def publish_events(spark: SparkSession, lake: Lake) -> Metrics:
    """Make the part that passed the checks, and no longer what it replaces, the table.

    Refused unless a validation passed and nothing has landed or been published since.
    No file is moved: the next version of the table names other folders. If nothing has
    changed, there is no new version.
    """
    state = _state(spark, lake)
    passed = _passed(spark, lake, state)
    if not passed:
        raise NotValidatedError("run the validation of these scopes first")
    path, now = lake.path(EVENTS), _trusted_version(spark, lake)
    added, dropped = ({tuple(f) for f in folders} for folders in (passed.added, passed.dropped))
    if _published_as(now, lake, state) is None:
        after = now.without_folders(dropped).plus(added)
        commit(spark, path, _with_state(after, lake, state, dict(passed.metrics)))
    remove(spark, _staging(lake, ""))
    return {"trusted_path": path, "format": "Parquet/ZSTD"}


def publish_matches(spark: SparkSession, lake: Lake) -> Metrics:
    """Check and flatten the scopes' match lists into the trusted table.

    Raises ``QualityGateError`` if a list fails its checks. An empty list empties its
    season, in the same version that replaces the others.
    """
    path = lake.path("trusted/matches")
    matches = trusted_matches(_listed(spark, lake), keep=SCOPE)
    entries = gate(check_suite(matches, lake.match_checks, SCOPE), by=SCOPE)
    filled = {tuple(entry[column] for column in SCOPE) for entry in entries}
    emptied = [published.folder(scope) for scope in set(lake.scopes) - filled]
    replace_partitions(matches, path, SCOPE, emptied)
    return {"trusted_path": path, "format": "Parquet/ZSTD"}


def run(
    spark: SparkSession,
    lake: Lake,
    feed: FileFeed | TableFeed,
    groups: Collection[str] = GROUPS,
) -> dict[str, Metrics]:
    """Run the groups' stages in order and return each stage's metrics.

    The stages hand over by table, not by value. A failed stage stops the run, so
    nothing is published when the checks fail. The metrics of the finished stages are
    added to the ``runs`` table either way.
    """
    unknown = set(groups) - set(GROUPS)
    if unknown:
        raise ValueError(f"unknown groups: {sorted(unknown)}")
    stages = {
        "ingestion": {
            "competitions_raw": lambda: land_catalog(spark, lake, feed),
            "matches_raw": lambda: land_matches(spark, lake, feed),
            "events_raw": lambda: land_events(spark, lake, feed),
        },
        "validation": {"events_validated": lambda: validate_events(spark, lake)},
        "transformation": {
            "events_trusted": lambda: publish_events(spark, lake),
            "matches_trusted": lambda: publish_matches(spark, lake),
        },
    }
    run_id = uuid.uuid4().hex
    finished = []
    try:
        for group in GROUPS:
            if group not in groups:
                continue
            for stage, work in stages[group].items():
                metrics = work()
                finished.append((run_id, stage, datetime.now(timezone.utc), metrics))
    finally:
        if finished:
            append_rows(spark.createDataFrame(finished, RUNS_TABLE), lake.path("runs"))
    return {stage: metrics for _, stage, _, metrics in finished}
