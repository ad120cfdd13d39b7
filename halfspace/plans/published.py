"""What a version of the trusted events holds: its matches, and the counts of its checks.

Each part keeps notes beside its rows: which matches it has, from which landing batch, and
for each scope and check the counts that a report needs. They are written with the part
and never change, so a version's notes are those of the folders that it names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from halfspace.operators import ObservedTally, judge, tally
from halfspace.operators.quality import MOST_OBSERVED, TALLY, Check
from halfspace.sinks import append_rows, remove
from halfspace.sinks.versions import Version, notes_folder, part_folder, read_version, write_part
from halfspace.workspace import setting

SCOPE = ["competition_id", "season_id"]

# A task sorts the rows of so much raw text, which is twentyfold in memory, whatever the table's size.
RAW_SPLIT = "8m"
# A folder is a partition, one scope, of a part.
Folders = Collection[tuple[str, str]]

PUBLISHED = "match_id INT, competition_id INT, season_id INT, batch STRING, part STRING"
COUNTS = f"competition_id INT, season_id INT, {TALLY}, part STRING"


@dataclass(frozen=True)
class Change:
    """Folders that the next version names, and folders that it names no longer."""

    added: Folders = ()
    dropped: Folders = ()


def folder(scope: tuple[int, int]) -> str:
    return "/".join(f"{name}={value}" for name, value in zip(SCOPE, scope, strict=True))


def scope_of(partition: str) -> tuple[int, ...]:
    return tuple(int(value) for _, value in (step.split("=") for step in partition.split("/")))


def folders_of(version: Version, scopes: Collection[tuple[int, int]]) -> set[tuple[str, str]]:
    wanted = {folder(scope) for scope in scopes}
    return {pair for pair in version.live if pair[0] in wanted}


def crowded(folders: Folders, most: int) -> set[tuple[str, str]]:
    """The folders of scopes that have more than ``most``."""
    counts = Counter(partition for partition, _ in folders)
    return {pair for pair in folders if counts[pair[0]] > most}


def _notes(spark: SparkSession, path: str, version: Version, folders: Folders, name: str, schema: str) -> DataFrame:
    """Notes of the named folders, one of a few parts, with the folder as columns."""
    parts = sorted({part for _, part in folders})
    if not parts:
        return spark.createDataFrame([], f"{schema}, partition STRING")
    paths = [f"{notes_folder(path, version, part)}/{name}" for part in parts]
    rows = spark.read.schema(schema).parquet(*paths)
    partition = F.format_string("competition_id=%d/season_id=%d", *SCOPE)
    pairs = spark.createDataFrame(sorted(folders), "partition STRING, part STRING")
    return rows.withColumn("partition", partition).join(pairs, ["partition", "part"], "left_semi")


def matches(spark: SparkSession, path: str, version: Version, folders: Folders) -> DataFrame:
    """match_id, scope, batch, part and partition of the matches in some folders."""
    return _notes(spark, path, version, folders, "matches", PUBLISHED)


def write(
    rows: DataFrame,
    known: DataFrame,
    checks: Sequence[Check],
    scopes: Sequence[tuple[int, int]],
    path: str,
    version: Version,
    dropped: Folders,
    part: str,
) -> Change:
    """Write a new part with its notes: ``rows``, the matches ``known``, and their counts.

    The counts are taken by the pass that writes the rows, unless scopes and checks are
    very many.
    """
    spark = rows.sparkSession
    wanted = sorted(set(scopes))
    observed = None
    if len(wanted) * (2 * len(checks) + 1) <= MOST_OBSERVED:
        observed = ObservedTally(rows, checks, SCOPE, wanted)
    with setting(spark, "spark.sql.files.maxPartitionBytes", RAW_SPLIT):
        added = write_part(observed.rows if observed else rows, path, version, part)
    notes = notes_folder(path, version, part)
    scopes_seen = Observation()
    listed = F.collect_set(F.struct(*SCOPE)).alias("listed")
    append_rows(known.withColumn("part", F.lit(part)).observe(scopes_seen, listed), f"{notes}/matches")
    seen = {tuple(scope) for scope in scopes_seen.get["listed"]}
    # Matches without events have no rows; an empty file makes the folder that names them.
    for partition in sorted({folder(scope) for scope in seen} - {partition for partition, _ in added}):
        append_rows(rows.drop(*SCOPE).limit(0), f"{part_folder(path, version, part)}/{partition}")
    change = Change({(folder(scope), part) for scope in seen}, dropped)
    if observed:
        entries = [(*entry, part) for entry in observed.entries() if entry[:2] in seen]
        append_rows(spark.createDataFrame(entries, COUNTS), f"{notes}/checks")
    else:
        _count(spark, path, version.only(()).plus(change.added), checks)
    return change


def _count(spark: SparkSession, path: str, version: Version, checks: Sequence[Check]) -> None:
    """Add the counts of folders of one part to its notes; folders without rows count zero."""
    part = version.live[0][1]
    counted = tally(read_version(spark, path, version), checks, SCOPE)
    every = spark.createDataFrame([(repr(c),) for c in checks], "check STRING").crossJoin(
        spark.createDataFrame([scope_of(partition) for partition, _ in version.live], "competition_id INT, season_id INT")
    )
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("rows", "bad", "judged")]
    filled = every.join(counted, [*SCOPE, "check"], "left")
    append_rows(
        filled.select(*SCOPE, "check", *counts, F.lit(part).alias("part")),
        f"{notes_folder(path, version, part)}/checks",
    )


def report(
    spark: SparkSession, path: str, version: Version, folders: Folders, checks: Sequence[Check]
) -> DataFrame:
    """The report on some folders by scope, from their notes.

    Parts that were published under other checks are counted once for the new ones, and
    keep those counts.
    """
    wanted = [repr(c) for c in checks]
    counts = _notes(spark, path, version, folders, "checks", COUNTS).where(F.col("check").isin(wanted))
    added = counts.groupBy(*SCOPE, "check").agg(
        *[F.sum(name).alias(name) for name in ("rows", "bad", "judged")], F.count("*").alias("pieces")
    )
    found = added.collect()
    pieces = Counter((partition, c) for partition, _ in folders for c in wanted)
    if {(folder((r.competition_id, r.season_id)), r.check): r.pieces for r in found} != pieces:
        have = {(r.partition, r.part, r.check) for r in counts.select("partition", "part", "check").collect()}
        for part in sorted({part for _, part in folders}):
            mine = version.only({pair for pair in folders if pair[1] == part})
            lacking = [
                c for c in checks if any((*pair, repr(c)) not in have for pair in mine.live)
            ]
            if lacking:
                _count(spark, path, mine, lacking)
        return judge(_notes(spark, path, version, folders, "checks", COUNTS), checks, SCOPE)
    rows = [(r.competition_id, r.season_id, r.check, r.rows, r.bad, r.judged) for r in found]
    return judge(spark.createDataFrame(rows, f"competition_id INT, season_id INT, {TALLY}"), checks, SCOPE)


def discard(spark: SparkSession, path: str, version: Version, parts: Collection[str]) -> None:
    """Remove parts that no version will name."""
    for part in set(parts) - version.parts():
        remove(spark, part_folder(path, version, part))
        remove(spark, notes_folder(path, version, part))
