"""Tables whose content is what their newest version file says.

    {table}/_versions/000000000007.json    the live folders, and the columns
    {data}/_part=p3f.../competition_id=11/season_id=90/*.parquet

Rows are written to the folder of a new part, which no version names yet. Then a version
file is put in place with one rename, which makes the new rows appear and those they replace
disappear at once. A reader looks up the newest version once and reads its folders, so it
sees the table as it was before or after a change, never in between. Folders that no kept
version names are removed with the version that named them last.

A table's data lies in the table's own folder or, with ``data``, beside it. A version names
one folder for each partition and part, so a table should have thousands of partitions at
most.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from halfspace.sinks.files import located, remove

PART = "_part"
# Versions that stay readable for those who have looked them up.
KEEP_VERSIONS = 8
# Times a change is made to a newer version when another writer came first.
ATTEMPTS = 5


class ConcurrentWriteError(Exception):
    """Raised when another writer's version came first."""


@dataclass(frozen=True)
class Version:
    """``live`` are (partition, part) pairs; a partition is a path such as ``a=1/b=2``."""

    number: int
    schema: str
    by: tuple[str, ...] = ()
    live: tuple[tuple[str, str], ...] = ()
    data: str = "."
    properties: dict[str, str] = field(default_factory=dict)

    def parts(self) -> set[str]:
        return {part for _, part in self.live}

    def without(self, partitions: Collection[str]) -> Version:
        return replace(self, live=tuple(pair for pair in self.live if pair[0] not in partitions))

    def only(self, pairs: Collection[tuple[str, str]]) -> Version:
        return replace(self, live=tuple(pair for pair in self.live if pair in pairs))

    def without_folders(self, pairs: Collection[tuple[str, str]]) -> Version:
        return replace(self, live=tuple(pair for pair in self.live if pair not in pairs))

    def plus(self, pairs: Iterable[tuple[str, str]]) -> Version:
        return replace(self, live=tuple(sorted({*self.live, *pairs})))


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}/_versions"


def _file(path: str, number: int) -> str:
    return f"{_versions(path)}/{number:012d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, location = located(spark, _versions(path))
    if not files.exists(location):
        return []
    names = [status.getPath().getName() for status in files.listStatus(location)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Version:
    files, location = located(spark, _file(path, number))
    stream = files.open(location)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    saved = json.loads(text)
    return Version(
        number,
        saved["schema"],
        tuple(saved["by"]),
        tuple((partition, part) for partition, part in saved["live"]),
        saved["data"],
        saved["properties"],
    )


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest version of a table, or None if it has none."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def data_root(path: str, version: Version) -> str:
    scheme, colon, rest = path.rstrip("/").rpartition("://")
    return scheme + colon + posixpath.normpath(f"{rest}/{version.data}")


def part_folder(path: str, version: Version, part: str) -> str:
    return f"{data_root(path, version)}/{PART}={part}"


def new_part() -> str:
    return f"p{uuid.uuid4().hex}"


def read_version(spark: SparkSession, path: str, version: Version, schema: str | None = None) -> DataFrame:
    """The rows of a version: only its folders are listed and read."""
    known = T.StructType.fromJson(json.loads(version.schema)) if schema is None else T.StructType.fromDDL(schema)
    if not version.live:
        return spark.createDataFrame([], known)
    folders = [f"{part_folder(path, version, part)}/{partition}".rstrip("/") for partition, part in version.live]
    given = T.StructType([*known.fields, T.StructField(PART, T.StringType())])
    rows = spark.read.schema(given).option("basePath", data_root(path, version)).parquet(*folders)
    return rows.select(*known.fieldNames())


def write_part(df: DataFrame, path: str, version: Version, part: str) -> list[tuple[str, str]]:
    """Write rows to a new part's folder and return what it would add to a version."""
    spark, folder = df.sparkSession, part_folder(path, version, part)
    df.write.option("compression", "zstd").partitionBy(*version.by).parquet(folder)
    return [(partition, part) for partition in _partitions(spark, folder, len(version.by))]


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        deeper = []
        for partition in found:
            files, location = located(spark, f"{folder}/{partition}")
            names = [s.getPath().getName() for s in files.listStatus(location) if s.isDirectory()]
            deeper += [f"{partition}/{name}".lstrip("/") for name in names if not name.startswith("_")]
        found = deeper
    return sorted(found)


def commit(spark: SparkSession, path: str, version: Version, keep: int = KEEP_VERSIONS) -> Version:
    """Make ``version``, a change of the newest one, the next one.

    Raises ``ConcurrentWriteError`` if there is a next one already.
    """
    after = replace(version, number=version.number + 1)
    target = _file(path, after.number)
    files, location = located(spark, target)
    staged = located(spark, f"{_versions(path)}/.{uuid.uuid4().hex}")[1]
    text = {
        "schema": after.schema,
        "by": after.by,
        "live": after.live,
        "data": after.data,
        "properties": after.properties,
    }
    stream = files.create(staged, False)
    try:
        stream.write(bytearray(json.dumps(text).encode()))
    finally:
        stream.close()
    # One rename; where two writers race, a file system refuses the second one's target.
    if files.exists(location) or not files.rename(staged, location):
        files.delete(staged, False)
        raise ConcurrentWriteError(f"{path} has a version {after.number} already")
    forget_versions(spark, path, keep)
    return after


def forget_versions(spark: SparkSession, path: str, keep: int = KEEP_VERSIONS) -> None:
    """Remove all but the newest versions, and the folders that only those named."""
    numbers = _numbers(spark, path)
    if len(numbers) <= keep:
        return
    kept = [_load(spark, path, number) for number in numbers[-keep:]]
    named = {part for version in kept for part in version.parts()}
    for number in numbers[:-keep]:
        old = _load(spark, path, number)
        remove(spark, _file(path, number))
        for part in old.parts() - named:
            remove(spark, part_folder(path, old, part))
            remove(spark, notes_folder(path, old, part))


def notes_folder(path: str, version: Version, part: str) -> str:
    """Where a part's writer may keep what it knows of its rows."""
    return f"{data_root(path, version)}/_notes/{part}"


def change(
    spark: SparkSession, path: str, start: Version, make: Callable[[Version], Version]
) -> Version:
    """Apply a change to the newest version, again if another writer comes first.

    ``start`` is what a table without versions begins with.
    """
    for attempt in range(ATTEMPTS):
        try:
            return commit(spark, path, make(current_version(spark, path) or start))
        except ConcurrentWriteError:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError("unreachable")


def first_version(df: DataFrame, by: Sequence[str] = (), data: str = ".") -> Version:
    """What a new table of these rows begins with. Partition columns come last, as in files."""
    fields = [df.schema[name] for name in df.columns if name not in by] + [df.schema[name] for name in by]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    return Version(0, schema.json(), tuple(by), (), data)
