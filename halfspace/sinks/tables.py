"""Writing tables as zstd-compressed Parquet.

The writers create missing folders. Rows are staged by the tasks and moved into place
when the job has succeeded, so a lost executor costs a retry of its tasks and leaves no
half-written rows. Replaced tables have versions (``sinks.versions``): the old rows stay
readable until one rename puts the new ones in their place. Tables that are only ever
appended to are plain folders.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from halfspace.sinks.versions import change, current_version, first_version, new_part, write_part


def replace_table(df: DataFrame, path: str) -> None:
    """Write a whole table anew; readers see the old rows until all new ones are there."""
    start, part = first_version(df), new_part()
    pairs = write_part(df, path, start, part)
    change(df.sparkSession, path, start, lambda v: replace(v, schema=start.schema, by=(), live=tuple(pairs)))


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str], emptied: Collection[str] = ()
) -> None:
    """Replace the partitions that occur in ``df``, empty those given, and leave all others.

    ``emptied`` are partition folders such as ``a=1/b=2``. Readers see all of this at once.
    """
    start, part = first_version(df, by), new_part()
    pairs = write_part(df, path, start, part)
    replaced = {partition for partition, _ in pairs} | set(emptied)
    change(
        df.sparkSession,
        path,
        start,
        lambda v: replace(v.without(replaced).plus(pairs), schema=start.schema),
    )


def append_rows(
    df: DataFrame, path: str, by: Sequence[str] = (), row_group: int | None = None
) -> None:
    """Add rows to a table, in row groups of about ``row_group`` bytes if given."""
    now = current_version(df.sparkSession, path)
    if now:
        pairs = write_part(df, path, now, new_part())
        change(df.sparkSession, path, now, lambda v: v.plus(pairs))
        return
    writer = df.write.mode("append").option("compression", "zstd").partitionBy(*by)
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    writer.parquet(path)
