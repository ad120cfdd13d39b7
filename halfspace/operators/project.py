"""Flattening nested documents to typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from halfspace.functions import at_path, safe_number


def flatten(
    df: DataFrame,
    columns: Iterable[tuple[str, str, str]],
    keep: Iterable[str] = (),
) -> DataFrame:
    """Project ``(name, type, path)`` triples, after the columns to ``keep`` as they are.

    Array elements become NULL when they do not fit the type; any other value that
    does not fit fails the query.
    """
    projected = []
    for name, kind, path in columns:
        value = at_path(path)
        value = safe_number(value) if path.endswith("]") else value.cast(kind)
        projected.append(value.alias(name))
    return df.select(*keep, *projected)
