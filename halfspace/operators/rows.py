"""Row-level operators: top-k rows and dropping incomplete rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfspace.functions import present


def top_rows(
    df: DataFrame, by: str, k: int, columns: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """The k rows with the largest ``by``, NULLs left out, ties cut in ``ties`` order.

    Each task keeps k rows and the driver merges those, so no full sort runs.
    """
    order = [F.desc_nulls_last(by), *(F.asc_nulls_last(c) for c in ties)]
    return df.where(F.col(by).isNotNull()).orderBy(*order).limit(k).select(*columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have a value in every one of the columns.

    One condition per column, so that each reaches the scan by itself.
    """
    for column in columns:
        df = df.where(present(df, column))
    return df
