"""Whether a value is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, column: str) -> Column:
    """Whether the column has a value; NaN counts as having none."""
    value = F.col(column)
    if df.schema[column].dataType.typeName() in ("float", "double"):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()
