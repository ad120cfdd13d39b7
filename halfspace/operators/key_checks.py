"""Checks of keys: that none occurs twice, and that another table has them.

Rows are reduced to one count for each key inside the tasks before they meet, so a key that
holds a third of all rows travels as a few counts. Reports have the form of ``quality.check``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.operators.quality import Check, check


@dataclass(frozen=True)
class Unique:
    """No two rows have the same values in the columns. Rows without one are not judged."""

    columns: tuple[str, ...]
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return f"unique({', '.join(self.columns)})"


@dataclass(frozen=True)
class Referenced:
    """The column's values occur in a column of another table. NULLs are not judged."""

    column: str
    table: str
    key: str
    mostly: float = 1.0

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def name(self) -> str:
        return f"referenced({self.column}, {self.table}.{self.key})"


KeyCheck = Unique | Referenced


def _present(columns: Sequence[str]) -> Column:
    there = F.lit(True)
    for column in columns:
        there = there & F.col(column).isNotNull()
    return there


def key_check(
    df: DataFrame, c: KeyCheck, by: Sequence[str] = (), tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The report row of one check, for each group."""
    if set(c.columns) & set(by):
        raise ValueError(f"{c.name} is about a column that groups the rows")
    keys = [*by, *c.columns]
    # A key's rows are counted first; whether it is bad is then decided once for each key.
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("judged", _present(c.columns))
    if isinstance(c, Unique):
        counts = counts.withColumn("bad", F.col("judged") & (F.col("n") > 1))
    else:
        known = (tables or {})[c.table].select(F.col(c.key).alias("known")).where("known IS NOT NULL").distinct()
        counts = counts.join(known, F.col(c.column) == F.col("known"), "left")
        counts = counts.withColumn("bad", F.col("judged") & F.col("known").isNull())
    total = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), F.col("n"))), F.lit(0))
    added = counts.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), total("judged").alias("nonnull"), total("bad").alias("unexpected")
    )
    judged, bad = F.col("nonnull"), F.col("unexpected")
    kept = F.try_divide((judged - bad).cast("double"), judged.cast("double"))
    return added.select(
        *by,
        F.lit(c.name).alias("check"),
        F.lit(", ".join(c.columns)).alias("column"),
        "rows",
        "nonnull",
        "unexpected",
        F.try_divide(F.lit(100.0) * bad, judged.cast("double")).alias("unexpected_pct"),
        F.lit(float(c.mostly)).alias("mostly"),
        F.coalesce(kept >= F.lit(float(c.mostly)), F.lit(True)).alias("success"),
    )


def check_suite(
    df: DataFrame,
    checks: Sequence[Check | KeyCheck],
    by: Sequence[str] = (),
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One report row per check and group: all checks of rows from one aggregate, and one
    pass for each check of keys. ``tables`` are those that ``Referenced`` names."""
    of_rows = [c for c in checks if not isinstance(c, KeyCheck)]
    reports = [check(df, of_rows, by)] if of_rows else []
    reports += [key_check(df, c, by, tables) for c in checks if isinstance(c, KeyCheck)]
    whole = reports[0]
    for report in reports[1:]:
        whole = whole.unionByName(report)
    return whole
