"""Group-level operators.

Each one is a plain ``groupBy().agg()``: tasks combine their rows before the shuffle,
so one key that holds a third of the table sends one row per task, not a third of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.functions import exact_mean, exact_sum, round_half_away


def _largest_first(by: str, ties: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(by), *(F.asc_nulls_last(c) for c in ties)]


def _rounded_means(means: Mapping[str, tuple[str, int]], places: int) -> list[Column]:
    return [
        round_half_away(exact_mean(column, places), digits).alias(name)
        for name, (column, digits) in means.items()
    ]


def points_by(
    df: DataFrame,
    key: str,
    scored: str,
    conceded: str,
    names: tuple[str, str, str] = ("points", "scored", "conceded"),
    places: int | None = None,
) -> DataFrame:
    """Table of points per key: 3 for scoring more, 1 for a draw, otherwise 0.

    A row without scores counts as 0 points and stays in its group. ``places`` is for
    scores held as doubles: the decimal places they are summed with.
    """
    ours, theirs = F.col(scored), F.col(conceded)
    earned = F.when(ours > theirs, 3).when(ours == theirs, 1).otherwise(0)

    def total(column: str) -> Column:
        return F.sum(column) if places is None else exact_sum(column, places)

    points, for_, against = names
    return (
        df.groupBy(key)
        .agg(
            F.sum(earned).alias(points),
            total(scored).alias(for_),
            total(conceded).alias(against),
        )
        .orderBy(*_largest_first(points, [key]))
    )


def total_and_mean_by(
    df: DataFrame,
    key: str,
    value: str,
    places: int,
    names: tuple[str, str, str] = ("n", "total", "mean"),
    digits: tuple[int, int] = (2, 4),
) -> DataFrame:
    """Rows, rounded total and rounded mean of a value per key.

    All rows are counted; the total and the mean leave NULL values out. ``places`` is
    the number of decimal places the values are summed with, here and below.
    """
    n, total, mean = names
    return (
        df.groupBy(key)
        .agg(
            F.count("*").alias(n),
            round_half_away(exact_sum(value, places), digits[0]).alias(total),
            *_rounded_means({mean: (value, digits[1])}, places),
        )
        .orderBy(*_largest_first(total, [key]))
    )


def means_by(
    df: DataFrame,
    key: str,
    count: str,
    means: Mapping[str, tuple[str, int]],
    places: int,
) -> DataFrame:
    """Rows and rounded means per key, sorted by the first mean.

    ``means`` maps an output name to the column and the digits to keep.
    """
    first = next(iter(means))
    return (
        df.groupBy(key)
        .agg(F.count("*").alias(count), *_rounded_means(means, places))
        .orderBy(*_largest_first(first, [key]))
    )


def top_groups(
    df: DataFrame,
    keys: Sequence[str],
    count: str,
    means: Mapping[str, tuple[str, int]],
    k: int,
    places: int,
) -> DataFrame:
    """The k largest groups with their rounded means, ties cut in key order."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias(count), *_rounded_means(means, places))
        .orderBy(*_largest_first(count, keys))
        .limit(k)
    )


def density(
    df: DataFrame,
    x: tuple[str, float],
    y: tuple[str, float],
    names: tuple[str, str, str] = ("grid_x", "grid_y", "n"),
) -> DataFrame:
    """Rows per cell of a grid; ``x`` and ``y`` are a column and its cell size.

    Rows without both coordinates are left out. A value on the upper edge of the
    last cell opens a further cell.
    """
    grid_x, grid_y, count = names
    cells = [
        F.floor(F.col(column) / F.lit(float(size))).cast("int").alias(name)
        for (column, size), name in ((x, grid_x), (y, grid_y))
    ]
    return (
        df.where(F.col(x[0]).isNotNull() & F.col(y[0]).isNotNull())
        .groupBy(*cells)
        .agg(F.count("*").alias(count))
        .orderBy(*_largest_first(count, [grid_x, grid_y]))
    )


def share_of_total(
    df: DataFrame, key: str, names: tuple[str, str] = ("total", "pct"), digits: int = 2
) -> DataFrame:
    """Rows per key and their share of all rows in percent.

    The grand total is a scalar subquery over the grouped counts, which reuses their
    shuffle. A window over the whole result would move every group to one task.
    """
    total, pct = names
    groups = df.groupBy(key).agg(F.count("*").alias(total))
    everything = groups.select(F.sum(total)).scalar()
    share = F.lit(100.0) * F.col(total) / everything
    return groups.withColumn(pct, round_half_away(share, digits)).orderBy(
        *_largest_first(total, [key])
    )
