"""Data-quality checks: any number of them in one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from halfspace.functions import present


@dataclass(frozen=True)
class NotNull:
    """Every row has a value."""

    column: str
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def flags(self, df: DataFrame) -> tuple[Column, Column]:
        return ~present(df, self.column), F.lit(True)


@dataclass(frozen=True)
class InRange:
    """At least the share ``mostly`` of the values lies in [low, high].

    Rows without a value are not judged; with none to judge, the check passes.
    """

    column: str
    low: float
    high: float
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return f"in_range({self.column})"

    def flags(self, df: DataFrame) -> tuple[Column, Column]:
        inside = F.col(self.column).between(self.low, self.high)
        return present(df, self.column) & ~inside, present(df, self.column)


@dataclass(frozen=True)
class AtLeastRows:
    """The batch is not smaller than ``rows``; the shortfall counts as unexpected."""

    rows: int = 1
    column: str = "*"
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return f"at_least_rows({self.rows})"

    def flags(self, df: DataFrame) -> tuple[Column, Column]:
        return F.lit(False), F.lit(False)


Check = NotNull | InRange | AtLeastRows


class QualityGateError(Exception):
    """Raised when a batch fails its checks; ``report`` holds one entry per check."""

    def __init__(self, report: list[dict]):
        self.report = report
        failed = sorted({entry["check"] for entry in report if not entry["success"]})
        super().__init__(f"quality checks failed: {', '.join(failed)}")


def _settled(c: Check, rows: Column, bad: Column, judged: Column) -> tuple[Column, Column]:
    """A check's unexpected and judged rows, from counts over all of its rows."""
    if isinstance(c, AtLeastRows):
        short = F.greatest(F.lit(c.rows) - rows, F.lit(0)).cast("bigint")
        return short, F.greatest(rows, F.lit(c.rows)).cast("bigint")
    return bad, judged


def _entry(c: Check, rows: Column, bad: Column, judged: Column) -> Column:
    bad, judged = _settled(c, rows, bad, judged)
    kept = F.try_divide((judged - bad).cast("double"), judged.cast("double"))
    return F.struct(
        F.lit(c.name).alias("check"),
        F.lit(c.column).alias("column"),
        rows.alias("rows"),
        judged.alias("nonnull"),
        bad.alias("unexpected"),
        F.try_divide(F.lit(100.0) * bad, judged.cast("double")).alias("unexpected_pct"),
        F.lit(float(c.mostly)).alias("mostly"),
        F.coalesce(kept >= F.lit(float(c.mostly)), F.lit(True)).alias("success"),
    )


# Different bad values whose counts an aggregate keeps; with more, counts are estimates.
MOST_TRACKED = 10_000
SHOWN_CHARS = 100
COMMONEST = "array<struct<value:string,n:bigint>>"


def _commonest(c: Check, df: DataFrame, bad: Column, k: int) -> Column:
    """The k commonest bad values as text, from a summary of bounded size."""
    if c.column == "*":
        return F.lit(None).cast(COMMONEST)
    shown = F.substring(F.col(c.column).cast("string"), 1, SHOWN_CHARS)
    # Marks tell rows that are not bad (NULL) from bad ones without a value (-).
    marked = F.when(bad, F.coalesce(F.concat(F.lit("+"), shown), F.lit("-")))
    top = F.call_function("approx_top_k", marked, F.lit(k + 1), F.lit(MOST_TRACKED))
    found = F.filter(top, lambda entry: entry["item"].isNotNull())
    ranked = F.array_sort(F.transform(found, lambda e: F.struct((-e["count"]).alias("n"), e["item"].alias("item"))))
    value = lambda item: F.when(item != "-", F.substring(item, 2, SHOWN_CHARS))
    entries = F.transform(ranked, lambda e: F.struct(value(e["item"]).alias("value"), (-e["n"]).alias("n")))
    return F.slice(entries, 1, k)


def check(
    df: DataFrame, checks: Sequence[Check], by: Sequence[str] = (), commonest: int = 0
) -> DataFrame:
    """One report row per check, from a single aggregate over ``df``.

    ``nonnull`` is the number of rows judged by the check, ``unexpected_pct`` its
    percentage of bad ones. With ``by``, each group is checked for itself, so that a
    large good one does not make up for a small bad one. With ``commonest``, a column of
    that name has so many of the commonest bad values, with their counts.
    """
    counters = [F.count("*").alias("rows")]
    for i, c in enumerate(checks):
        bad, judged = c.flags(df)
        counters += [F.count_if(bad).alias(f"bad_{i}"), F.count_if(judged).alias(f"judged_{i}")]
        if commonest:
            counters.append(_commonest(c, df, bad, commonest).alias(f"top_{i}"))
    entries = []
    for i, c in enumerate(checks):
        entry = _entry(c, F.col("rows"), F.col(f"bad_{i}"), F.col(f"judged_{i}"))
        top = F.coalesce(f"top_{i}", F.array().cast(COMMONEST)).alias("commonest") if commonest else None
        entries.append(entry.withField("commonest", top) if commonest else entry)
    return df.groupBy(*by).agg(*counters).select(*by, F.inline(F.array(*entries)))


# --- Checks of a table that grows: counts of its pieces are kept and added up ---------

TALLY = "check STRING, rows BIGINT, bad BIGINT, judged BIGINT"
# Counts that one pass may take by the way; more are taken by a pass of their own.
MOST_OBSERVED = 400


def tally(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """For each group and check, counts that can be added to those of other rows."""
    counters = [F.count("*").alias("rows")]
    for i, c in enumerate(checks):
        bad, judged = c.flags(df)
        counters += [F.count_if(bad).alias(f"bad_{i}"), F.count_if(judged).alias(f"judged_{i}")]
    counts = [
        F.struct(
            F.lit(repr(c)).alias("check"),
            "rows",
            F.col(f"bad_{i}").alias("bad"),
            F.col(f"judged_{i}").alias("judged"),
        )
        for i, c in enumerate(checks)
    ]
    return df.groupBy(*by).agg(*counters).select(*by, F.inline(F.array(*counts)))


class ObservedTally:
    """The counts of ``tally``, taken by the pass that writes ``rows``.

    ``groups`` are the values of ``by`` that occur. The counts are there when the pass
    has ended.
    """

    def __init__(
        self, df: DataFrame, checks: Sequence[Check], by: Sequence[str], groups: Sequence[tuple]
    ):
        self.checks, self.by, self.groups = checks, by, groups
        self.observation = Observation()
        counters = []
        for g, group in enumerate(groups):
            mine = F.lit(True)
            for column, value in zip(by, group, strict=True):
                mine = mine & F.col(column).eqNullSafe(F.lit(value))
            counters.append(F.count_if(mine).alias(f"rows_{g}"))
            for i, c in enumerate(checks):
                bad, judged = c.flags(df)
                counters.append(F.count_if(mine & bad).alias(f"bad_{g}_{i}"))
                counters.append(F.count_if(mine & judged).alias(f"judged_{g}_{i}"))
        self.rows = df.observe(self.observation, *counters)

    def entries(self) -> list[tuple]:
        """For each group and check, the group and the columns of ``TALLY``."""
        counts = self.observation.get
        return [
            (*group, repr(c), counts[f"rows_{g}"], counts[f"bad_{g}_{i}"], counts[f"judged_{g}_{i}"])
            for g, group in enumerate(self.groups)
            for i, c in enumerate(self.checks)
        ]


def judge(tallies: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """The report of ``check``, from the tallies of all pieces of a table.

    As there, a group without rows has no report.
    """
    sums = [F.sum(name).alias(name) for name in ("rows", "bad", "judged")]
    added = tallies.groupBy(*by, "check").agg(*sums)
    entry = F.lit(None)
    for c in checks:
        mine = F.col("check") == repr(c)
        entry = F.when(mine, _entry(c, F.col("rows"), F.col("bad"), F.col("judged"))).otherwise(entry)
    wanted = added.where("rows > 0").where(F.col("check").isin([repr(c) for c in checks]))
    return wanted.select(*by, entry.alias("entry")).select(*by, "entry.*")


def gate(
    report: DataFrame, by: Sequence[str] = (), expected: Collection[tuple] = ()
) -> list[dict]:
    """Return the report's entries, or raise if any check failed.

    ``expected`` are the groups of a report made with ``by`` that must have rows. The
    driver sees one entry per group and check.
    """
    entries = [row.asDict() for row in report.collect()]
    found = {tuple(entry[column] for column in by) for entry in entries}
    entries += [
        {**dict(zip(by, group, strict=True)), "check": "has_rows", "rows": 0, "success": False}
        for group in expected
        if group not in found
    ]
    if not all(entry["success"] for entry in entries):
        raise QualityGateError(entries)
    return entries
