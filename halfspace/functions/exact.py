"""Sums, means and rounding that do not depend on how the rows are partitioned.

Floating-point addition is not associative, so a distributed ``sum(double)`` may
change its last bits between runs, and rounding can make that visible. Here a value is
taken apart into a whole number and a fraction in units of ``10**-places``, and both
are summed as integers: one answer for any partitioning, retry or merge order, inside
generated code and faster than summing decimals.

``places`` has no default, as it says which digits count: each value is rounded to so many
decimal places before it is added.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole numbers are summed in limbs of so many bits, so a limb's sum holds 2**41 rows.
LIMB = 22


def _integer_total(number: Column, limbs: int) -> Column:
    """Sum of integers, limb by limb; a limb has the sign of its number."""
    total, scale, rest = F.lit(0).cast("decimal(38,0)"), 1, number
    for i in range(limbs):
        last = i == limbs - 1
        limb = rest if last else rest % F.lit(1 << LIMB)
        total = total + F.sum(limb).cast("decimal(20,0)") * F.lit(scale).cast("decimal(18,0)")
        scale <<= LIMB
        # Integer division towards zero, exact as the limb was taken off.
        rest = F.call_function("div", rest - limb, F.lit(1 << LIMB))
    return total.cast("double")


def _exact_total(value: Column, places: int) -> Column:
    # The cast raises for NaN and beyond 2**63, where no whole number could be kept.
    unit = F.lit(float(10**places))
    whole = F.rint(value)
    fraction = F.rint((value - whole) * unit)
    wholes = _integer_total(whole.cast("bigint"), 3)
    fractions = _integer_total(fraction.cast("bigint"), 2)
    return wholes + fractions / unit


def exact_sum(column: str, places: int) -> Column:
    """Sum of a double column, NULLs left out; NULL when nothing is left."""
    return _exact_total(F.col(column), places)


def exact_mean(column: str, places: int) -> Column:
    """Mean of a double column, NULLs left out; NULL when nothing is left."""
    value = F.col(column)
    return F.try_divide(_exact_total(value, places), F.count(value).cast("double"))


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double as ``ROUND(x, n)`` does in C-based engines.

    The value is scaled, rounded to a whole number half away from zero, and scaled
    back. Spark's own ``round`` works on the decimal text instead, which turns 1.005
    into 1.01 where the scaled double, 100.49999999999999, gives 1.0.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)
