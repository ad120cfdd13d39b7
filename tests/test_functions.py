"""Exact sums, rounding, and values at paths."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halfspace.functions import at_path, exact_mean, exact_sum, round_half_away


def spark_rounds(spark, values, digits):
    rows = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    return [r.x for r in rows.select(round_half_away(F.col("x"), digits).alias("x")).collect()]


def duck_rounds(values, digits):
    frame = pd.DataFrame({"x": values})  # noqa: F841
    return [x for (x,) in duckdb.sql(f"select round(x, {digits}) from frame").fetchall()]


def test_rounding_of_half_way_texts(spark):
    assert spark_rounds(spark, [1.005, 0.285, 2.5, -2.5], 2) == [1.0, 0.28, 2.5, -2.5]
    assert spark_rounds(spark, [2.5, -2.5, 0.5], 0) == [3.0, -3.0, 1.0]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(
        st.one_of(
            st.floats(-1e9, 1e9),
            st.integers(-(10**7), 10**7).map(lambda n: n / 10_000),
            st.integers(-(10**6), 10**6).map(lambda n: (n + 0.5) / 100),
        ),
        min_size=20,
        max_size=200,
    ),
    digits=st.integers(1, 4),
)
def test_rounding_agrees_with_the_sql_engine(spark, values, digits):
    assert spark_rounds(spark, values, digits) == duck_rounds(values, digits)


def test_sums_do_not_depend_on_partitioning(spark):
    draw = random.Random(3)
    cents = [draw.randrange(-(10**7), 10**7) for _ in range(20_000)]
    rows = spark.createDataFrame([(c / 100,) for c in cents], "x DOUBLE")
    for partitions in (1, 3, 17):
        row = rows.repartition(partitions).agg(
            exact_sum("x", 6).alias("total"), exact_mean("x", 6).alias("mean")
        ).first()
        assert row.total == sum(cents) / 100
        assert row.mean == sum(cents) / 100 / len(cents)


@pytest.mark.parametrize("places", [6, 12])
def test_sum_of_small_values(spark, places):
    rows = spark.createDataFrame([(0.076534,), (-0.076534,), (0.1,), (0.2,), (None,)], "x DOUBLE")
    row = rows.agg(exact_sum("x", places).alias("s"), exact_mean("x", places).alias("m")).first()
    assert (row.s, row.m) == (0.3, 0.075)


def test_sum_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(None,)], "x DOUBLE")
    row = rows.agg(exact_sum("x", 6).alias("s"), exact_mean("x", 6).alias("m")).first()
    assert (row.s, row.m) == (None, None)


def test_value_beyond_any_integer_raises(spark):
    rows = spark.createDataFrame([(1e19,)], "x DOUBLE")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        rows.agg(exact_sum("x", 6)).collect()


def test_many_large_values_do_not_overflow(spark):
    rows = spark.range(4_000).select(F.lit(9e12).alias("x"))
    assert rows.agg(exact_sum("x", 6).alias("s")).first().s == 4_000 * 9e12


def test_small_values_are_not_cut(spark):
    rows = spark.range(1_000).select(F.lit(4e-7).alias("x"), F.lit(-3e-11).alias("y"))
    row = rows.agg(exact_sum("x", 7).alias("x"), exact_sum("y", 12).alias("y")).first()
    assert (row.x, row.y) == (4e-4, -3e-8)


def test_groups_past_31_bits_of_rows_do_not_overflow(spark):
    n = 2**31 + 200_000_000
    assert spark.range(n).select(F.lit(-1.0).alias("x")).agg(
        exact_sum("x", 0).alias("s")
    ).first().s == -float(n)


@pytest.mark.parametrize("value", [1.0, -1.0, 4194303.75, -4194304.5, 9e18, -9e18, 2**62 + 0.0])
def test_limbs_add_up_with_either_sign(spark, value):
    rows = spark.range(1_001).select(F.lit(value).alias("x"))
    assert rows.agg(exact_sum("x", 6).alias("s")).first().s == value * 1_001


def test_path_through_null_struct(spark):
    rows = spark.createDataFrame([((None,),), (None,)], "a STRUCT<b: STRUCT<c: INT>>")
    assert [r.v for r in rows.select(at_path("a.b.c").alias("v")).collect()] == [None, None]


def test_one_value_out_of_all_bounds_does_not_stop_a_mean(spark):
    rows = spark.createDataFrame([(45.2,), (34.1,), (1e9,), (-7e17,)], "x DOUBLE")
    row = rows.agg(exact_sum("x", 12).alias("s")).first()
    assert row.s == pytest.approx(sum([45.2, 34.1, 1e9, -7e17]), rel=1e-15)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(cents=st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=300))
def test_sums_of_two_places_are_exact(spark, cents):
    rows = spark.createDataFrame([(c / 100,) for c in cents], "x DOUBLE")
    assert rows.agg(exact_sum("x", 6).alias("s")).first().s == sum(cents) / 100
