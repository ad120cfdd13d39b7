"""Checks and the gate."""

from __future__ import annotations

import math

import pytest

from halfspace.operators import (
    AtLeastRows,
    InRange,
    NotNull,
    QualityGateError,
    Referenced,
    Unique,
    check,
    check_suite,
    gate,
    key_check,
)
from halfspace.plans.medallion import EVENT_CHECKS


@pytest.fixture
def numbers(spark):
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "x DOUBLE")

    return make


def outcome(df, *checks):
    return [(r.nonnull, r.unexpected, r.success) for r in check(df, checks).collect()]


def test_bounds_are_inclusive(numbers):
    assert outcome(numbers(0.0, 120.0), InRange("x", 0, 120)) == [(2, 0, True)]


@pytest.mark.parametrize(("bad", "success"), [(1, True), (2, False)])
def test_tolerance_of_one_in_a_hundred(numbers, bad, success):
    values = [121.0] * bad + [60.0] * (100 - bad)
    assert outcome(numbers(*values), InRange("x", 0, 120, mostly=0.99)) == [(100, bad, success)]


def test_missing_values_are_not_judged(numbers):
    values = [None] * 5 + [math.nan] + [1.0] * 94
    in_range, not_null = outcome(numbers(*values), InRange("x", 0, 2, mostly=0.99), NotNull("x"))
    assert in_range == (94, 0, True)
    assert not_null == (100, 6, False)


def test_nothing_to_judge_passes(numbers):
    assert outcome(numbers(None, None), InRange("x", 0, 1), NotNull("x")) == [
        (0, 0, True),
        (2, 2, False),
    ]


def test_empty_batch_fails_on_size_only(numbers):
    report = outcome(numbers(), AtLeastRows(1), NotNull("x"), InRange("x", 0, 1))
    assert [success for *_, success in report] == [False, True, True]


def test_report_columns(numbers):
    row = check(numbers(1.0, 5.0, None), [InRange("x", 0, 2, mostly=0.9)]).first()
    assert row.asDict() == {
        "check": "in_range(x)",
        "column": "x",
        "rows": 3,
        "nonnull": 2,
        "unexpected": 1,
        "unexpected_pct": 50.0,
        "mostly": 0.9,
        "success": False,
    }


def test_gate_returns_the_report_or_raises(numbers):
    checks = [NotNull("x"), InRange("x", 0, 2)]
    assert len(gate(check(numbers(1.0), checks))) == 2
    with pytest.raises(QualityGateError, match=r"in_range\(x\)") as raised:
        gate(check(numbers(1.0, 9.0), checks))
    assert [entry["success"] for entry in raised.value.report] == [True, False]


def test_all_checks_share_one_scan(spark):
    schema = "event_id STRING, period INT, loc_x DOUBLE, loc_y DOUBLE"
    events = spark.createDataFrame([("a", 1, 1.0, 1.0)], schema)
    plan = check(events, EVENT_CHECKS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_groups_are_checked_one_by_one(spark):
    rows = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None)], "g INT, x DOUBLE")
    report = check(rows, [NotNull("x"), InRange("x", 0, 1, mostly=0.5)], by=["g"])
    found = {(r.g, r.check): (r.rows, r.success) for r in report.collect()}
    assert found == {
        (1, "not_null(x)"): (2, True),
        (1, "in_range(x)"): (2, True),
        (2, "not_null(x)"): (1, False),
        (2, "in_range(x)"): (1, True),
    }
    with pytest.raises(QualityGateError, match="has_rows, not_null"):
        gate(report, by=["g"], expected=[(1,), (3,)])


def test_the_commonest_bad_values_are_reported(numbers):
    values = [9.0] * 3 + [8.0] * 5 + [7.0] + [None] * 4 + [1.0] * 50
    report = check(numbers(*values), [InRange("x", 0, 2), NotNull("x"), AtLeastRows(1)], commonest=2)
    found = {r.check: [tuple(v) for v in r.commonest] for r in report.collect()}
    assert found == {"in_range(x)": [("8.0", 5), ("9.0", 3)], "not_null(x)": [(None, 4)], "at_least_rows(1)": []}
    assert check(numbers(*values), [NotNull("x")]).columns == report.columns[:-1]


def test_repeated_keys(spark):
    rows = [(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (2, None, "d"), (2, None, "e"), (2, 5, "f")]
    df = spark.createDataFrame(rows, "g INT, k INT, v STRING")
    one = key_check(df, Unique(("k",))).first()
    assert (one.rows, one.nonnull, one.unexpected, one.success) == (6, 4, 2, False)
    both = key_check(df, Unique(("k", "v"), mostly=0.9)).first()
    assert (both.check, both.unexpected, both.success) == ("unique(k, v)", 0, True)
    by = {r.g: (r.nonnull, r.unexpected) for r in key_check(df, Unique(("k",)), ["g"]).collect()}
    assert by == {1: (3, 2), 2: (1, 0)}
    none = key_check(df.limit(0), Unique(("k",))).first()
    assert (none.rows, none.unexpected, none.success) == (0, 0, True)
    with pytest.raises(ValueError, match="groups the rows"):
        key_check(df, Unique(("g", "k")), ["g"])


def test_keys_that_another_table_lacks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    other = spark.createDataFrame([(1,), (1,), (None,)], "id INT")
    report = check_suite(df, [NotNull("k", mostly=0.5), Referenced("k", "list", "id", mostly=0.6)], tables={"list": other})
    found = {r.check: (r.rows, r.nonnull, r.unexpected, r.success) for r in report.collect()}
    assert found == {"not_null(k)": (4, 4, 1, True), "referenced(k, list.id)": (4, 3, 1, True)}


def test_a_hot_key_travels_as_counts(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 7, id) AS k")
    plan = key_check(df, Unique(("k",)))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning(k") :]
    assert "partial_count" in below
