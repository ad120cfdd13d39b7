"""The model of expected goals."""

from __future__ import annotations

import math
import random

import pytest

from halfspace.plans import NoModelError, XgModel, fit_xg, with_model_xg, xg_gradient
from halfspace.plans.xg import with_geometry

SCHEMA = "event_type STRING, loc_x DOUBLE, loc_y DOUBLE, shot_outcome STRING"


def chance(a, b, c, x, y):
    distance = math.hypot(120 - x, 40 - y)
    angle = abs(math.atan2(44 - y, 120 - x) - math.atan2(36 - y, 120 - x))
    return 1 / (1 + math.exp(-(a + b * distance + c * angle)))


@pytest.fixture(scope="module")
def events(spark):
    dice, rows = random.Random(9), []
    for _ in range(6000):
        x, y = dice.uniform(80, 120), dice.uniform(10, 70)
        scored = dice.random() < chance(-1.0, -0.08, 1.5, x, y)
        rows.append(("Shot", x, y, "Goal" if scored else "Saved"))
    rows += [("Pass", 100.0, 40.0, None), ("Shot", None, None, "Goal"), ("Shot", 110.0, 40.0, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_the_coefficients_are_found(events):
    model = fit_xg(events)
    assert model.shots == 6000
    assert model.intercept == pytest.approx(-1.0, abs=0.5)
    assert model.distance == pytest.approx(-0.08, abs=0.025)
    assert model.angle == pytest.approx(1.5, abs=0.5)
    gradient = xg_gradient(events, model).first()
    assert max(map(abs, gradient)) < 1e-6
    # Away from the optimum it is not zero.
    other = XgModel(model.intercept, model.distance + 0.01, model.angle, 0, 0)
    assert max(map(abs, xg_gradient(events, other).first())) > 1e-3


def test_expected_goals_add_up_to_the_goals(events):
    model = fit_xg(events)
    scored = with_model_xg(events, model)
    assert scored.columns == [*events.columns, "model_xg"]
    shots = scored.where("shot_outcome IS NOT NULL AND loc_x IS NOT NULL AND event_type = 'Shot'")
    total = shots.selectExpr("sum(model_xg) AS expected", "count_if(shot_outcome = 'Goal') AS goals").first()
    assert total.expected == pytest.approx(total.goals, rel=1e-6)
    assert scored.where("event_type = 'Pass' OR loc_x IS NULL").where("model_xg IS NOT NULL").count() == 0
    row = shots.first()
    assert row.model_xg == pytest.approx(chance(model.intercept, model.distance, model.angle, row.loc_x, row.loc_y))


def test_geometry(spark):
    places = spark.createDataFrame([("Shot", 120.0, 40.0, "x"), ("Shot", 108.0, 40.0, "x"), ("Shot", 120.0, 50.0, "x")], SCHEMA)
    found = [(r.distance, r.angle) for r in with_geometry(places).collect()]
    assert found[0] == (0.0, pytest.approx(math.pi))
    assert found[1] == (12.0, pytest.approx(2 * math.atan2(4, 12)))
    assert found[2] == (10.0, pytest.approx(0))


@pytest.mark.parametrize("rows", [[], [("Pass", 1.0, 1.0, None)], [("Shot", 100.0, 40.0, "Goal")], [("Shot", 100.0, 40.0, "Off")] * 3])
def test_too_few_shots(spark, rows):
    with pytest.raises(NoModelError):
        fit_xg(spark.createDataFrame(rows, SCHEMA))


def test_the_fit_runs_on_partial_sums(events):
    """No shot leaves its task: the plan that the rounds read has no exchange."""
    from halfspace.plans.xg import shots_with_geometry

    plan = shots_with_geometry(events)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
