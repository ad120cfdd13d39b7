"""A simple model of expected goals: logistic regression on a shot's distance and angle.

The model is fitted by ``pyspark.ml`` over all shots: each round sums a gradient of three
numbers inside the tasks. Shots are scored by a plain expression, so scoring stays in the
query that asks for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.formats import GOAL, GOAL_X, POST_Y, SHOT

FEATURES = ("distance", "angle")
ROUNDS = 200
TOLERANCE = 1e-12


class NoModelError(Exception):
    """Raised when the shots are too few, or too much alike, for a model."""


@dataclass(frozen=True)
class XgModel:
    """Coefficients, for a distance in units of the pitch and an angle in radians."""

    intercept: float
    distance: float
    angle: float
    shots: int
    goals: int

    def chance(self) -> Column:
        """The chance of a goal, from the columns ``distance`` and ``angle``."""
        sum_ = self.intercept + self.distance * F.col("distance") + self.angle * F.col("angle")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-sum_))


def with_geometry(events: DataFrame) -> DataFrame:
    """Add the distance to the middle of the goal, and the angle between its posts.

    NULL where the location is; on the goal line between the posts the angle is a half turn.
    """
    x, y = F.col("loc_x"), F.col("loc_y")
    ahead, (low, high) = GOAL_X - x, POST_Y
    middle = (low + high) / 2
    return events.withColumns(
        {
            "distance": F.sqrt(ahead * ahead + (y - middle) * (y - middle)),
            "angle": F.abs(F.atan2(F.lit(high) - y, ahead) - F.atan2(F.lit(low) - y, ahead)),
        }
    )


def shots_with_geometry(events: DataFrame, goal: str = GOAL) -> DataFrame:
    """The shots with a place and an outcome; ``goal`` is 1 for that outcome, else 0."""
    shots = events.where(
        (F.col("event_type") == SHOT) & F.col("shot_outcome").isNotNull() & F.col("loc_x").isNotNull() & F.col("loc_y").isNotNull()
    )
    return with_geometry(shots).withColumn("goal", (F.col("shot_outcome") == goal).cast("double"))


def fit_xg(events: DataFrame, goal: str = GOAL) -> XgModel:
    """Fit the model to all shots of a table of events, without regularization."""
    shots = shots_with_geometry(events, goal).select(*FEATURES, "goal")
    count, goals = shots.agg(F.count("*"), F.sum("goal")).first()
    if not count or not 0 < goals < count:
        raise NoModelError(f"{int(goals or 0)} goals in {count} shots")
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(shots)
    regression = LogisticRegression(labelCol="goal", maxIter=ROUNDS, tol=TOLERANCE, regParam=0.0)
    fitted = regression.fit(rows)
    return XgModel(fitted.intercept, *fitted.coefficients.toArray().tolist(), count, int(goals))


def with_model_xg(events: DataFrame, model: XgModel) -> DataFrame:
    """Add ``model_xg``, the chance of each shot; NULL for other events and without a place."""
    chance = F.when(F.col("event_type") == SHOT, model.chance())
    return with_geometry(events).withColumn("model_xg", chance).drop(*FEATURES)


def xg_gradient(events: DataFrame, model: XgModel, goal: str = GOAL) -> DataFrame:
    """One row: the gradient of the likelihood at the model, for each shot. Zero if fitted."""
    shots = shots_with_geometry(events, goal)
    missed = F.col("goal") - model.chance()
    return shots.agg(
        F.avg(missed).alias("intercept"), *[F.avg(missed * F.col(name)).alias(name) for name in FEATURES]
    )
