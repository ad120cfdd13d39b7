"""The seven analytic queries over the trusted tables.

Filters and the columns in use reach the Parquet scan, so a query reads two to six
of the trusted columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfspace.formats import GRID_CELL, OPPONENT_HALF_X
from halfspace.operators import (
    density,
    means_by,
    points_by,
    share_of_total,
    top_groups,
    top_rows,
    total_and_mean_by,
)

# Decimal places kept of expected goals, lengths, angles and coordinates.
PLACES = 12


def _events(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("event_type") == kind)


def home_standings(matches: DataFrame) -> DataFrame:
    """Points and goals of each team over its home games."""
    return points_by(
        matches, "home_team", "home_score", "away_score", ("home_pts", "home_gf", "home_ga")
    ).withColumnRenamed("home_team", "team")


def team_xg(events: DataFrame) -> DataFrame:
    """Shots, total expected goals and expected goals per shot of each team."""
    return total_and_mean_by(
        _events(events, "Shot"),
        "team_name",
        "xg",
        PLACES,
        ("shots", "total_xg", "avg_xg_per_shot"),
    )


def shot_map(events: DataFrame, k: int = 50) -> DataFrame:
    """The k shots with the highest expected goals, with their coordinates."""
    columns = ["player_name", "team_name", "loc_x", "loc_y", "xg", "shot_outcome"]
    ties = [c for c in columns if c != "xg"]
    return top_rows(_events(events, "Shot"), "xg", k, columns, ties)


def pass_density(events: DataFrame) -> DataFrame:
    """Passes per cell of a grid over the pitch."""
    width, height = GRID_CELL
    return density(
        _events(events, "Pass"),
        ("loc_x", width),
        ("loc_y", height),
        ("grid_x", "grid_y", "pass_count"),
    )


def team_passing(events: DataFrame) -> DataFrame:
    """Passes with a length, and their mean length and angle, of each team."""
    passes = _events(events, "Pass").where(F.col("pass_length").isNotNull())
    means = {"avg_length_m": ("pass_length", 1), "avg_angle_rad": ("pass_angle_rad", 3)}
    return means_by(passes, "team_name", "passes", means, PLACES)


def top_pressers(events: DataFrame, k: int = 20) -> DataFrame:
    """The k players with the most pressures in the opponent's half."""
    high = _events(events, "Pressure").where(F.col("loc_x") > OPPONENT_HALF_X)
    means = {"avg_press_x": ("loc_x", 1), "avg_press_y": ("loc_y", 1)}
    return top_groups(high, ["player_name", "team_name"], "pressures", means, k, PLACES)


def event_mix(events: DataFrame) -> DataFrame:
    """Events per type and their share of all events in percent."""
    return share_of_total(events, "event_type")
