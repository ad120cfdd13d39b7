"""The raw document format, the trusted tables and the check thresholds.

Everything here is a data contract with the files that are read and the tables that
are written, so it is stated once, as plain text. Raw schemas are declared instead of
inferred: no extra pass over the documents, stable types from run to run, and a field
that no document carries reads as NULL.
"""

from __future__ import annotations

# --- Fixed values: raw documents (only the fields that are read) -------------------

# `location` holds text so that a malformed coordinate can become NULL on its own,
# while a malformed value in any other field fails the read.
RAW_EVENT = """
    id STRING,
    index INT,
    period INT,
    minute INT,
    second INT,
    timestamp STRING,
    type STRUCT<name: STRING>,
    possession INT,
    possession_team STRUCT<name: STRING>,
    play_pattern STRUCT<name: STRING>,
    team STRUCT<id: INT, name: STRING>,
    player STRUCT<id: INT, name: STRING>,
    position STRUCT<name: STRING>,
    location ARRAY<STRING>,
    duration DOUBLE,
    shot STRUCT<statsbomb_xg: DOUBLE, outcome: STRUCT<name: STRING>>,
    pass STRUCT<length: DOUBLE, angle: DOUBLE, outcome: STRUCT<name: STRING>>
"""

RAW_MATCH = """
    match_id INT,
    match_date DATE,
    kick_off STRING,
    home_team STRUCT<home_team_name: STRING>,
    away_team STRUCT<away_team_name: STRING>,
    home_score INT,
    away_score INT,
    match_week INT,
    competition STRUCT<competition_name: STRING>,
    season STRUCT<season_name: STRING>,
    stadium STRUCT<name: STRING>,
    referee STRUCT<name: STRING>
"""

# --- Fixed values: trusted tables (column, type, path in the raw document) ---------

# A path ending in [n] is the n-th element (counted from 1) of an array, read as a
# number where possible and as NULL otherwise.
TRUSTED_EVENT = (
    ("event_id", "string", "id"),
    ("event_index", "int", "index"),
    ("period", "int", "period"),
    ("minute", "int", "minute"),
    ("second", "int", "second"),
    ("timestamp", "string", "timestamp"),
    ("event_type", "string", "type.name"),
    ("possession", "int", "possession"),
    ("possession_team", "string", "possession_team.name"),
    ("play_pattern", "string", "play_pattern.name"),
    ("team_id", "int", "team.id"),
    ("team_name", "string", "team.name"),
    ("player_id", "int", "player.id"),
    ("player_name", "string", "player.name"),
    ("position_name", "string", "position.name"),
    ("loc_x", "double", "location[1]"),
    ("loc_y", "double", "location[2]"),
    ("duration_s", "double", "duration"),
    ("xg", "double", "shot.statsbomb_xg"),
    ("shot_outcome", "string", "shot.outcome.name"),
    ("pass_length", "double", "pass.length"),
    ("pass_angle_rad", "double", "pass.angle"),
    ("pass_outcome", "string", "pass.outcome.name"),
)

TRUSTED_MATCH = (
    ("match_id", "int", "match_id"),
    ("match_date", "date", "match_date"),
    ("kick_off", "string", "kick_off"),
    ("home_team", "string", "home_team.home_team_name"),
    ("away_team", "string", "away_team.away_team_name"),
    ("home_score", "int", "home_score"),
    ("away_score", "int", "away_score"),
    ("match_week", "int", "match_week"),
    ("competition_name", "string", "competition.competition_name"),
    ("season_name", "string", "season.season_name"),
    ("stadium_name", "string", "stadium.name"),
    ("referee", "string", "referee.name"),
)

# The columns the quality checks look at.
CHECKED_EVENT = ("event_id", "event_type", "period", "minute", "loc_x", "loc_y", "player_id")

# --- Fixed values: pitch, checks, default scope ------------------------------------

PITCH_X = (0.0, 120.0)
PITCH_Y = (0.0, 80.0)
RANGE_TOLERANCE = 0.99
GRID_CELL = (10, 8)
OPPONENT_HALF_X = 60

# The goal that is attacked: its line, and its posts.
GOAL_X = 120.0
POST_Y = (36.0, 44.0)
SHOT = "Shot"
GOAL = "Goal"

DEFAULT_COMPETITION_ID = 11
DEFAULT_SEASON_ID = 90
