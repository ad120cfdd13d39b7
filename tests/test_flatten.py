"""Flattening of raw documents."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import event, match
from halfspace.formats import CHECKED_EVENT, RAW_EVENT, TRUSTED_EVENT, TRUSTED_MATCH
from halfspace.operators import InRange, NotNull, check, drop_incomplete, flatten
from halfspace.plans import checked_events, trusted_events, trusted_matches
from halfspace.sources import elements, scan_documents

PASS = event("Pass")
KICK_OFF = event("Starting XI", player=None, location=None)
SHOT = event(
    "Shot",
    location=[96.5, 21.25],
    shot={"statsbomb_xg": 0.07, "outcome": {"id": 3, "name": "Wide"}},
)


def test_checked_columns_agree_with_the_documents(payloads):
    """Random documents, with parts missing, against the same columns taken in Python."""
    dice = random.Random(21)
    documents = []
    for n in range(120):
        fields = {"id": f"e{n}", "minute": dice.randrange(95)}
        if dice.random() < 0.4:
            fields["location"] = [round(dice.uniform(-5, 125), 2) for _ in range(dice.randrange(4))]
        if dice.random() < 0.3:
            fields[dice.choice(["player", "team", "type", "period", "id"])] = None
        documents.append(event("Carry", **fields))
    rows = checked_events(payloads(documents))
    assert tuple(rows.columns) == CHECKED_EVENT

    def taken(document, path):
        value = document
        for part in path.removesuffix("]").replace("[", ".").split("."):
            if value is None:
                return None
            if part.isdigit():
                value = float(value[int(part) - 1]) if len(value) >= int(part) else None
            else:
                value = value.get(part)
        return value

    paths = {name: path for name, _, path in TRUSTED_EVENT if name in CHECKED_EVENT}
    expected = [tuple(taken(d, paths[name]) for name in CHECKED_EVENT) for d in documents]
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize(
    ("location", "expected"),
    [
        ([], (None, None)),
        ([7], (7.0, None)),
        ([120, 80, 1.5], (120.0, 80.0)),
        (["a", "8.5"], (None, 8.5)),
    ],
)
def test_location_shapes(payloads, location, expected):
    document = event("Pass", location=location)
    for rows in (checked_events(payloads([document])), trusted_events(payloads([document]))):
        row = rows.first()
        assert (row.loc_x, row.loc_y) == expected


def test_absent_fields_are_null(payloads):
    row = trusted_events(payloads([{"id": "only"}])).first()
    assert row.event_id == "only"
    assert [row[c] for c, _, _ in TRUSTED_EVENT if c != "event_id"] == [None] * 22


def test_trusted_event_columns_types_and_values(payloads):
    document = event(
        "Pass",
        **{"pass": {"length": 12.5, "angle": -0.5, "outcome": {"id": 9, "name": "Out"}}},
    )
    rows = trusted_events(payloads([document, SHOT]))
    assert rows.dtypes == [(name, kind) for name, kind, _ in TRUSTED_EVENT]
    played, shot = rows.orderBy("event_type").collect()
    assert (played.pass_length, played.pass_angle_rad, played.pass_outcome) == (12.5, -0.5, "Out")
    assert (played.xg, played.shot_outcome) == (None, None)
    assert (played.timestamp, played.position_name) == ("00:26:38.019", "Wing")
    assert (shot.xg, shot.shot_outcome, shot.pass_length) == (0.07, "Wide", None)


def test_trusted_match_columns_and_types(payloads):
    rows = trusted_matches(payloads([match(1, "Reds", "Blues", (2, 1), referee=None)]))
    assert rows.dtypes == [(name, kind) for name, kind, _ in TRUSTED_MATCH]
    row = rows.first()
    assert row.match_date == datetime.date(2020, 9, 12)
    assert (row.home_team, row.away_team) == ("Reds", "Blues")
    assert (row.home_score, row.away_score, row.referee) == (2, 1, None)


@pytest.mark.parametrize("bad", [{"period": "x"}, {"duration": "long"}, {"type": 3}])
def test_value_that_does_not_fit_fails(payloads, bad):
    with pytest.raises(Exception, match="(?i)malformed"):
        trusted_events(payloads([event("Pass", **bad)])).collect()


def test_scan_of_array_files_matches_fields_by_name(spark, site):
    site.put("events/1.json", [PASS, KICK_OFF])
    site.put("events/2.json", [SHOT])
    site.put("events/3.json", [])
    scanned = scan_documents(spark, f"{site.root}/events/*.json", RAW_EVENT)
    rows = {r.event_id: r for r in flatten(scanned, TRUSTED_EVENT).collect()}
    assert set(rows) == {"Pass-1", "Starting XI-1", "Shot-1"}
    assert (rows["Shot-1"].xg, rows["Pass-1"].xg) == (0.07, None)


def test_scan_fails_on_bad_value(spark, site):
    site.put("events/1.json", [event("Pass", minute="late")])
    scanned = scan_documents(spark, f"{site.root}/events", RAW_EVENT)
    with pytest.raises(Exception, match="(?i)malformed"):
        flatten(scanned, TRUSTED_EVENT).collect()


def test_elements_keep_order_and_text(spark):
    documents = [{"a": 1.50, "t": "çé"}, {"b": [1, {"c": None}]}]
    texts = [(json.dumps(documents, ensure_ascii=False),), ("[]",)]
    rows = elements(spark.createDataFrame(texts, "payload STRING")).collect()
    assert [r.pos for r in rows] == [0, 1, None]
    assert [json.loads(r.payload) for r in rows[:2]] == documents
    assert rows[2].payload is None


def test_elements_fail_on_broken_document(spark):
    broken = spark.createDataFrame([('[{"id": 1},',)], "payload STRING")
    with pytest.raises(Exception, match="(?i)malformed"):
        elements(broken).collect()


def test_flatten_without_array_paths_is_strict(spark):
    rows = spark.createDataFrame([("x",)], "a STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flatten(rows, [("a", "int", "a")]).collect()
    arrays = rows.select(F.array("a").alias("a"))
    assert flatten(arrays, [("a", "double", "a[1]")]).first().a is None
