"""One small Spark session for all tests; intermediate tables go to pytest's folder."""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("halfspace-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


def event(kind: str, **fields) -> dict:
    """An event document; fields given as NULL stay in the document."""
    document = {
        "id": f"{kind}-1",
        "index": 1,
        "period": 1,
        "minute": 71,
        "second": 38,
        "timestamp": "00:26:38.019",
        "type": {"id": 7, "name": kind},
        "possession": 133,
        "possession_team": {"id": 1, "name": "Reds"},
        "play_pattern": {"id": 1, "name": "Open"},
        "team": {"id": 1, "name": "Reds"},
        "player": {"id": 10, "name": "Ana"},
        "position": {"id": 3, "name": "Wing"},
        "location": [17.6, 62.3],
        "duration": 1.75,
        "related_events": [],
    }
    return {**document, **fields}


def match(match_id: int, home: str, away: str, score: tuple | None, **fields) -> dict:
    """A match document; without a score the match is still to be played."""
    home_score, away_score = score or (None, None)
    document = {
        "match_id": match_id,
        "match_date": "2020-09-12",
        "kick_off": "16:00:00.000",
        "home_team": {"home_team_id": 1, "home_team_name": home},
        "away_team": {"away_team_id": 2, "away_team_name": away},
        "home_score": home_score,
        "away_score": away_score,
        "match_week": 1,
        "competition": {"competition_id": 11, "competition_name": "Cup"},
        "season": {"season_id": 90, "season_name": "2020"},
        "stadium": {"id": 1, "name": "Park"},
        "referee": {"id": 1, "name": "Kim"},
    }
    return {**document, **fields}


class Site:
    """A folder of raw files, laid out as a feed reads it."""

    def __init__(self, root: Path):
        self.root = root

    def put(self, name: str, documents: list) -> None:
        path = self.root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(documents, ensure_ascii=False), encoding="utf-8")

    def season(self, matches: list[dict], competition: int = 11, season: int = 90) -> None:
        self.put("competitions.json", [{"competition_id": competition}, {"competition_id": 2}])
        self.put(f"matches/{competition}/{season}.json", matches)


@pytest.fixture
def site(tmp_path):
    return Site(tmp_path / "site")


@pytest.fixture
def payloads(spark):
    """Documents as a raw table."""

    def make(documents: list[dict]):
        rows = [(json.dumps(d, ensure_ascii=False),) for d in documents]
        return spark.createDataFrame(rows, "payload STRING")

    return make
