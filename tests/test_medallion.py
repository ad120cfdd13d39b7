"""The whole run, from raw files to query results."""

from __future__ import annotations

from pathlib import Path

import pytest

from conftest import event, match
from halfspace.__main__ import main
from halfspace.operators import QualityGateError
from halfspace.plans import (
    Lake,
    checked_batch,
    event_mix,
    home_standings,
    run,
    team_xg,
    trusted_views,
)
from halfspace.plans import medallion
from halfspace.plans.medallion import NotValidatedError, land_matches, publish_matches
from halfspace.sources import FileFeed, TableFeed, read_table


@pytest.fixture
def played(site):
    """Six matches with a pass, a shot and a kick-off each."""
    site.season([match(i, "Reds", "Blues", (i % 3, 1)) for i in range(1, 7)])
    for i in range(1, 7):
        shot = {"statsbomb_xg": 0.1 * i, "outcome": {"id": 1, "name": "Goal"}}
        site.put(
            f"events/{i}.json",
            [
                event("Starting XI", id=f"{i}-1", player=None, location=None),
                event("Pass", id=f"{i}-2"),
                event("Shot", id=f"{i}-3", shot=shot),
            ],
        )
    return FileFeed(str(site.root))


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def test_full_run(spark, played, lake):
    metrics = run(spark, lake, played)
    assert list(metrics) == [
        "competitions_raw",
        "matches_raw",
        "events_raw",
        "events_validated",
        "events_trusted",
        "matches_trusted",
    ]
    assert metrics["events_raw"]["ingested"] == "6"
    assert metrics["events_validated"] == {"rows_validated": "18", "matches_sampled": "6"}
    events = read_table(spark, lake.path("trusted/events"))
    matches = read_table(spark, lake.path("trusted/matches"))
    assert [tuple(r) for r in team_xg(events).collect()] == [("Reds", 6, 2.1, 0.35)]
    assert [tuple(r) for r in home_standings(matches).collect()] == [("Reds", 8, 6, 6)]
    assert {r.event_type: r.pct for r in event_mix(events).collect()} == {
        "Pass": 33.33,
        "Shot": 33.33,
        "Starting XI": 33.33,
    }
    runs = read_table(spark, lake.path("runs"))
    assert runs.count() == 6 and runs.select("run_id").distinct().count() == 1


def test_second_run_publishes_the_same(spark, played, lake):
    run(spark, lake, played)
    assert run(spark, lake, played)["events_raw"]["skipped_existing"] == "6"
    assert read_table(spark, lake.path("trusted/events")).count() == 18


def test_ingestion_only(spark, played, lake):
    assert len(run(spark, lake, played, groups={"ingestion"})) == 3
    assert not Path(lake.path("trusted")).exists()


def test_unknown_group_is_refused(spark, played, lake):
    with pytest.raises(ValueError, match="unknown"):
        run(spark, lake, played, groups={"reporting"})


@pytest.mark.parametrize("bad", [{"id": None}, {"period": None}, {"location": [121.0, 5.0]}])
def test_failed_checks_publish_nothing(spark, played, lake, site, bad):
    site.put("events/6.json", [event("Pass", **bad)])
    with pytest.raises(QualityGateError):
        run(spark, lake, played)
    assert not Path(lake.path("trusted")).exists()
    assert read_table(spark, lake.path("runs")).count() == 3


def test_failed_checks_leave_the_published_tables(spark, played, lake, site):
    run(spark, lake, played)
    site.season([match(i, "Reds", "Blues", (1, 0)) for i in range(1, 8)])
    site.put("events/7.json", [event("Pass", id=None)])
    with pytest.raises(QualityGateError):
        run(spark, lake, played)
    assert read_table(spark, lake.path("trusted/events")).count() == 18
    assert read_table(spark, lake.path("trusted/matches")).count() == 6


def test_sample_is_the_first_matches_of_the_list(spark, played, lake, site):
    site.put("events/6.json", [event("Pass", id=None)])
    sampled = Lake(lake.root, sample_matches=5)
    metrics = run(spark, sampled, played)
    assert metrics["events_validated"] == {"rows_validated": "15", "matches_sampled": "5"}


def test_run_without_events_fails(spark, site, lake):
    site.season([])
    with pytest.raises(QualityGateError, match="has_rows"):
        run(spark, lake, FileFeed(str(site.root)))


def test_seasons_are_published_side_by_side(spark, played, lake, site):
    run(spark, lake, played)
    site.season([match(50, "Greens", "Blues", (1, 0))], season=91)
    site.put("events/50.json", [event("Pass", id="50-1")])
    run(spark, Lake(lake.root, ((11, 91),)), played)
    events = read_table(spark, lake.path("trusted/events"))
    assert {(r.season_id, r["count"]) for r in events.groupBy("season_id").count().collect()} == {
        (90, 18),
        (91, 1),
    }
    assert read_table(spark, lake.path("trusted/matches")).count() == 7


def test_trusted_tables_answer_sql(spark, played, lake):
    run(spark, lake, played)
    trusted_views(spark, lake)
    rows = spark.sql(
        "SELECT team_name, count(*) AS n FROM events WHERE event_type = 'Shot' GROUP BY team_name"
    )
    assert [tuple(r) for r in rows.collect()] == [("Reds", 6)]
    assert spark.sql("SELECT sum(home_score) AS goals FROM matches").first().goals == 6


def test_command_line(spark, played, lake, capsys):
    common = ["--lake", lake.root, "--scopes", "11/90"]
    main(["run", "--source", played.root, *common])
    assert "events_raw ingested=6 skipped_existing=0 total_matches=6" in capsys.readouterr().out
    main(["query", "team_xg", *common])
    assert "|Reds     |6    |2.1     |0.35" in capsys.readouterr().out


def test_join_without_broadcast_lands_a_hot_match(spark, tmp_path):
    """A match with a third of all events, keyed by a shuffled join."""
    lake = Lake(str(tmp_path / "lake"))
    matches = spark.range(300).selectExpr(
        "11 AS competition_id",
        "90 AS season_id",
        "cast(id AS INT) AS pos",
        "named_struct('match_id', cast(id AS INT)) AS document",
    )
    events = spark.range(30_000).selectExpr(
        "cast(if(id % 3 = 0, 7, id % 300) AS INT) AS match_id",
        "cast(id AS INT) AS pos",
        "named_struct('id', cast(id AS STRING), 'period', 1) AS document",
    )
    feed = TableFeed(matches.select("pos", "document"), matches, events)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run(spark, lake, feed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    published = read_table(spark, lake.path("trusted/events"))
    assert published.count() == published.select("event_id").distinct().count() == 30_000
    assert published.where("match_id = 7").count() > 10_000


def test_scopes_are_folders_of_the_scan(spark, played, lake):
    run(spark, lake, played)
    rows = lake.in_scope(read_table(spark, lake.path("trusted/events")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    folders = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "competition_id" in folders and "season_id" in folders
    assert "DataFilters: []" in plan


def test_a_good_season_does_not_make_up_for_a_bad_one(spark, lake, site):
    site.season([match(1, "Reds", "Blues", (1, 0))], season=90)
    site.season([match(2, "Reds", "Blues", (1, 0))], season=91)
    site.put("events/1.json", [event("Pass", id=str(i)) for i in range(500)])
    site.put("events/2.json", [event("Pass"), event("Pass", location=[500.0, 1.0])])
    both = Lake(lake.root, ((11, 90), (11, 91)))
    with pytest.raises(QualityGateError, match=r"in_range\(loc_x\)") as raised:
        run(spark, both, FileFeed(str(site.root)))
    failed = [(e["season_id"], e["rows"]) for e in raised.value.report if not e["success"]]
    assert failed == [(91, 2)]


def test_nothing_is_published_without_a_passed_gate(spark, played, lake, site):
    only = {"transformation"}
    run(spark, lake, played, groups={"ingestion"})
    with pytest.raises(NotValidatedError):
        run(spark, lake, played, groups=only)
    site.season([match(i, "Reds", "Blues", (1, 0)) for i in range(1, 8)])
    site.put("events/7.json", [event("Pass", id=None)])
    with pytest.raises(QualityGateError):
        run(spark, lake, played)
    with pytest.raises(NotValidatedError):
        run(spark, lake, played, groups=only)
    assert not Path(lake.path("trusted")).exists()


def test_rows_landed_after_the_gate_are_not_published(spark, played, lake, site):
    run(spark, lake, played, groups={"ingestion", "validation"})
    site.season([match(i, "Reds", "Blues", (1, 0)) for i in range(1, 8)])
    site.put("events/7.json", [event("Pass", id=None)])
    run(spark, lake, played, groups={"ingestion"})
    with pytest.raises(NotValidatedError):
        run(spark, lake, played, groups={"transformation"})


def test_a_pass_of_other_checks_does_not_count(spark, played, lake, site):
    site.put("events/6.json", [event("Pass", id=None)])
    run(spark, Lake(lake.root, sample_matches=5), played, groups={"ingestion", "validation"})
    with pytest.raises(NotValidatedError):
        run(spark, lake, played, groups={"transformation"})


def test_what_passed_is_not_flattened_again(spark, played, lake):
    first = run(spark, lake, played, groups={"ingestion", "validation"})
    staged = sorted(Path(lake.path("staging")).rglob("*.parquet"))
    again = run(spark, lake, played, groups={"validation"})
    assert again["events_validated"] == first["events_validated"]
    assert sorted(Path(lake.path("staging")).rglob("*.parquet")) == staged
    run(spark, lake, played, groups={"transformation"})
    assert not list(Path(lake.path("staging")).rglob("*.parquet"))
    with pytest.raises(NotValidatedError):  # what was published is staged no more
        run(spark, lake, played, groups={"transformation"})


def test_publishing_that_broke_off_can_be_run_again(spark, played, lake, site, monkeypatch):
    run(spark, lake, played)
    site.season([match(i, "Reds", "Blues", (1, 0)) for i in range(1, 8)])
    site.put("events/7.json", [event("Pass", id="7-1")])
    run(spark, lake, played, groups={"ingestion", "validation"})

    def breaks(*_):
        raise OSError("broke off")

    monkeypatch.setattr(medallion, "commit", breaks)
    with pytest.raises(OSError, match="broke off"):
        run(spark, lake, played, groups={"transformation"})
    monkeypatch.undo()
    assert read_table(spark, lake.path("trusted/events")).count() == 18
    run(spark, lake, played, groups={"transformation"})
    assert read_table(spark, lake.path("trusted/events")).count() == 19


def test_a_match_of_two_seasons_is_published_in_both(spark, lake, site):
    site.season([match(1, "Reds", "Blues", (1, 0)), match(2, "Reds", "Blues", (1, 0))])
    site.season([match(2, "Reds", "Blues", (1, 0)), match(3, "Reds", "Blues", (1, 0))], season=91)
    for i in (1, 2, 3):
        site.put(f"events/{i}.json", [event("Pass", id=f"{i}")])
    both = Lake(lake.root, ((11, 90), (11, 91)))
    metrics = run(spark, both, FileFeed(str(site.root)))
    assert metrics["events_raw"]["ingested"] == "3"
    rows = read_table(spark, lake.path("trusted/events")).select("season_id", "match_id")
    assert sorted(map(tuple, rows.collect())) == [(90, 1), (90, 2), (91, 2), (91, 3)]


def test_an_emptied_list_empties_its_season(spark, played, lake, site):
    site.season([match(50, "Greens", "Blues", (1, 0))], season=91)
    site.put("events/50.json", [event("Pass", id="50-1")])
    both = Lake(lake.root, ((11, 90), (11, 91)))
    run(spark, both, played)
    site.season([])
    land_matches(spark, lake, played)
    publish_matches(spark, lake)
    matches = read_table(spark, lake.path("trusted/matches"))
    assert [(r.season_id, r.match_id) for r in matches.collect()] == [(91, 50)]


def test_sampled_ids_reach_the_scan(spark, played, lake):
    run(spark, lake, played)
    sampled = Lake(lake.root, sample_matches=5)
    batch = checked_batch(spark, sampled, read_table(spark, lake.path("trusted/events")))
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    pushed = plan.split("PushedFilters: [")[1]
    assert "match_id" in pushed.split("]")[0] or "In(match_id" in pushed
    assert batch.select("match_id").distinct().count() == 5


def test_each_season_needs_events(spark, played, lake, site):
    site.season([], season=91)
    both = Lake(lake.root, ((11, 90), (11, 91)))
    with pytest.raises(QualityGateError, match="has_rows"):
        run(spark, both, played)
