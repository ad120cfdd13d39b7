"""Event files that a stream lands in a lake."""

from __future__ import annotations

from pathlib import Path

import pytest

from conftest import event, match
from halfspace.plans import Lake, run
from halfspace.plans.medallion import land_events, land_matches
from halfspace.sources import FileFeed, read_table
from halfspace.streaming import EmptyFileError, empty_files, land_event_files, landing


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def drop(spark, site, lake, tmp_path):
    """Puts files of two passes each, and runs the stream."""

    def make(*match_ids, files_per_batch=20_000):
        for i in match_ids:
            site.put(f"events/{i}.json", [event("Pass", id=f"{i}-{n}") for n in range(2)])
        land_event_files(spark, lake, f"{site.root}/events", str(tmp_path / "checkpoint"), files_per_batch)

    return make


def landed(spark, lake) -> list:
    rows = read_table(spark, lake.path("raw/events")).where("payload IS NOT NULL")
    return sorted(tuple(r) for r in rows.groupBy("match_id").count().collect())


def test_streamed_matches_are_checked_and_published(spark, site, lake, drop):
    drop(1, 2, files_per_batch=1)
    drop(3)
    drop()
    site.put("events/9.json", [])
    drop()
    assert landed(spark, lake) == [(1, 2), (2, 2), (3, 2)]
    site.season([match(i, "Reds", "Blues", (1, 0)) for i in (1, 2, 3, 4, 9)])
    site.put("events/4.json", [event("Pass", id="4-0")])
    # The run lands by key what the stream has not.
    metrics = run(spark, lake, FileFeed(str(site.root)))
    assert metrics["events_raw"] == {"ingested": "1", "skipped_existing": "4", "total_matches": "5"}
    events = read_table(spark, lake.path("trusted/events")).groupBy("match_id").count().collect()
    assert sorted(tuple(r) for r in events) == [(1, 2), (2, 2), (3, 2), (4, 1)]
    # And the stream leaves alone what the run has landed.
    drop(5)
    assert landed(spark, lake) == [(1, 2), (2, 2), (3, 2), (4, 1), (5, 2)]


@pytest.mark.parametrize("breaking", ["events", "landed"])
def test_a_batch_that_broke_off_lands_once(spark, site, lake, drop, monkeypatch, breaking):
    plain = landing.append_rows

    def breaks(df, path, **options):
        plain(df, path, **options)
        if f"raw/{breaking}" in path:
            raise OSError("broke off")

    monkeypatch.setattr(landing, "append_rows", breaks)
    with pytest.raises(Exception, match="broke off"):
        drop(1, 2)
    monkeypatch.undo()
    drop()
    assert landed(spark, lake) == [(1, 2), (2, 2)]
    manifest = read_table(spark, lake.path("raw/landed"))
    assert manifest.count() == 2 and manifest.select("batch").distinct().count() == 1


def test_empty_files_are_noticed_after_the_others_have_landed(spark, site, lake, drop):
    site.put("events/1.json", [])
    (site.root / "events/2.json").write_text("")
    with pytest.raises(EmptyFileError, match=r"1 files.*2\.json"):
        drop(3)
    assert landed(spark, lake) == [(3, 2)]
    assert [Path(name).name for name in empty_files(spark, str(site.root))] == ["2.json"]


def test_a_file_of_another_name_fails(site, drop):
    site.put("events/notes.json", [event("Pass")])
    with pytest.raises(Exception, match="not named after a match"):
        drop(1)


def test_what_was_landed_by_key_is_not_streamed(spark, site, lake, drop):
    site.season([match(1, "Reds", "Blues", (1, 0))])
    site.put("events/1.json", [event("Pass", id="first")])
    feed = FileFeed(str(site.root))
    land_matches(spark, lake, feed)
    land_events(spark, lake, feed)
    drop(1, 2)
    assert landed(spark, lake) == [(1, 1), (2, 2)]


def test_very_many_files_do_not_make_as_many_batches(spark, site, lake, drop, monkeypatch):
    monkeypatch.setattr(landing, "BATCHES", 2)
    drop(*range(1, 9), files_per_batch=1)
    manifest = read_table(spark, lake.path("raw/landed"))
    assert manifest.count() == 8 and manifest.select("batch").distinct().count() == 2


def test_empty_files_are_not_looked_up_one_by_one_in_the_driver(spark, site, lake, drop, monkeypatch):
    monkeypatch.setattr(landing, "located", None)
    drop(1, 2)
    assert landed(spark, lake) == [(1, 2), (2, 2)]
