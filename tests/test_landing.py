"""Landing: keys, files, streams, stored objects and tables."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import event, match
from halfspace.operators import landing_counts, unlanded_keys
from halfspace.plans.medallion import (
    IncompleteBatchError,
    Lake,
    land_catalog,
    land_events,
    land_matches,
    landed_events,
)
from halfspace.sinks import append_rows, remove, replace_partitions, replace_table
from halfspace.sources import (
    FileFeed,
    list_objects,
    read_bytes,
    read_table,
    read_table_or_empty,
    read_texts,
)
from halfspace.streaming import EmptyFileError, land_new_files
from halfspace.workspace import fresh_dir, setting


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "key INT")


def test_counts_and_new_keys(spark):
    wanted, landed = keys(spark, 1, 2, 2, 3, 4), keys(spark, 1, 1, 9)
    assert sorted(r.key for r in unlanded_keys(wanted, landed, "key").collect()) == [2, 3, 4]
    # The second entry of 2 finds the first one there.
    assert tuple(landing_counts(wanted, landed, "key").first()) == (3, 2, 5)
    assert tuple(landing_counts(keys(spark), landed, "key").first()) == (0, 0, 0)


# --- Landing of files --------------------------------------------------------------


@pytest.fixture
def season(site):
    def make(*match_ids, files=None):
        site.season([match(i, "Reds", "Blues", (1, 0)) for i in match_ids])
        for i in match_ids if files is None else files:
            site.put(f"events/{i}.json", [event("Pass", id=f"{i}-{n}") for n in range(3)])

    return make


@pytest.fixture
def land(spark, site, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def make(batch=50_000):
        feed = FileFeed(str(site.root), batch)
        land_catalog(spark, lake, feed)
        land_matches(spark, lake, feed)
        metrics = land_events(spark, lake, feed)
        return tuple(int(metrics[k]) for k in ("ingested", "skipped_existing", "total_matches"))

    make.lake = lake
    return make


def landed_ids(spark, lake):
    rows = read_table(spark, lake.path("raw/events")).where("payload IS NOT NULL").collect()
    return sorted(json.loads(r.payload)["id"] for r in rows)


def test_second_run_skips_everything(spark, season, land):
    season(1, 2, 3)
    assert land() == (3, 0, 3)
    before = landed_ids(spark, land.lake)
    assert land() == (0, 3, 3)
    assert landed_ids(spark, land.lake) == before
    assert len(before) == 9


def test_one_new_match_lands_alone(spark, site, season, land):
    season(1, 2)
    land()
    season(1, 2, 3)
    site.put("events/1.json", [event("Pass", id="rewritten")])
    site.put("events/99.json", [event("Pass", id="not listed")])
    assert land() == (1, 2, 3)
    ids = landed_ids(spark, land.lake)
    assert len(ids) == 9 and "rewritten" not in ids and "not listed" not in ids


@pytest.mark.parametrize("batch", [1, 2, 100])
def test_batches_land_every_match_once(spark, season, land, batch):
    season(*range(1, 8))
    assert land(batch) == (7, 0, 7)
    assert len(landed_ids(spark, land.lake)) == len(set(landed_ids(spark, land.lake))) == 21


def test_match_listed_twice_lands_once(spark, season, land):
    season(4, 4)
    assert land() == (1, 1, 2)
    assert len(landed_ids(spark, land.lake)) == 3


def test_match_without_events_counts_as_landed(spark, site, season, land):
    season(1)
    site.put("events/1.json", [])
    assert land() == (1, 0, 1)
    assert land() == (0, 1, 1)
    assert landed_ids(spark, land.lake) == []


def test_missing_file_fails(spark, season, land):
    season(1, 2, files=[1])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        land()


def test_landed_batches_survive_a_failed_run(spark, site, season, land):
    season(1, 2, 3, 4, files=[1, 2, 3])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        land(1)
    site.put("events/4.json", [event("Pass", id="4-0")])
    ingested, skipped, total = land(1)
    assert ingested + skipped == total == 4
    assert len(landed_ids(spark, land.lake)) == 10


@pytest.mark.parametrize("text", ["", " \n", "null", '{"id": "x"}', '[null, {"id": "x"}]', "[1"])
def test_a_file_that_is_no_array_fails_and_can_be_mended(spark, site, season, land, text):
    season(1, 2)
    (site.root / "events" / "2.json").write_text(text)
    with pytest.raises(Exception, match="no array|MALFORMED|Malformed|JSON|without rows"):
        land()
    site.put("events/2.json", [event("Pass", id="mended")])
    assert land() == (2, 0, 2)
    assert "mended" in landed_ids(spark, land.lake)


@pytest.mark.parametrize("name", ["competitions.json", "matches/11/90.json"])
def test_an_empty_catalog_or_list_file_fails(spark, site, season, land, name):
    season(1)
    (site.root / name).write_text("")
    with pytest.raises(Exception, match="no array"):
        land()


def test_a_half_done_batch_has_not_landed(spark, season, land):
    season(1, 2)
    raw = land.lake.path("raw/events")
    half = spark.createDataFrame([(1, 0, '{"id": "half"}')], "match_id INT, pos INT, payload STRING")
    append_rows(half, f"{raw}/batch=unfinished")
    assert land() == (2, 0, 2)
    events = landed_events(spark, land.lake)
    ids = sorted(json.loads(r.payload)["id"] for r in events.collect())
    assert ids == [f"{i}-{n}" for i in (1, 2) for n in range(3)]


def test_a_match_landed_by_two_runs_is_read_once(spark, season, land):
    season(1)
    land()
    manifest = land.lake.path("raw/landed")
    again = read_table(spark, manifest).selectExpr("match_id", "'z-later' AS batch")
    append_rows(again.cache(), manifest)
    assert landed_events(spark, land.lake).count() == 3
    assert land() == (0, 1, 1)


def test_a_second_landing_reads_no_events(spark, season, land):
    season(1, 2)
    land()
    remove(spark, land.lake.path("raw/events"))
    assert land() == (0, 2, 2)


def test_rows_missing_from_a_batch_are_noticed(spark, site, season, land, monkeypatch):
    season(1, 2)

    def partly(self, spark, keys, count):
        for batch in whole(self, spark, keys, count):
            yield replace(batch, events=batch.events.where("match_id = 1"))

    whole = FileFeed.events
    monkeypatch.setattr(FileFeed, "events", partly)
    with pytest.raises(IncompleteBatchError, match=r"1 matches without rows: \[2\]"):
        land()
    monkeypatch.undo()
    assert land() == (2, 0, 2)


def test_listed_match_without_id_fails(spark, site, land):
    site.season([{"match_date": "2020-01-01"}])
    with pytest.raises(Exception, match="no match_id"):
        land()


def test_match_list_is_replaced_for_its_season_only(spark, site, tmp_path):
    lake = Lake(str(tmp_path / "lake"), ((11, 90), (11, 91)))
    feed = FileFeed(str(site.root))
    site.season([match(1, "a", "b", None), match(2, "a", "b", None)], season=90)
    site.season([match(3, "a", "b", None)], season=91)
    assert land_matches(spark, lake, feed)["match_count"] == "3"
    site.season([match(2, "a", "b", None)], season=90)
    land_matches(spark, Lake(lake.root, ((11, 90),)), feed)
    rows = read_table(spark, lake.path("raw/matches")).select("season_id", "match_id").collect()
    assert sorted(map(tuple, rows)) == [(90, 2), (91, 3)]
    site.season([], season=90)
    assert land_matches(spark, Lake(lake.root, ((11, 90),)), feed)["match_count"] == "0"
    assert land_matches(spark, lake, feed)["match_count"] == "1"


def test_catalog_is_counted(spark, site, tmp_path):
    site.season([])
    lake = Lake(str(tmp_path / "lake"))
    assert land_catalog(spark, lake, FileFeed(str(site.root)))["competition_count"] == "2"


# --- Streams -----------------------------------------------------------------------


def test_stream_lands_new_files_once(spark, site, tmp_path):
    paths = [str(tmp_path / name) for name in ("raw", "checkpoint")]
    site.put("events/1.json", [event("Pass", id="a"), event("Pass", id="b")])
    site.put("events/2.json", [])
    land_new_files(spark, f"{site.root}/events", *paths)
    site.put("events/3.json", [event("Pass", id="c")])
    land_new_files(spark, f"{site.root}/events", *paths)
    land_new_files(spark, f"{site.root}/events", *paths)
    rows = read_table(spark, paths[0]).select("name", "pos", "payload").collect()
    found = sorted((r.name, r.pos, json.loads(r.payload)["id"]) for r in rows if r.payload)
    assert found == [("1", 0, "a"), ("1", 1, "b"), ("3", 0, "c")]
    assert [r.name for r in rows if r.payload is None] == ["2"]


def test_stream_lands_old_files_and_refuses_blank_ones(spark, site, tmp_path):
    paths = [f"{site.root}/events", str(tmp_path / "raw"), str(tmp_path / "checkpoint")]
    site.put("events/1.json", [event("Pass", id="a")])
    land_new_files(spark, *paths)
    site.put("events/2.json", [event("Pass", id="b")])
    long_ago = (site.root / "events" / "1.json").stat().st_mtime - 400 * 24 * 3600
    os.utime(site.root / "events" / "2.json", (long_ago, long_ago))
    site.put("events/3.json", [event("Pass", id="c")])
    land_new_files(spark, *paths)
    assert sorted(r.name for r in read_table(spark, paths[1]).collect()) == ["1", "2", "3"]
    (site.root / "events" / "4.json").write_text(" \n")
    with pytest.raises(Exception, match="no array"):
        land_new_files(spark, *paths)


def test_stream_notices_files_of_zero_bytes(spark, site, tmp_path):
    paths = [f"{site.root}/events", str(tmp_path / "raw"), str(tmp_path / "checkpoint")]
    site.put("events/1.json", [event("Pass", id="a")])
    (site.root / "events" / "2.json").write_text("")
    with pytest.raises(EmptyFileError, match="2.json"):
        land_new_files(spark, *paths)
    assert [r.name for r in read_table(spark, paths[1]).collect()] == ["1"]


def test_stream_in_several_batches(spark, site, tmp_path):
    for i in range(5):
        site.put(f"events/{i}.json", [event("Pass", id=str(i))])
    raw = str(tmp_path / "raw")
    paths = [f"{site.root}/events", raw, str(tmp_path / "checkpoint")]
    land_new_files(spark, *paths, files_per_batch=2)
    assert sorted(r.name for r in read_table(spark, raw).collect()) == list("01234")


# --- Objects and tables ------------------------------------------------------------


def test_objects_are_listed_and_read_whole(spark, site):
    site.put("a/1.json", ["é"])
    site.put("a/b/2.json", [])
    site.put("a/b/3.txt", [])
    listed = list_objects(spark, f"{site.root}/a", "*.json")
    sizes = {r.path.rsplit("/", 1)[1]: r.length for r in listed.collect()}
    assert sizes == {"1.json": 6, "2.json": 2}
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert read_texts(spark, f"{site.root}/a/1.json").first().payload == '["é"]'
    assert bytes(read_bytes(spark, f"{site.root}/a/1.json").first().content) == '["é"]'.encode()


def test_tables_are_replaced_appended_and_compressed(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, p STRING")
    replace_table(rows, path)
    replace_table(rows, path)
    append_rows(rows.where("k = 1"), path)
    assert sorted(r.k for r in read_table(spark, path).collect()) == [1, 1, 2]
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "t").glob("*.parquet"))


def test_failed_replacement_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        replace_table(spark.range(3).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert read_table(spark, path).count() == 3


def test_failed_replacement_keeps_the_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, p STRING")
    replace_partitions(rows, path, ["p"])
    fails = F.when(F.col("k") == 2, F.raise_error(F.lit("boom"))).otherwise(9)
    broken = rows.withColumn("k", fails)
    with pytest.raises(Exception, match="boom"):
        replace_partitions(broken, path, ["p"])
    assert sorted((r.k, r.p) for r in read_table(spark, path).collect()) == [(1, "a"), (2, "b")]


def test_only_a_missing_table_counts_as_empty(spark, tmp_path):
    assert read_table_or_empty(spark, str(tmp_path / "none"), "k INT").count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not a table")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_table_or_empty(spark, str(tmp_path / "broken"), "k INT").collect()


def test_setting_is_put_back(spark):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), setting(spark, key, "3"):
        assert spark.conf.get(key) == "3"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_scratch_lies_below_the_shared_folder(spark):
    first, second = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second
