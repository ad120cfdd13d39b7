"""Publishing what is new, and tables that change in one step."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import event, match
from halfspace.operators import InRange, NotNull, QualityGateError, Referenced, Unique, check, judge, tally
from halfspace.operators.quality import ObservedTally
from halfspace.plans import Lake, medallion, run
from halfspace.sinks import append_rows, exists, remove, replace_partitions, replace_table, versions
from halfspace.sources import FileFeed, feeds, read_table, tables


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def nightly(spark, site, lake):
    """Plays matches, each with two passes unless given, and runs the lake."""

    def night(*match_ids, events=None, season=90, over=lake, **options):
        site.season([match(i, "Reds", "Blues", (1, 0)) for i in match_ids], season=season)
        for i in match_ids:
            path = site.root / f"events/{i}.json"
            if not path.exists():
                found = [event("Pass", id=f"{i}-{n}") for n in range(2)] if events is None else events
                site.put(f"events/{i}.json", found)
        return run(spark, over, FileFeed(str(site.root)), **options)

    return night


def files(lake) -> set[str]:
    root = Path(lake.path("parts/events"))
    return {str(f.relative_to(root)) for f in root.rglob("*.parquet") if "_notes" not in f.parts}


def published(spark, lake) -> Counter:
    rows = read_table(spark, lake.path("trusted/events")).select("season_id", "match_id").collect()
    return Counter(tuple(row) for row in rows)


def number(spark, lake) -> int:
    return versions.current_version(spark, lake.path("trusted/events")).number


def test_a_run_without_news_writes_no_events(spark, nightly, lake):
    first = nightly(1, 2, 3)
    before, version = files(lake), number(spark, lake)
    again = nightly(1, 2, 3)
    assert files(lake) == before and number(spark, lake) == version
    assert again["events_validated"] == first["events_validated"]


def test_only_a_new_match_is_flattened(spark, nightly, lake):
    nightly(1, 2, 3)
    before = files(lake)
    # What was published is not read from the raw table again: it is not there.
    raw = lake.path("raw/events")
    batch = next(Path(raw).glob("batch=*"))
    nightly(1, 2, 3, 4, groups={"ingestion"})
    remove(spark, str(batch))
    metrics = nightly(1, 2, 3, 4)
    assert files(lake) > before
    new = spark.read.parquet(*[f"{lake.path('parts/events')}/{f}" for f in files(lake) - before])
    assert {r.match_id for r in new.collect()} == {4}
    assert published(spark, lake) == {(90, i): 2 for i in (1, 2, 3, 4)}
    assert metrics["events_validated"]["rows_validated"] == "8"


def test_a_match_that_leaves_the_list_leaves_the_table(spark, nightly, lake):
    other = Lake(lake.root, ((11, 91),))
    nightly(50, 51, season=91, over=other)
    nightly(1, 2, 3)
    nightly(1, 2, 3, 4)
    before = files(lake)
    nightly(1, 3, 4)
    assert published(spark, lake) == {(90, 1): 2, (90, 3): 2, (90, 4): 2, (91, 50): 2, (91, 51): 2}
    live = versions.current_version(spark, lake.path("trusted/events")).live
    kept = {partition for partition, part in live if any(f"_part={part}/" in f for f in before)}
    # The folder of 4 and the other season's are as they were; that of 1 to 3 is new.
    assert len(live) == 3 and kept == {"competition_id=11/season_id=90", "competition_id=11/season_id=91"}


def test_a_match_without_events_is_not_flattened_again(spark, nightly, lake):
    nightly(1)
    nightly(1, 2, events=[])
    version = number(spark, lake)
    nightly(1, 2)
    assert number(spark, lake) == version and published(spark, lake) == {(90, 1): 2}


def test_a_season_is_judged_as_a_whole(spark, nightly, lake):
    """One event of a hundred may lie outside, wherever its match was landed."""
    nightly(1, events=[event("Pass", id=f"a{i}") for i in range(99)])
    nightly(1, 2, events=[event("Pass", id="b", location=[500.0, 1.0])])
    assert sum(published(spark, lake).values()) == 100
    before, version = files(lake), number(spark, lake)
    with pytest.raises(QualityGateError, match=r"in_range\(loc_x\)") as raised:
        nightly(1, 2, 3, events=[event("Pass", id="c", location=[500.0, 1.0])])
    assert [(e["rows"], e["unexpected"]) for e in raised.value.report if not e["success"]] == [(101, 2)]
    assert files(lake) == before and number(spark, lake) == version


def test_new_checks_count_the_published_rows_without_raw_ones(spark, nightly, lake):
    nightly(1, 2)
    nightly(1, 2, 3)
    remove(spark, lake.path("raw/events"))
    stricter = replace(lake, checks=(*lake.checks, NotNull("player_name"), InRange("minute", 0, 60)))
    with pytest.raises(QualityGateError, match=r"in_range\(minute\)") as raised:
        nightly(1, 2, 3, over=stricter)
    failed = [(e["check"], e["rows"], e["unexpected"]) for e in raised.value.report if not e["success"]]
    assert failed == [("in_range(minute)", 6, 6)]
    named = replace(lake, checks=(*lake.checks, NotNull("player_name")))
    assert nightly(1, 2, 3, over=named)["events_validated"]["rows_validated"] == "6"


def test_many_parts_are_written_together(spark, nightly, lake, monkeypatch):
    monkeypatch.setattr(medallion, "MOST_PARTS", 2)
    for last in range(1, 6):
        nightly(*range(1, last + 1))
    live = versions.current_version(spark, lake.path("trusted/events")).live
    assert len(live) <= 3
    assert published(spark, lake) == {(90, i): 2 for i in range(1, 6)}


def test_what_a_dead_run_has_staged_is_removed(spark, nightly, lake, monkeypatch):
    nightly(1, 2)
    before = files(lake)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(medallion, "_stage", lambda *a, plain=medallion._stage: (plain(*a), dies()))
    with pytest.raises(KeyboardInterrupt):
        nightly(1, 2, 3)
    monkeypatch.undo()
    assert files(lake) > before
    nightly(1, 2, 3)
    assert len({f.split("/")[0] for f in files(lake)}) == 2
    assert published(spark, lake) == {(90, 1): 2, (90, 2): 2, (90, 3): 2}


def test_checks_of_keys_hold_the_gate(spark, nightly, lake):
    keyed = replace(lake, key_checks=(Unique(("event_id",)), Referenced("match_id", "matches", "match_id")))
    nightly(1, 2, over=keyed)
    with pytest.raises(QualityGateError, match=r"unique\(event_id\)"):
        nightly(1, 2, 3, over=keyed, events=[event("Pass", id="1-0")])
    assert published(spark, lake) == {(90, 1): 2, (90, 2): 2}


def test_a_failed_gate_shows_bad_values(spark, nightly, lake):
    with pytest.raises(QualityGateError) as raised:
        nightly(1, events=[event("Pass", id=str(i), location=[500.0 + i // 2, 1.0]) for i in range(4)])
    shown = {entry["check"]: entry.get("commonest") for entry in raised.value.report}
    assert shown["in_range(loc_x)"] == [("500.0", 2), ("501.0", 2)] and shown["not_null(period)"] is None


def test_bad_matches_are_not_published(spark, nightly, lake):
    nightly(1, 2)
    strict = replace(lake, match_checks=(NotNull("home_score"),))
    with pytest.raises(QualityGateError, match=r"not_null\(home_score\)"):
        run(spark, strict, _with_open_match(spark, lake))
    assert read_table(spark, lake.path("trusted/matches")).count() == 2


def _with_open_match(spark, lake):
    source = Path(lake.root).parent / "site"
    (source / "matches/11/90.json").write_text('[{"match_id": 1}]')
    return FileFeed(str(source))


def test_landing_reads_nothing_back(spark, nightly, lake, monkeypatch):
    read = []
    for module in (medallion, feeds):
        whole = module.read_table_or_empty
        monkeypatch.setattr(
            module, "read_table_or_empty", lambda s, path, schema, f=whole: (read.append(path), f(s, path, schema))[1]
        )
    plain = tables.read_table
    monkeypatch.setattr(medallion, "read_table", lambda s, path: (read.append(path), plain(s, path))[1])
    metrics = nightly(1, 2, groups={"ingestion"})
    assert metrics["events_raw"]["ingested"] == "2" and metrics["matches_raw"]["match_count"] == "2"
    assert not [path for path in read if "raw/events" in path or "raw/competitions" in path]


# --- Tallies -------------------------------------------------------------------------


@pytest.mark.parametrize("observed", [True, False])
def test_added_tallies_are_the_report_of_all_rows(spark, observed):
    rows = [(i % 3, None if i % 7 == 0 else float(i % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "g INT, x DOUBLE")
    checks = [NotNull("x"), InRange("x", 1, 9, mostly=0.5), medallion.AtLeastRows(60)]
    pieces = [df.where("x < 5"), df.where("x >= 5 OR x IS NULL")]
    if observed:
        taken = [ObservedTally(piece, checks, ["g"], [(0,), (1,), (2,), (9,)]) for piece in pieces]
        for one in taken:
            one.rows.write.format("noop").mode("overwrite").save()
        entries = [entry for one in taken for entry in one.entries()]
        found = spark.createDataFrame(entries, f"g INT, {medallion.published.TALLY}")
    else:
        found = tally(pieces[0], checks, ["g"]).unionByName(tally(pieces[1], checks, ["g"]))
    expected = check(df, checks, ["g"])
    assert sorted(judge(found, checks, ["g"]).collect()) == sorted(expected.collect())


# --- Versions ------------------------------------------------------------------------


def values(df) -> list:
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("by", [(), ("p",)])
def test_a_reader_sees_the_table_before_or_after_a_change(spark, tmp_path, monkeypatch, by):
    """The table is read before each step that the writer makes in the file system."""
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, p STRING")
    new = spark.createDataFrame([(3, "a"), (4, "c")], "k INT, p STRING")
    write = (lambda df: replace_partitions(df, path, list(by))) if by else (lambda df: replace_table(df, path))
    write(old)
    after = [(2, "b"), (3, "a"), (4, "c")] if by else [(3, "a"), (4, "c")]
    seen, plain = [], versions.located

    def probing(session, place):
        monkeypatch.setattr(versions, "located", plain)
        seen.append(values(read_table(spark, path)))
        monkeypatch.setattr(versions, "located", probing)
        return plain(session, place)

    monkeypatch.setattr(versions, "located", probing)
    write(new)
    monkeypatch.undo()
    assert len(seen) >= 5 and seen[0] == values(old) and values(read_table(spark, path)) == after
    assert all(rows in (values(old), after) for rows in seen)


def test_a_snapshot_stays_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    before = read_table(spark, path)
    replace_table(spark.range(5), path)
    assert before.count() == 3 and read_table(spark, path).count() == 5


def test_old_versions_go_with_their_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(12):
        replace_table(spark.range(n), path)
    assert len(list((tmp_path / "t").glob("_part=*"))) == versions.KEEP_VERSIONS
    now = versions.current_version(spark, path)
    assert now.number == 12 and read_table(spark, path).count() == 11
    versions.forget_versions(spark, path, keep=1)
    assert len(list((tmp_path / "t").glob("_part=*"))) == 1
    assert read_table(spark, path).count() == 11


def test_the_second_of_two_writers_is_told_or_tries_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a")], "k INT, p STRING")
    replace_partitions(rows, path, ["p"])
    base = versions.current_version(spark, path)
    replace_partitions(rows.withColumn("p", F.lit("b")), path, ["p"])
    with pytest.raises(versions.ConcurrentWriteError):
        versions.commit(spark, path, base)
    calls = []

    def make(version):
        calls.append(version.number)
        if len(calls) == 1:
            append_rows(rows.withColumn("p", F.lit("c")), path)
        return version.without({"p=a"})

    versions.change(spark, path, base, make)
    assert calls == [2, 3]
    assert values(read_table(spark, path)) == [(1, "b"), (1, "c")]


def test_partitions_of_any_name_and_emptied_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a b/c=d%"), (2, None), (3, "[x]*")], "k INT, p STRING")
    replace_partitions(rows, path, ["p"])
    assert sorted(map(str, values(read_table(spark, path)))) == sorted(map(str, values(rows)))
    emptied = [partition for partition, _ in versions.current_version(spark, path).live]
    replace_partitions(rows.limit(0), path, ["p"], emptied)
    left = read_table(spark, path)
    assert left.count() == 0 and left.schema == rows.schema
    assert exists(spark, path)


def test_raw_text_is_staged_in_splits_of_bounded_size(spark, nightly, lake, monkeypatch):
    sizes, plain = [], medallion.published.write_part
    monkeypatch.setattr(
        medallion.published, "write_part", lambda df, *a: (sizes.append(spark.conf.get("spark.sql.files.maxPartitionBytes")), plain(df, *a))[1]
    )
    nightly(1, 2)
    assert sizes == [medallion.published.RAW_SPLIT]
