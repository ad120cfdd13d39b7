"""Medallion runs over documents made from driver tables: a supplier is a match, and
its line items are the match's events.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gallery.checks import at_least_sql, in_range_sql, not_null_sql
from gallery.registry import exact, query, table
from halfspace.operators import check
from halfspace.plans import (
    Lake,
    checked_batch,
    event_mix,
    fit_xg,
    home_standings,
    pass_density,
    run,
    shot_map,
    team_passing,
    team_xg,
    top_pressers,
    with_model_xg,
    xg_gradient,
)
from halfspace.plans.medallion import land_matches, publish_matches
from halfspace.sinks import write_named_arrays
from halfspace.sinks.versions import current_version
from halfspace.sources import FileFeed, TableFeed, read_table
from halfspace.streaming import land_event_files
from halfspace.workspace import fresh_dir

COMPETITION = 11
# Suppliers of the first nations play in the first season, the others in the second.
SCOPES = ((COMPETITION, 1), (COMPETITION, 2))


def _numbered(prefix: str, key: Column, kinds: int) -> Column:
    return F.concat(F.lit(prefix), F.pmod(key, F.lit(kinds)).cast("string"))


def _document(*fields: Column) -> Column:
    return F.struct(*fields).alias("document")


def _feed(spark: SparkSession, sf_dir: str) -> TableFeed:
    competitions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("pos"),
        _document(
            F.col("r_regionkey").alias("competition_id"), F.col("r_name").alias("competition_name")
        ),
    )
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    in_debt = F.col("s_acctbal") < 0
    season = F.when(nation < 12, 1).otherwise(2)
    matches = table(spark, sf_dir, "supplier").select(
        F.lit(COMPETITION).alias("competition_id"),
        season.alias("season_id"),
        (F.row_number().over(Window.partitionBy(season).orderBy(key)) - 1).alias("pos"),
        _document(
            key.cast("int").alias("match_id"),
            F.date_add(F.lit("2020-09-01").cast("date"), nation).alias("match_date"),
            F.struct(_numbered("team ", nation, 25).alias("home_team_name")).alias("home_team"),
            F.struct(_numbered("team ", key, 25).alias("away_team_name")).alias("away_team"),
            F.when(~in_debt, F.pmod(nation, F.lit(4))).alias("home_score"),
            F.when(~in_debt, F.pmod(key, F.lit(3)).cast("int")).alias("away_score"),
        ),
    )
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    kind = F.when(flag == "A", "Shot").when(flag == "N", "Pass").otherwise("Pressure")
    location = F.array(F.col("l_quantity") * F.lit(2.0), F.col("l_discount") * F.lit(800.0))
    shot = F.struct(
        F.nullif("l_tax", F.lit(0.0)).alias("statsbomb_xg"),
        F.struct(F.col("l_linestatus").alias("name")).alias("outcome"),
    )
    play = F.struct(
        F.nullif("l_quantity", F.lit(1.0)).alias("length"), F.col("l_discount").alias("angle")
    )
    events = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("match_id"),
        line.alias("pos"),
        _document(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
            line.alias("index"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("period"),
            F.struct(kind.alias("name")).alias("type"),
            F.struct(_numbered("team ", F.col("l_partkey"), 20).alias("name")).alias("team"),
            F.struct(_numbered("player ", F.col("l_partkey"), 500).alias("name")).alias("player"),
            F.when(F.col("l_tax") > 0, location).alias("location"),
            F.when(flag == "A", shot).alias("shot"),
            F.when(flag == "N", play).alias("pass"),
        ),
    )
    return TableFeed(competitions, matches, events)


def _file_feed(spark: SparkSession, sf_dir: str, numbered: int | None = None) -> FileFeed:
    """The same documents as array files: the catalog, a list per season, events per match.

    With ``numbered``, a match's events are in files of at most so many.
    """
    feed, root = _feed(spark, sf_dir), fresh_dir(spark, "source")
    payload = F.to_json("document").alias("payload")
    write_named_arrays(
        feed.competitions.select(F.lit("competitions").alias("name"), "pos", payload), root
    )
    season = F.col("season_id").cast("string").alias("name")
    write_named_arrays(feed.matches.select(season, "pos", payload), f"{root}/matches/{COMPETITION}")
    # A source has a file for each listed match, an empty array if nothing happened.
    keys = feed.matches.select(F.col("document.match_id").cast("string").alias("name"))
    events = feed.documents.select(F.col("match_id").cast("string").alias("name"), "pos", payload)
    write_named_arrays(keys.join(events, "name", "left"), f"{root}/events", numbered)
    return FileFeed(root, batch=256, numbered=numbered)


MATCHES_SQL = """
    with matches as (
        select 'team ' || (s_nationkey % 25) as home_team,
               case when s_acctbal >= 0 then s_nationkey % 4 end as home_score,
               case when s_acctbal >= 0 then cast(s_suppkey % 3 as int) end as away_score
        from supplier
    )
"""

EVENTS_SQL = """
    with trusted as (
        select l_suppkey as match_id,
               case l_returnflag when 'A' then 'Shot' when 'N' then 'Pass' else 'Pressure' end
                   as event_type,
               'team ' || (l_partkey % 20) as team_name,
               'player ' || (l_partkey % 500) as player_name,
               case when l_tax > 0 then l_quantity * cast(2 as double) end as loc_x,
               case when l_tax > 0 then l_discount * cast(800 as double) end as loc_y,
               case when l_returnflag = 'A' then nullif(l_tax, 0) end as xg,
               case when l_returnflag = 'A' then l_linestatus end as shot_outcome,
               case when l_returnflag = 'N' then nullif(l_quantity, 1) end as pass_length,
               case when l_returnflag = 'N' then l_discount end as pass_angle_rad
        from lineitem where l_suppkey in (select s_suppkey from supplier)
    )
"""


# The whole trusted event table. What the documents don't carry is NULL.
TRUSTED_SQL = """
    with played as (
        select l.*, case when s_nationkey < 12 then 1 else 2 end as season_id,
               case when l_returnflag = 'A' then l_linestatus end as shot_outcome,
               case l_returnflag when 'A' then 'Shot' when 'N' then 'Pass' else 'Pressure' end
                   as event_type
        from lineitem l join supplier on l_suppkey = s_suppkey
    )
    select 11 as competition_id, season_id, cast(l_suppkey as int) as match_id,
           l_orderkey || '-' || l_linenumber as event_id,
           cast(l_linenumber as int) as event_index,
           case when l_linestatus = 'O' then 1 else 2 end as period,
           cast(null as int) as minute, cast(null as int) as second,
           cast(null as varchar) as timestamp, event_type,
           cast(null as int) as possession, cast(null as varchar) as possession_team,
           cast(null as varchar) as play_pattern,
           cast(null as int) as team_id, 'team ' || (l_partkey % 20) as team_name,
           cast(null as int) as player_id, 'player ' || (l_partkey % 500) as player_name,
           cast(null as varchar) as position_name,
           case when l_tax > 0 then l_quantity * cast(2 as double) end as loc_x,
           case when l_tax > 0 then l_discount * cast(800 as double) end as loc_y,
           cast(null as double) as duration_s,
           case when l_returnflag = 'A' then nullif(l_tax, 0) end as xg, shot_outcome,
           case when l_returnflag = 'N' then nullif(l_quantity, 1) end as pass_length,
           case when l_returnflag = 'N' then l_discount end as pass_angle_rad,
           cast(null as varchar) as pass_outcome
    from played
"""


# The seven queries over the trusted tables, here named `matches` and `trusted`.
# Each states its rule in the plainest SQL: points by CASE, cells grouped by their
# expressions, and the share by a window over the groups, which Spark's side avoids.
STANDINGS = """
    select home_team as team,
           cast(sum(case when home_score > away_score then 3
                         when home_score = away_score then 1 else 0 end) as bigint) as home_pts,
           cast(sum(home_score) as bigint) as home_gf,
           cast(sum(away_score) as bigint) as home_ga
    from matches group by home_team
"""
XG = f"""
    select team_name, count(*) as shots, round({exact("xg")}, 2) as total_xg,
           round({exact("xg")} / nullif(count(xg), 0), 4) as avg_xg_per_shot
    from trusted where event_type = 'Shot' group by team_name
"""
SHOTS = """
    select player_name, team_name, loc_x, loc_y, xg, shot_outcome
    from trusted where event_type = 'Shot' and xg is not null
    order by xg desc, player_name, team_name, loc_x, loc_y, shot_outcome limit 50
"""
PASS_GRID = """
    select cast(floor(loc_x / 10) as int) as grid_x, cast(floor(loc_y / 8) as int) as grid_y,
           count(*) as pass_count
    from trusted where event_type = 'Pass' and loc_x is not null and loc_y is not null
    group by floor(loc_x / 10), floor(loc_y / 8)
"""
PASSING = f"""
    select team_name, count(*) as passes,
           round({exact("pass_length")} / count(pass_length), 1) as avg_length_m,
           round({exact("pass_angle_rad")} / nullif(count(pass_angle_rad), 0), 3)
               as avg_angle_rad
    from trusted where event_type = 'Pass' and pass_length is not null group by team_name
"""
PRESSERS = f"""
    select player_name, team_name, count(*) as pressures,
           round({exact("loc_x")} / count(loc_x), 1) as avg_press_x,
           round({exact("loc_y")} / nullif(count(loc_y), 0), 1) as avg_press_y
    from trusted where event_type = 'Pressure' and loc_x > 60
    group by player_name, team_name
    order by pressures desc, player_name, team_name limit 20
"""
EVENT_MIX = """
    select event_type, count(*) as total,
           round(cast(100 as double) * count(*) / sum(count(*)) over (), 2) as pct
    from trusted group by event_type
"""


@query(EVENTS_SQL + EVENT_MIX)
def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, check and publish everything, then the event mix of the trusted table."""
    lake = Lake(fresh_dir(spark, "lake"), SCOPES)
    run(spark, lake, _feed(spark, sf_dir))
    return event_mix(read_table(spark, lake.path("trusted/events")))


@query(
    EVENTS_SQL
    + "select cast(match_id as int) as match_id, count(*) as n from trusted group by match_id"
)
def landing_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match list that grows by a season, landed run by run: each match lands once."""
    feed, root = _feed(spark, sf_dir), fresh_dir(spark, "lake")
    for scopes in (SCOPES[:1], SCOPES, SCOPES):
        run(spark, Lake(root, scopes), feed, groups={"ingestion"})
    raw = read_table(spark, Lake(root).path("raw/events"))
    return raw.where("payload IS NOT NULL").groupBy("match_id").agg(F.count("payload").alias("n"))


@query(TRUSTED_SQL)
def file_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files landed, checked and published: the whole trusted table."""
    lake = Lake(fresh_dir(spark, "lake"), SCOPES)
    run(spark, lake, _file_feed(spark, sf_dir))
    return read_table(spark, lake.path("trusted/events"))


@query("""
    select cast(s_suppkey as int) as match_id, count(l_suppkey) as n
    from supplier left join lineitem on l_suppkey = s_suppkey group by s_suppkey
""")
def file_landing_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered array files of a list that grows by a season, landed run by run, once each."""
    feed, root = _file_feed(spark, sf_dir, numbered=3), fresh_dir(spark, "lake")
    for scopes in (SCOPES[:1], SCOPES, SCOPES):
        run(spark, Lake(root, scopes), feed, groups={"ingestion"})
    raw = read_table(spark, Lake(root).path("raw/events"))
    return raw.groupBy("match_id").agg(F.count("payload").alias("n"))


@query("""
    with played as (
        select s_suppkey as match_id, case when s_nationkey < 12 then 1 else 2 end as season_id,
               s_suppkey = (select max(s_suppkey) from supplier) as last
        from supplier
    )
    select season_id, cast(count(distinct l_suppkey) as bigint) as matches, count(l_suppkey) as events,
           cast(count(distinct last) filter (where l_suppkey is not null) as bigint) as parts,
           cast(2 as bigint) as versions
    from played left join lineitem on l_suppkey = match_id group by season_id
""")
def medallion_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three nightly runs: all matches but one, that one as well, and nothing new.

    The second run's part holds the new match alone, and the third makes no version.
    """
    feed, lake = _feed(spark, sf_dir), Lake(fresh_dir(spark, "lake"), SCOPES)
    key = F.col("document.match_id")
    last = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey").cast("int")).first()[0]
    for given in (replace(feed, matches=feed.matches.where(key < last)), feed, feed):
        run(spark, lake, given)
    path = lake.path("trusted/events")
    part = F.regexp_extract(F.input_file_name(), "_part=([^/]+)", 1)
    events = read_table(spark, path).select("season_id", "match_id", part.alias("part"))
    return events.groupBy("season_id").agg(
        F.count_distinct("match_id").alias("matches"),
        F.count("*").alias("events"),
        F.count_distinct("part").alias("parts"),
        F.lit(current_version(spark, path).number).cast("bigint").alias("versions"),
    )


@query("""
    select case when s_nationkey < 12 then 1 else 2 end as season_id,
           cast(s_suppkey as int) as match_id, count(*) as events
    from supplier join lineitem on l_suppkey = s_suppkey group by all
""")
def stream_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files that arrive in two drops, landed by a stream, then checked and published."""
    feed, lake = _feed(spark, sf_dir), Lake(fresh_dir(spark, "lake"), SCOPES)
    source, checkpoint = fresh_dir(spark, "drops"), fresh_dir(spark, "checkpoint")
    payload = F.to_json("document").alias("payload")
    keys = feed.matches.select(F.col("document.match_id").cast("string").alias("name"))
    events = feed.documents.select(F.col("match_id").cast("string").alias("name"), "pos", payload)
    files = keys.join(events, "name", "left")
    early = F.col("name").cast("int") % 3 > 0
    for drop in (files.where(early), files.where(~early)):
        write_named_arrays(drop, source)
        land_event_files(spark, lake, source, checkpoint, files_per_batch=500)
    land_matches(spark, lake, feed)
    run(spark, lake, feed, groups={"validation", "transformation"})
    events = read_table(spark, lake.path("trusted/events"))
    return events.groupBy("season_id", "match_id").agg(F.count("*").alias("events"))


@query("""
    select 11 as competition_id, 1 as season_id, count(*) as matches
    from supplier where s_nationkey < 12
""")
def matches_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match lists published, then one of them emptied: its season leaves the table."""
    feed, lake = _feed(spark, sf_dir), Lake(fresh_dir(spark, "lake"), SCOPES)
    emptied = replace(feed, matches=feed.matches.where(F.col("season_id") == 1))
    for given in (feed, emptied):
        land_matches(spark, lake, given)
        publish_matches(spark, lake)
    matches = read_table(spark, lake.path("trusted/matches"))
    return matches.groupBy("competition_id", "season_id").agg(F.count("*").alias("matches"))


def _newton_sql(rounds: int) -> str:
    """Logistic regression by Newton's method, a round for each pair of subqueries."""
    steps = ["fit0 as (select cast(0 as double) as a, cast(0 as double) as b, cast(0 as double) as c)"]
    for i in range(rounds):
        steps.append(f"""sums{i} as (
            select any_value(a) as a, any_value(b) as b, any_value(c) as c,
                   sum(goal - p) as g0, sum((goal - p) * distance) as g1, sum((goal - p) * angle) as g2,
                   sum(w) as h00, sum(w * distance) as h01, sum(w * angle) as h02,
                   sum(w * distance * distance) as h11, sum(w * distance * angle) as h12,
                   sum(w * angle * angle) as h22
            from (select *, p * (1 - p) as w
                  from (select *, 1 / (1 + exp(-(a + b * distance + c * angle))) as p from shots, fit{i})))""")
        # Cramer's rule on the symmetric matrix of three rows.
        steps.append(f"""fit{i + 1} as (
            select a + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / d as a,
                   b + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / d as b,
                   c + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / d as c
            from (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02)
                            + h02 * (h01 * h12 - h11 * h02) as d from sums{i}))""")
    return ", ".join(steps)


XG_SHOTS = EVENTS_SQL + """
    , shots as (
        select team_name, sqrt(power(120 - loc_x, 2) + power(40 - loc_y, 2)) as distance,
               abs(atan2(44 - loc_y, 120 - loc_x) - atan2(36 - loc_y, 120 - loc_x)) as angle,
               case when shot_outcome = 'F' then 1.0::double else 0 end as goal
        from trusted where event_type = 'Shot' and loc_x is not null and loc_y is not null
    ), """ + _newton_sql(8)


@query(
    XG_SHOTS
    + """
    select 'intercept' as term, round(a, 3) as value from fit8
    union all select 'distance', round(b, 3) from fit8
    union all select 'angle', round(c, 3) from fit8
    union all select 'shots', cast(count(*) as double) from shots
    union all select 'goals', sum(goal) from shots
    union all select 'gradient', cast(0 as double)
    """
)
def xg_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model of expected goals over all shots; its gradient, the largest entry, is zero."""
    events = _trusted(spark, sf_dir, "events")
    model = fit_xg(events, goal="F")
    fixed = [(name, float(getattr(model, name))) for name in ("intercept", "distance", "angle", "shots", "goals")]
    terms = spark.createDataFrame(fixed, "term STRING, value DOUBLE")
    steepest = F.greatest(*[F.abs(name) for name in ("intercept", "distance", "angle")])
    gradient = xg_gradient(events, model, goal="F").select(F.lit("gradient").alias("term"), steepest.alias("value"))
    return terms.unionByName(gradient).select("term", F.round("value", 3).alias("value"))


@query(
    XG_SHOTS
    + """
    select team_name, count(*) as shots, cast(sum(goal) as bigint) as goals,
           round(sum(1 / (1 + exp(-(a + b * distance + c * angle)))), 2) as model_xg
    from shots, fit8 group by team_name
    """
)
def xg_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goals that the model expects of each team's shots, beside those it scored."""
    events = _trusted(spark, sf_dir, "events")
    shots = with_model_xg(events, fit_xg(events, goal="F")).where("model_xg IS NOT NULL")
    return shots.groupBy("team_name").agg(
        F.count("*").alias("shots"),
        F.count_if(F.col("shot_outcome") == "F").alias("goals"),
        F.round(F.sum("model_xg"), 2).alias("model_xg"),
    )


_published: dict[tuple[str, str], Lake] = {}


def published_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A published lake, made once per session."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _published:
        lake = Lake(fresh_dir(spark, "lake"), SCOPES)
        run(spark, lake, _feed(spark, sf_dir))
        _published[key] = lake
    return _published[key]


def _trusted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, published_lake(spark, sf_dir).path(f"trusted/{name}"))


@query("""
    with counted as (
        select (select count(*) from region) as competitions,
               (select count(*) from supplier) as matches,
               (select count(*) from lineitem where l_suppkey in (select s_suppkey from supplier))
                   as events
    )
    select 'competitions_raw' as stage, 'competition_count' as metric,
           cast(competitions as varchar) as value from counted
    union all select 'matches_raw', 'match_count', cast(matches as varchar) from counted
    union all select 'events_raw', 'ingested', cast(matches as varchar) from counted
    union all select 'events_raw', 'skipped_existing', '0'
    union all select 'events_raw', 'total_matches', cast(matches as varchar) from counted
    union all select 'events_validated', 'rows_validated', cast(events as varchar) from counted
    union all select 'events_validated', 'matches_sampled', cast(matches as varchar) from counted
    union all select 'competitions_raw', 'path', 'lake/raw/competitions'
    union all select 'matches_raw', 'path', 'lake/raw/matches'
    union all select 'matches_raw', 'scopes', '((11, 1), (11, 2))'
    union all select 'events_trusted', 'trusted_path', 'lake/trusted/events'
    union all select 'events_trusted', 'format', 'Parquet/ZSTD'
    union all select 'matches_trusted', 'trusted_path', 'lake/trusted/matches'
    union all select 'matches_trusted', 'format', 'Parquet/ZSTD'
""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages of a run left in its table; the lake's folder is called ``lake``."""
    lake = published_lake(spark, sf_dir)
    runs = read_table(spark, lake.path("runs"))
    metrics = runs.select("stage", F.explode("metrics").alias("metric", "text"))
    value = F.replace("text", F.lit(lake.root), F.lit("lake")).alias("value")
    return metrics.select("stage", "metric", value)


SAMPLED = """(select * from (
        select l_orderkey as event_id, l_linestatus as period,
               case when l_tax > 0 then l_quantity * cast(2 as double) end as loc_x,
               case when l_tax > 0 then l_discount * cast(800 as double) end as loc_y
        from lineitem where l_suppkey in
            (select s_suppkey from supplier
             qualify row_number() over (partition by s_nationkey < 12 order by s_suppkey) <= 5)))"""


@query(
    " union all ".join(
        [
            at_least_sql(1, SAMPLED),
            not_null_sql("event_id", SAMPLED),
            not_null_sql("period", SAMPLED),
            in_range_sql("loc_x", 0.0, 120.0, 0.99, SAMPLED),
            in_range_sql("loc_y", 0.0, 80.0, 0.99, SAMPLED),
        ]
    )
)
def dq_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a run on the first five matches of each of its lists."""
    lake = replace(published_lake(spark, sf_dir), sample_matches=5)
    batch = checked_batch(spark, lake, _trusted(spark, sf_dir, "events"))
    return check(batch, lake.checks)


@query(MATCHES_SQL + STANDINGS)
def football_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return home_standings(_trusted(spark, sf_dir, "matches"))


@query(EVENTS_SQL + XG)
def football_xg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_xg(_trusted(spark, sf_dir, "events"))


@query(EVENTS_SQL + SHOTS)
def football_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shot_map(_trusted(spark, sf_dir, "events"))


@query(EVENTS_SQL + PASS_GRID)
def football_pass_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pass_density(_trusted(spark, sf_dir, "events"))


@query(EVENTS_SQL + PASSING)
def football_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_passing(_trusted(spark, sf_dir, "events"))


@query(EVENTS_SQL + PRESSERS)
def football_pressers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_pressers(_trusted(spark, sf_dir, "events"))


@query(EVENTS_SQL + EVENT_MIX)
def football_event_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_mix(_trusted(spark, sf_dir, "events"))
