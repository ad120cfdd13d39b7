"""Raw documents and stored objects made from driver tables, and read back.

Files are written by Spark, many rows to a file and one document to a line, so no
group of documents is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gallery.registry import query, table
from halfspace.formats import CHECKED_EVENT, RAW_EVENT, RAW_MATCH, TRUSTED_EVENT, TRUSTED_MATCH
from halfspace.functions import at_path, parse_json, safe_number
from halfspace.operators import flatten
from halfspace.plans import checked_events, trusted_events, trusted_matches
from halfspace.sinks import replace_table, write_named_arrays, write_objects
from halfspace.sources import list_objects, read_bytes, read_table, read_texts, read_texts_below, scan_documents
from halfspace.streaming import land_new_files
from halfspace.workspace import fresh_dir, setting


def _named(name: Column) -> Column:
    return F.struct(name.alias("name"))


def _event_fields() -> list[Column]:
    """Fields of an event document; a field that is NULL is absent from the document.

    Sign-ups have no player and no location, views only half a location, clicks are
    passes and purchases are shots.
    """
    kind, value = F.col("event_type"), F.col("value")
    user = F.col("user_id").cast("int")
    label = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    location = (
        F.when(kind == "signup", None)
        .when(kind == "view", F.array(value))
        .otherwise(F.array(value, value / F.lit(4.0)))
    )
    return [
        F.col("event_id").cast("string").alias("id"),
        user.alias("index"),
        F.length("event_type").alias("period"),
        F.minute("ts").alias("minute"),
        F.second("ts").alias("second"),
        F.substring(F.col("ts").cast("string"), 12, 8).alias("timestamp"),
        _named(kind).alias("type"),
        user.alias("possession"),
        _named(label).alias("possession_team"),
        _named(F.col("props")).alias("play_pattern"),
        F.struct(user.alias("id"), label.alias("name")).alias("team"),
        F.when(kind != "signup", F.struct(user.alias("id"), label.alias("name"))).alias("player"),
        location.alias("location"),
        value.alias("duration"),
    ]


def _shot_field() -> Column:
    outcome = _named(F.when(F.col("value") > 50, "big").otherwise("small")).alias("outcome")
    shot = F.struct(F.col("value").alias("statsbomb_xg"), outcome)
    return F.when(F.col("event_type") == "purchase", shot).alias("shot")


def _pass_field() -> Column:
    play = F.struct(F.col("value").alias("length"), (-F.col("value")).alias("angle"))
    return F.when(F.col("event_type") == "click", play).alias("pass")


def _event_payloads(events: DataFrame) -> DataFrame:
    fields = [*_event_fields(), _shot_field(), _pass_field()]
    return events.select(F.to_json(F.struct(*fields)).alias("payload"))


EVENT_SQL = """
    select cast(event_id as varchar) as event_id,
           cast(user_id as int) as event_index,
           cast(length(event_type) as int) as period,
           cast(minute(ts) as int) as minute,
           cast(second(ts) as int) as second,
           strftime(ts, '%H:%M:%S') as timestamp,
           event_type,
           cast(user_id as int) as possession,
           'user ' || user_id as possession_team,
           props as play_pattern,
           cast(user_id as int) as team_id,
           'user ' || user_id as team_name,
           case when event_type <> 'signup' then cast(user_id as int) end as player_id,
           case when event_type <> 'signup' then 'user ' || user_id end as player_name,
           cast(null as varchar) as position_name,
           case when event_type <> 'signup' then value end as loc_x,
           case when event_type not in ('signup', 'view') then value / 4 end as loc_y,
           value as duration_s,
           case when event_type = 'purchase' then value end as xg,
           case when event_type = 'purchase'
                then case when value > 50 then 'big' else 'small' end end as shot_outcome,
           case when event_type = 'click' then value end as pass_length,
           case when event_type = 'click' then -value end as pass_angle_rad,
           cast(null as varchar) as pass_outcome
    from events
"""


@query(EVENT_SQL)
def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_events(_event_payloads(table(spark, sf_dir, "events")))


@query(f"select {', '.join(CHECKED_EVENT)} from ({EVENT_SQL})")
def flatten_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_events(_event_payloads(table(spark, sf_dir, "events")))


@query(EVENT_SQL)
def json_scan_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with different fields, read as one table by field name."""
    events = table(spark, sf_dir, "events")
    root = fresh_dir(spark, "scan")
    is_shot = F.col("event_type") == "purchase"
    shots = events.where(is_shot).select(*_event_fields(), _shot_field())
    others = events.where(~is_shot).select(*_event_fields(), _pass_field())
    shots.write.json(f"{root}/shots")
    others.write.json(f"{root}/others")
    paths = [f"{root}/shots", f"{root}/others"]
    return flatten(scan_documents(spark, paths, RAW_EVENT, array_files=False), TRUSTED_EVENT)


# Elements of one array file: a few megabytes, as much as a match file holds.
ARRAY_SIZE = 10_000


def _write_array_files(payloads: DataFrame, path: str) -> None:
    """Write documents as files of one JSON array each.

    Rows are grouped by their place in their task, so an array never holds more than
    ``ARRAY_SIZE`` of them, whatever the data.
    """
    chunk = F.floor(F.monotonically_increasing_id() / F.lit(ARRAY_SIZE))
    arrays = payloads.groupBy(chunk.alias("chunk")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("payload"), ","), F.lit("]")).alias("text")
    )
    arrays.select("text").write.option("maxRecordsPerFile", 1).text(path)


@query(EVENT_SQL)
def json_scan_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one JSON array each, read as one table."""
    path = fresh_dir(spark, "scan")
    _write_array_files(_event_payloads(table(spark, sf_dir, "events")), path)
    return flatten(scan_documents(spark, path, RAW_EVENT), TRUSTED_EVENT)


@query(EVENT_SQL)
def json_scan_array_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files with different fields, read as one table by field name."""
    events = table(spark, sf_dir, "events")
    root = fresh_dir(spark, "scan")
    is_shot = F.col("event_type") == "purchase"
    for name, rows, field in (
        ("shots", events.where(is_shot), _shot_field()),
        ("others", events.where(~is_shot), _pass_field()),
    ):
        document = F.to_json(F.struct(*_event_fields(), field)).alias("payload")
        _write_array_files(rows.select(document), f"{root}/{name}")
    paths = [f"{root}/shots", f"{root}/others"]
    return flatten(scan_documents(spark, paths, RAW_EVENT), TRUSTED_EVENT)


@query(EVENT_SQL)
def landing_stream_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files landed element by element by a stream, then flattened."""
    root = fresh_dir(spark, "stream")
    _write_array_files(_event_payloads(table(spark, sf_dir, "events")), f"{root}/source")
    land_new_files(spark, f"{root}/source", f"{root}/raw", f"{root}/checkpoint")
    return trusted_events(read_table(spark, f"{root}/raw"))


def _match_fields() -> list[Column]:
    """Fields of a match document, one per supplier."""
    key, nation = F.col("s_suppkey").cast("int"), F.col("s_nationkey")
    return [
        key.alias("match_id"),
        F.date_add(F.lit("2020-09-01").cast("date"), nation).alias("match_date"),
        F.substring("s_name", 1, 8).alias("kick_off"),
        F.struct(F.col("s_name").alias("home_team_name")).alias("home_team"),
        F.struct(nation.cast("string").alias("away_team_name")).alias("away_team"),
        F.floor(F.col("s_acctbal") / F.lit(1000.0)).cast("int").alias("home_score"),
        F.when(F.col("s_acctbal") > 0, nation).alias("away_score"),
        nation.alias("match_week"),
        F.struct(F.lit("cup").alias("competition_name")).alias("competition"),
        F.struct(F.lit("2020").alias("season_name")).alias("season"),
        F.when(F.col("s_acctbal") > 0, _named(F.col("s_name"))).alias("stadium"),
    ]


MATCH_SQL = """
    select cast(s_suppkey as int) as match_id,
           cast(date '2020-09-01' + s_nationkey as date) as match_date,
           substring(s_name, 1, 8) as kick_off,
           s_name as home_team,
           cast(s_nationkey as varchar) as away_team,
           cast(floor(s_acctbal / 1000) as int) as home_score,
           case when s_acctbal > 0 then s_nationkey end as away_score,
           s_nationkey as match_week,
           'cup' as competition_name,
           '2020' as season_name,
           case when s_acctbal > 0 then s_name end as stadium_name,
           cast(null as varchar) as referee
    from supplier
"""


@query(MATCH_SQL)
def flatten_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    return trusted_matches(suppliers.select(F.to_json(F.struct(*_match_fields())).alias("payload")))


@query(MATCH_SQL)
def json_scan_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "scan")
    table(spark, sf_dir, "supplier").select(*_match_fields()).write.json(path)
    return flatten(scan_documents(spark, path, RAW_MATCH, array_files=False), TRUSTED_MATCH)


@query(MATCH_SQL)
def json_scan_one_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array file, as a season's match list is."""
    root = fresh_dir(spark, "scan")
    document = F.to_json(F.struct(*_match_fields())).alias("payload")
    listed = table(spark, sf_dir, "supplier").select(
        F.lit("list").alias("name"), F.col("s_suppkey").alias("pos"), document
    )
    write_named_arrays(listed, root)
    return flatten(scan_documents(spark, f"{root}/list.json", RAW_MATCH), TRUSTED_MATCH)


@query("select o_orderkey, o_custkey, o_orderstatus, o_clerk_note from (select *, 'clerk}\"' || o_custkey as o_clerk_note from orders)")
def json_scan_split_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array file of all orders, read by as many tasks as it has splits."""
    root = fresh_dir(spark, "scan")
    note = F.concat(F.lit('clerk}"'), "o_custkey").alias("o_clerk_note")
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", note]
    document = F.to_json(F.struct(*fields)).alias("payload")
    listed = table(spark, sf_dir, "orders").select(F.lit("orders").alias("name"), F.col("o_orderkey").alias("pos"), document)
    write_named_arrays(listed, root)
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_clerk_note STRING"
    with setting(spark, "spark.sql.files.maxPartitionBytes", "2m"):
        return scan_documents(spark, f"{root}/orders.json", schema, splittable=True)


@query("""
    select vec_id, cast(embedding[1] as double) as first, cast(embedding[2] as double) as second,
           cast(embedding[65] as double) as past_the_end
    from embeddings
""")
def array_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (
        ("first", "double", "embedding[1]"),
        ("second", "double", "embedding[2]"),
        ("past_the_end", "double", "embedding[65]"),
    )
    return flatten(table(spark, sf_dir, "embeddings"), columns, keep=["vec_id"])


@query("""
    select event_id, try_cast(props as double) as from_text,
           try_cast(json_extract_string(props, '$.k') as double) as from_number
    from events
""")
def try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "props", parse_json("props", "k STRING").alias("doc")
    )
    return events.select(
        "event_id",
        safe_number(F.col("props")).alias("from_text"),
        safe_number(at_path("doc.k")).alias("from_number"),
    )


@query("select * from orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "table")
    replace_table(table(spark, sf_dir, "orders"), path)
    return read_table(spark, path)


@query("select conv_id, turn, role, text from conversations")
def raw_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stored as text objects of bounded size, each then read whole."""
    path = fresh_dir(spark, "objects")
    columns = ["conv_id", "turn", "role", "text"]
    payload = F.to_json(F.struct(*columns)).alias("payload")
    table(spark, sf_dir, "conversations").select(payload).write.option(
        "maxRecordsPerFile", 5_000
    ).text(path)
    lines = (
        read_texts(spark, path)
        .select(F.explode(F.split("payload", "\n")).alias("line"))
        .where(F.col("line") != "")
    )
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    return lines.select(parse_json("line", schema).alias("doc")).select("doc.*")


@query("""
    select 'c' || (c_custkey % 10) || '/' || c_custkey || '.txt' as name,
           c_name || chr(10) || c_mktsegment as text
    from customer
""")
def object_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object for each row under its own name, written by the tasks and read back whole."""
    root, key = fresh_dir(spark, "objects"), F.col("c_custkey")
    name = F.concat(F.lit("c"), key % 10, F.lit("/"), key, F.lit(".txt")).alias("name")
    text = F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("content")
    write_objects(table(spark, sf_dir, "customer").select(name, text), root)
    found = read_texts_below(spark, root)
    return found.select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("name"), F.col("payload").alias("text"))


@query("""
    select cast(sum(octet_length(encode(text)) + 1) as bigint) as bytes from documents
""")
def object_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stored as objects of bounded size, each then read as bytes."""
    path = fresh_dir(spark, "objects")
    table(spark, sf_dir, "documents").select("text").write.option("maxRecordsPerFile", 500).text(
        path
    )
    return read_bytes(spark, path).agg(F.sum(F.octet_length("content")).alias("bytes"))


@query("""
    select lang, source, cast(sum(octet_length(encode(text)) + 1) as bigint) as bytes
    from documents group by lang, source
""")
def landed_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and sizes of the objects below a folder, from a listing that opens none of them."""
    path = fresh_dir(spark, "objects")
    table(spark, sf_dir, "documents").select("lang", "source", "text").write.partitionBy(
        "lang", "source"
    ).text(path)
    key = [
        F.regexp_extract("path", f"/{name}=([^/]*)/", 1).alias(name)
        for name in ("lang", "source")
    ]
    listed = list_objects(spark, path, "*.txt").select(*key, "length")
    return listed.groupBy("lang", "source").agg(F.sum("length").alias("bytes"))
