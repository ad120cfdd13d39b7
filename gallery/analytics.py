"""Group, top-k, grid and share operators on driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gallery.registry import PLACES, exact, query, table
from halfspace.operators import (
    density,
    drop_incomplete,
    first_listed,
    means_by,
    only_listed,
    points_by,
    share_of_total,
    top_groups,
    top_rows,
    total_and_mean_by,
)


@query("""
    select event_type, count(*) as total,
           round(cast(100 as double) * count(*) / sum(count(*)) over (), 2) as pct
    from events group by event_type
""")
def ratio_to_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_of_total(table(spark, sf_dir, "events"), "event_type")


@query(f"""
    select l_suppkey,
           cast(sum(case when l_discount > l_tax then 3
                         when l_discount = l_tax then 1 else 0 end) as bigint) as points,
           {exact("l_discount")} as scored,
           {exact("l_tax")} as conceded
    from lineitem group by l_suppkey
""")
def standings_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return points_by(lineitem, "l_suppkey", "l_discount", "l_tax", places=PLACES)


@query(f"""
    select user_id, count(*) as n,
           round({exact("value")}, 2) as total,
           round({exact("value")} / count(value), 4) as mean
    from events where event_type = 'purchase' group by user_id
""")
def group_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return total_and_mean_by(purchases, "user_id", "value", PLACES)


@query("""
    select event_id, user_id, event_type, value
    from events where event_type = 'purchase' and value is not null
    order by value desc, event_id limit 50
""")
def shot_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    columns = ["event_id", "user_id", "event_type", "value"]
    return top_rows(purchases, "value", 50, columns, ["event_id"])


@query("""
    select grid_x, grid_y, count(*) as n
    from (select cast(floor(l_quantity / 10) as int) as grid_x,
                 cast(floor(l_discount / cast(0.02 as double)) as int) as grid_y
          from lineitem)
    where grid_x is not null and grid_y is not null group by grid_x, grid_y
""")
def grid_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(table(spark, sf_dir, "lineitem"), ("l_quantity", 10), ("l_discount", 0.02))


@query(f"""
    select l_suppkey, count(*) as n,
           round({exact("l_quantity")} / count(l_quantity), 1) as avg_quantity,
           round({exact("l_discount")} / count(l_discount), 3) as avg_discount
    from lineitem where l_quantity is not null group by l_suppkey
""")
def group_two_avgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = table(spark, sf_dir, "lineitem").where(F.col("l_quantity").isNotNull())
    means = {"avg_quantity": ("l_quantity", 1), "avg_discount": ("l_discount", 3)}
    return means_by(sold, "l_suppkey", "n", means, PLACES)


@query(f"""
    select user_id, event_type, count(*) as n,
           round({exact("value")} / count(value), 1) as avg_value
    from events where event_type = 'error' and value > 10
    group by user_id, event_type
    order by n desc, user_id, event_type limit 20
""")
def threshold_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "events").where(
        (F.col("event_type") == "error") & (F.col("value") > 10)
    )
    means = {"avg_value": ("value", 1)}
    return top_groups(errors, ["user_id", "event_type"], "n", means, 20, PLACES)


@query("""
    select l_returnflag, count(*) as n
    from (select l_returnflag, nullif(l_discount, 0) as discount, l_tax from lineitem)
    where discount is not null and l_tax is not null group by l_returnflag
""")
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.nullif("l_discount", F.lit(0.0)).alias("discount"), "l_tax"
    )
    complete = drop_incomplete(lineitem, ["discount", "l_tax"])
    return complete.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("""
    select event_id, user_id, event_type, value from events
    where user_id in (select distinct user_id from events order by 1 limit 5)
""")
def sample_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return only_listed(events, first_listed(events, "user_id", 5), ["user_id"])
