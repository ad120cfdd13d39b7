"""Landing operators on driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gallery.registry import query, table
from halfspace.functions import parse_json
from halfspace.operators import landing_counts, unlanded_keys
from halfspace.sinks import replace_partitions, replace_table
from halfspace.sources import read_table
from halfspace.streaming import land_new_files
from halfspace.workspace import fresh_dir


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    return pending.select(F.col("o_custkey").alias("key"))


@query("""
    select c_custkey as key from customer
    where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')
""")
def landing_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unlanded_keys(_listed(spark, sf_dir), _landed(spark, sf_dir), "key")


@query("""
    select count(*) filter (where key is null) as ingested,
           count(*) filter (where key is not null) as skipped,
           count(*) as total
    from customer left join
         (select distinct o_custkey as key from orders where o_orderstatus = 'P')
         on key = c_custkey
""")
def landing_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_counts(_listed(spark, sf_dir), _landed(spark, sf_dir), "key")


@query("""
    select o_orderstatus, count(*) as n,
           cast(count(*) filter (where o_orderstatus = 'P') as bigint) as rewritten
    from orders group by o_orderstatus
""")
def landing_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table landed whole, then one of its scopes again: that scope alone is replaced."""
    orders = table(spark, sf_dir, "orders")
    path = fresh_dir(spark, "table")
    by = ["o_orderstatus"]
    replace_partitions(orders.withColumn("rewritten", F.lit(False)), path, by)
    again = orders.where(F.col("o_orderstatus") == "P").withColumn("rewritten", F.lit(True))
    replace_partitions(again, path, by)
    return (
        read_table(spark, path)
        .groupBy(*by)
        .agg(F.count("*").alias("n"), F.count_if("rewritten").alias("rewritten"))
    )


@query("""
    select 'before' as seen, count(*) as n, cast(sum(o_custkey) as bigint) as total from orders
    union all
    select 'after', count(*), cast(sum(o_custkey) as bigint) from orders where o_orderstatus = 'P'
""")
def table_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced while it is read: the reader's snapshot stays whole."""
    orders, path = table(spark, sf_dir, "orders"), fresh_dir(spark, "table")
    replace_table(orders, path)
    before = read_table(spark, path)
    replace_table(orders.where(F.col("o_orderstatus") == "P"), path)
    seen = [
        rows.agg(F.lit(name).alias("seen"), F.count("*").alias("n"), F.sum("o_custkey").alias("total"))
        for name, rows in (("before", before), ("after", read_table(spark, path)))
    ]
    return seen[0].unionByName(seen[1])


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive in two drops, each landed once by the same stream."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    root = fresh_dir(spark, "stream")
    early = F.col("o_orderstatus") == "F"
    for name, drop in (("first", orders.where(early)), ("second", orders.where(~early))):
        drop.write.json(f"{root}/source/{name}")
        land_new_files(
            spark, f"{root}/source", f"{root}/raw", f"{root}/checkpoint", array_files=False
        )
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    landed = read_table(spark, f"{root}/raw")
    return landed.select(parse_json("payload", schema).alias("doc")).select("doc.*")
