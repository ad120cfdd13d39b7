"""Quality checks on driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gallery.registry import query, table
from halfspace.operators import (
    AtLeastRows,
    InRange,
    NotNull,
    Referenced,
    Unique,
    check,
    check_suite,
    gate,
)


def report(name: str, column: str, judged: str, bad: str, mostly: float, source: str) -> str:
    """SQL for one row of a check report."""
    return f"""
        select '{name}' as "check", '{column}' as "column", "rows", judged as nonnull,
               bad as unexpected, cast(100 as double) * bad / nullif(judged, 0) as unexpected_pct,
               cast({mostly} as double) as mostly,
               coalesce(cast(judged - bad as double) / nullif(judged, 0) >= {mostly}, true)
                   as success
        from (select count(*) as "rows", {judged} as judged, {bad} as bad from {source})
    """


def not_null_sql(column: str, source: str) -> str:
    bad = f"count(*) filter (where {column} is null)"
    return report(f"not_null({column})", column, "count(*)", bad, 1.0, source)


def in_range_sql(column: str, low: float, high: float, mostly: float, source: str) -> str:
    bad = f"count(*) filter (where not {column} between {low} and {high})"
    return report(f"in_range({column})", column, f"count({column})", bad, mostly, source)


def at_least_sql(rows: int, source: str) -> str:
    judged = f"cast(greatest(count(*), {rows}) as bigint)"
    bad = f"cast(greatest({rows} - count(*), 0) as bigint)"
    return report(f"at_least_rows({rows})", "*", judged, bad, 1.0, source)


# Discounts and taxes of zero stand in for missing values: the tables hold no NULLs.
GAPS = """(select l_orderkey, nullif(l_discount, 0) as discount, nullif(l_tax, 0) as tax
           from lineitem)"""


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
    )


@query(
    not_null_sql("l_orderkey", GAPS)
    + " union all "
    + not_null_sql("discount", GAPS)
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(_with_gaps(spark, sf_dir), [NotNull("l_orderkey"), NotNull("discount")])


@query(
    in_range_sql("discount", 0.0, 0.05, 0.99, GAPS)
    + " union all "
    + in_range_sql("tax", 0.0, 0.08, 1.0, GAPS)
)
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [InRange("discount", 0.0, 0.05, mostly=0.99), InRange("tax", 0.0, 0.08)]
    return check(_with_gaps(spark, sf_dir), checks)


@query(
    " union all ".join(
        [
            at_least_sql(1, "events"),
            not_null_sql("event_id", "events"),
            not_null_sql("event_type", "events"),
            in_range_sql("value", 0.0, 100.0, 0.99, "events"),
            in_range_sql("user_id", 0.0, 1e12, 0.99, "events"),
        ]
    )
)
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(
        table(spark, sf_dir, "events"),
        [
            AtLeastRows(1),
            NotNull("event_id"),
            NotNull("event_type"),
            InRange("value", 0.0, 100.0, mostly=0.99),
            InRange("user_id", 0.0, 1e12, mostly=0.99),
        ],
    )


@query(
    " union all ".join(
        [
            at_least_sql(1, "events"),
            not_null_sql("event_id", "events"),
            in_range_sql("value", 0.0, 600.0, 0.99, "events"),
        ]
    )
)
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a batch that may pass; a failing batch raises instead."""
    checks = [AtLeastRows(1), NotNull("event_id"), InRange("value", 0.0, 600.0, mostly=0.99)]
    report = check(table(spark, sf_dir, "events"), checks)
    return spark.createDataFrame(gate(report), report.schema)


@query(
    " union all ".join(
        [
            not_null_sql("l_orderkey", "lineitem"),
            report(
                "unique(l_orderkey, l_linenumber)",
                "l_orderkey, l_linenumber",
                "count(*)",
                "count(*) filter (where n > 1)",
                1.0,
                "(select count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem)",
            ),
            report(
                "unique(l_partkey)",
                "l_partkey",
                "count(*)",
                "count(*) filter (where n > 1)",
                0.5,
                "(select count(*) over (partition by l_partkey) as n from lineitem)",
            ),
            report(
                "referenced(l_orderkey, open_orders.o_orderkey)",
                "l_orderkey",
                "count(*)",
                "count(*) filter (where not there)",
                0.9,
                """(select l_orderkey in (select o_orderkey from orders where o_orderstatus = 'O') as there
                    from lineitem)""",
            ),
            report(
                "referenced(l_suppkey, suppliers.s_suppkey)",
                "l_suppkey",
                "count(*)",
                "count(*) filter (where not there)",
                1.0,
                "(select l_suppkey in (select s_suppkey from supplier) as there from lineitem)",
            ),
        ]
    )
)
def dq_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of rows and of keys in one suite: repeated keys, and keys that no row has."""
    checks = [
        NotNull("l_orderkey"),
        Unique(("l_orderkey", "l_linenumber")),
        Unique(("l_partkey",), mostly=0.5),
        Referenced("l_orderkey", "open_orders", "o_orderkey", mostly=0.9),
        Referenced("l_suppkey", "suppliers", "s_suppkey"),
    ]
    tables = {
        "open_orders": table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O"),
        "suppliers": table(spark, sf_dir, "supplier"),
    }
    return check_suite(table(spark, sf_dir, "lineitem"), checks, tables=tables)


@query("""
    with bad as (
        select 'in_range(l_discount)' as "check", l_returnflag, cast(l_discount as varchar) as value
        from lineitem where not l_discount between 0.02 and 0.07
        union all
        select 'in_range(l_quantity)', l_returnflag, cast(l_quantity as varchar)
        from lineitem where l_quantity > 45
        union all
        select 'not_null(tax)', l_returnflag, null from lineitem where l_tax = 0
    )
    select l_returnflag, "check", value, count(*) as n from bad group by all
""")
def dq_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest bad values of each check, from the aggregate that makes the report."""
    lines = table(spark, sf_dir, "lineitem").withColumn("tax", F.nullif("l_tax", F.lit(0.0)))
    checks = [InRange("l_discount", 0.02, 0.07), InRange("l_quantity", 0, 45), NotNull("tax")]
    found = check(lines, checks, by=["l_returnflag"], commonest=50)
    return found.select("l_returnflag", "check", F.inline("commonest"))
