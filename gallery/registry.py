"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from halfspace.sources import read_table

Query = Callable[[SparkSession, str], DataFrame]

# Decimal places with which the driver's doubles are summed.
PLACES = 4

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def exact(column: str) -> str:
    """SQL for the sum of a double column that does not depend on the row order."""
    return f"cast(sum(cast({column} as decimal(18,{PLACES}))) as double)"
