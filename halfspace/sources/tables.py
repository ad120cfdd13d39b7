"""Columnar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from halfspace.sinks import exists
from halfspace.sinks.versions import current_version, read_version


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; columns and filters of the query reach the scan.

    A table with versions is read as its newest one, which is looked up here, once.
    """
    now = current_version(spark, path)
    return read_version(spark, path, now) if now else spark.read.parquet(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where none was written yet.

    Only a missing path counts as empty. Any other storage error is raised, so a table
    that cannot be read is not taken for one that has nothing in it.
    """
    now = current_version(spark, path)
    if now:
        return read_version(spark, path, now, schema)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
