"""Key matching between a list of wanted documents and what has landed.

Both sides are reduced to distinct keys before they meet. That removes repeated keys
inside each task, and the join then runs on the partitioning the reduction made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unlanded_keys(wanted: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Distinct wanted keys that have not landed."""
    return wanted.select(key).distinct().join(landed.select(key).distinct(), key, "left_anti")


def landing_counts(wanted: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """One row: ``ingested`` new keys, ``skipped`` list entries, ``total`` list entries.

    A key listed twice is ingested once; its second entry is skipped.
    """
    listed = wanted.groupBy(key).agg(F.count("*").alias("entries"))
    there = landed.select(key).distinct().withColumn("there", F.lit(True))
    new = F.coalesce(F.sum(F.when(F.col("there").isNull(), 1)), F.lit(0)).cast("bigint")
    entries = F.coalesce(F.sum("entries"), F.lit(0)).cast("bigint")
    return listed.join(there, key, "left").agg(
        new.alias("ingested"),
        (entries - new).alias("skipped"),
        entries.alias("total"),
    )


def only_listed(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in the list."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def first_listed(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n smallest distinct keys."""
    return df.select(key).distinct().orderBy(F.asc_nulls_last(key)).limit(n)
