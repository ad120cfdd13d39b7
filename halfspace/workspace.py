"""Shared scratch space for intermediate tables, and settings for a while."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen for a local-mode session that has none
    set; a cluster without one is refused, since its executors share no local disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir()


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A path below the shared root that no other call gets."""
    return f"{shared_root(spark).rstrip('/')}/halfspace/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Change a setting of the session for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
