"""Raw documents to trusted tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from halfspace.formats import CHECKED_EVENT, RAW_EVENT, RAW_MATCH, TRUSTED_EVENT, TRUSTED_MATCH
from halfspace.functions import parse_json
from halfspace.operators import flatten

CHECKED_COLUMNS = tuple(column for column in TRUSTED_EVENT if column[0] in CHECKED_EVENT)


def _parsed(raw: DataFrame, schema: str, keep: Sequence[str]) -> DataFrame:
    """Documents of a raw table as columns; each document is parsed once."""
    return raw.select(*keep, parse_json("payload", schema).alias("doc")).select(*keep, "doc.*")


def trusted_events(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 23 trusted event columns of a raw table's ``payload`` documents."""
    return flatten(_parsed(raw, RAW_EVENT, keep), TRUSTED_EVENT, keep)


def trusted_matches(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 12 trusted match columns of a raw table's ``payload`` documents."""
    return flatten(_parsed(raw, RAW_MATCH, keep), TRUSTED_MATCH, keep)


def checked_events(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 7 event columns that are checked; no other field is parsed."""
    read = {path.split(".")[0].split("[")[0] for _, _, path in CHECKED_COLUMNS}
    fields = [f for f in T.StructType.fromDDL(RAW_EVENT) if f.name in read]
    parsed = _parsed(raw, T.StructType(fields).toDDL(), keep)
    return flatten(parsed, CHECKED_COLUMNS, keep).select(*keep, *CHECKED_EVENT)
