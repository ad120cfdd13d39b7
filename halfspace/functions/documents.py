"""Reading values out of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A malformed value must stop the run, not turn into NULL.
STRICT = {"mode": "FAILFAST"}


def parse_json(payload: str, schema: str) -> Column:
    """Parse a JSON text column, failing on values that do not fit the schema."""
    return F.from_json(F.col(payload), schema, STRICT)


def safe_number(value: Column) -> Column:
    """The value as a double, or NULL where it is not a number."""
    return value.try_cast("double")


def at_path(path: str) -> Column:
    """The value at a dotted path; ``name[n]`` is the n-th array element from 1.

    A NULL or absent struct gives NULL, and so does an element past the array's end.
    """
    name, bracket, index = path.rstrip("]").partition("[")
    if not bracket:
        return F.col(name)
    return F.get(F.col(name), F.lit(int(index) - 1))
