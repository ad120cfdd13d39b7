"""Array files of any size, each read by as many tasks as it has splits.

A JSON array can't be cut at any byte: what a bracket means depends on whether it lies in a
string, and so on all quotes before it. But the state at a place is a sum over what lies
before it, so it is found in two steps. Files are read as fragments that end at a closing
brace, which Spark cuts at the right bytes whatever the splits. Each fragment gives its
number of quotes and its change of depth, for a start inside and outside a string. Sums
inside each split, and sums of the splits before it, give the state that each fragment
starts in. An element ends where the depth comes back to that of the array.

Fragments of a split meet in one task; only elements that reach over the end of a split
are put together across tasks. No row holds more than an element or a split's state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halfspace.workspace import fresh_dir

SPLIT = ["path", "block"]
SPLITS_TO_A_TASK = 8
UNSOUND = "a document is no array of objects"


def _outside(pieces: str, parity: int) -> Column:
    """Brackets opened less those closed in every other piece between quotes."""
    text = f"array_join(filter({pieces}, (piece, i) -> i % 2 = {parity}), '')"
    return F.expr(
        f"2 * length({text}) - length(translate({text}, '{{[', '')) - length({text}) "
        f"- (length({text}) - length(translate({text}, ']', '')))"
    )


def _summed(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Add the sum of a column over all earlier rows of the file, over splits of any number."""
    inside = Window.partitionBy(*SPLIT).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy(*SPLIT).agg(F.sum(column).alias("sum"))
    splits = splits.select(*SPLIT, F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    here = F.coalesce(F.sum(column).over(inside), F.lit(0))
    return rows.withColumn("here", here).join(F.broadcast(splits), SPLIT).withColumn(
        name, F.col("here") + F.col("offset")
    ).drop("here", "offset")


def _spread(rows: DataFrame) -> DataFrame:
    """Deal out splits, a few to a task: merged partitions of text are many times as large sorted."""
    splits = rows.select(*SPLIT).distinct().count()
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(1, min(splits, most), splits // SPLITS_TO_A_TASK), *SPLIT)


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_elements(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per element of array files: ``path``, ``pos`` and ``payload``, its text.

    Elements have to be objects. An empty array gives one row without ``pos`` and
    ``payload``. A file that is blank, no array, or ends too early, and an element that
    is no object, fail the query; a file of zero bytes gives no row. Elements are not
    parsed, so a malformed one fails where it is.
    """
    fragments = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("text"),
    )
    # Escaped characters can't end a string; without them, every quote does or begins one.
    pieces = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')
    fragments = fragments.withColumn("pieces", pieces).select(
        *SPLIT,
        "seq",
        "text",
        (F.size("pieces") - 1).cast("bigint").alias("quotes"),
        _outside("pieces", 0).alias("if_outside"),
        _outside("pieces", 1).alias("if_inside"),
    )
    # Written once: the sums below read the numbers several times, and the text once.
    rows = _spread(_written(fragments, "fragments"))
    rows = _summed(rows, "quotes", "quotes_before")
    inside = F.col("quotes_before") % 2 == 1
    ends_outside = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    # The brace that the fragment ended with is one level up. After a file's last fragment
    # there is none, which the sum over the file shows.
    change = F.when(inside, F.col("if_inside")).otherwise(F.col("if_outside"))
    change = change - F.when(ends_outside, 1).otherwise(0)
    rows = rows.withColumns({"change": change.cast("bigint"), "ends_outside": ends_outside})
    rows = _summed(rows, "change", "depth_before")
    closes = F.col("ends_outside") & (F.col("depth_before") + F.col("change") == 1)
    rows = rows.withColumn("closes", closes.cast("bigint"))
    rows = _summed(rows, "closes", "pos")

    # Texts are judged row by row: to keep texts of a group, Spark would sort all of them.
    whole = rows.groupBy("path").agg(
        F.sum("closes").alias("elements"),
        F.sum("change").alias("depth"),
        F.max_by("ends_outside", "seq").alias("ends_outside"),
        F.min_by(F.substring("text", 1, 4096).rlike(r"^\s*\["), "seq").alias("opened"),
        F.max_by(F.regexp_replace("text", r"\s+", "").rlike(r"^\[?\]$"), "seq").alias("closed"),
    )
    sound = (F.col("depth") == -1) & F.col("ends_outside") & F.col("opened") & F.col("closed")
    checked = whole.select(
        "path", "elements", F.when(sound, True).otherwise(F.raise_error(F.lit(UNSOUND)).cast("boolean")).alias("sound")
    )

    # What follows the last element is no element. There is one row for each file, which is
    # sent to the fragments: by path, all of a file would meet in one task.
    sound_files = F.broadcast(checked.where("sound"))
    members = rows.join(sound_files, "path").where(F.col("pos") < F.col("elements"))
    ordered = F.sort_array(F.collect_list(F.struct("seq", "text")))
    joined = F.concat(F.array_join(ordered.getField("text"), "}"), F.lit("}"))
    pieces = members.groupBy(*SPLIT, "pos").agg(
        joined.alias("text"), F.sum("closes").alias("closes"), F.min("seq").alias("seq")
    )
    # A piece is whole if it closes here and the one before it closed here or was the first.
    before = Window.partitionBy(*SPLIT).orderBy("pos")
    starts_here = (F.col("pos") == 0) | (F.lag("closes").over(before) == 1)
    pieces = pieces.withColumn("whole", F.coalesce((F.col("closes") == 1) & starts_here, F.lit(False)))
    pieces = _written(pieces.select("path", "pos", "text", "seq", "whole"), "elements")
    parts = F.sort_array(F.collect_list(F.struct("seq", "text"))).getField("text")
    across = pieces.where("NOT whole").groupBy("path", "pos").agg(F.array_join(parts, "").alias("text"))
    found = pieces.where("whole").select("path", "pos", "text").unionByName(across)
    payload = F.regexp_extract("text", r"(?s)^\s*[\[,]\s*(\{.*)$", 1)
    found = found.withColumn("payload", payload).select(
        "path",
        F.col("pos").cast("int").alias("pos"),
        F.when(F.col("payload") != "", F.col("payload")).otherwise(F.raise_error(F.lit(UNSOUND))).alias("payload"),
    )
    empty = checked.where("sound AND elements = 0").select(
        "path", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("payload")
    )
    return found.unionByName(empty)
