"""Exact duplicates through an extendible-hash index on shared files.

A text's key is the 64-bit hash of its normalised form. The index has a directory of
``2**depth`` slots, one for each value of a key's first bits. It doubles as long as a
bucket is overfull, and only overfull buckets are split, so a bucket covers one slot or
a run of slots: a range of keys. Each bucket is a folder of files in the shared folder,
written by the task that owns its range. The owner chains what has one key: it goes through
the key's texts in order, compares each one's bytes with those before it, and begins another
entry where they differ. Group sizes and keepers are those of the chains' entries.

Copies are combined before they are routed, into at most ``PORTIONS`` rows of a text, so
an owner gets few rows however large a group is. Looking rows up in the index goes by
``hot_join``. Only DataFrame operations are used.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfspace.llm.common import documents, hot_join, one_row_each, shared_table

WHITE_SPACE = " \t\n\x0b\x0c\r"

# Entries of a bucket beyond which it is split, and doublings of the directory at most:
# it never has more than 2**MAX_DEPTH slots, so it can be broadcast. A bucket that is
# still overfull then keeps its entries in longer files.
CAPACITY = 32_768
MAX_DEPTH = 12
# Rows into which the copies of a text are combined before they are routed, at most.
PORTIONS = 8


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def hash_key(norm: Column) -> Column:
    return F.xxhash64(norm)


def _keyed(docs: DataFrame) -> DataFrame:
    text = normalised(F.col("text"))
    chars = F.length(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", chars.alias("chars"), text.alias("norm")).withColumn(
        "key", hash_key(F.col("norm"))
    )


# A row's rank is a whole number: its code points times this, and what is larger for a
# smaller id, from 2**64 down to 1, or 0 without an id.
PER_CODE_POINT = Decimal(2**65)
LARGEST_ID = Decimal(2**63)


def _rank() -> Column:
    """Largest for the row that stays: more code points, then the smaller id, NULL last.

    One decimal keeps the aggregate's buffer of fixed length.
    """
    longer = F.col("chars").cast("decimal(10,0)") * F.lit(PER_CODE_POINT)
    earlier = F.lit(LARGEST_ID) - F.col("doc_id").cast("decimal(19,0)")
    return (longer + F.coalesce(earlier, F.lit(Decimal(0)))).cast("decimal(38,0)")


def _portions(keyed: DataFrame) -> DataFrame:
    """The copies of a text combined into a few rows, each with their number and keeper."""
    ranked = keyed.select(
        "key", "norm", _rank().alias("rank"), F.pmod(F.xxhash64("doc_id"), F.lit(PORTIONS)).alias("portion")
    )
    return ranked.groupBy("key", "norm", "portion").agg(F.count("*").alias("n"), F.max("rank").alias("rank"))


def directory(
    keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """The index's directory: ``slot`` (first ``max_depth`` bits), ``depth`` and ``bucket``.

    ``bucket`` is the first slot of the run that the bucket covers. The directory after
    n doublings tells apart the first n bits; a bucket's depth is the first n at which it
    is not overfull. At most ``2**max_depth`` counts are worked on.
    """
    spark = keys.sparkSession
    slot = F.shiftrightunsigned("key", 64 - max_depth).cast("int").alias("slot")
    counts = keys.groupBy(slot).agg(F.count("*").alias("n"))
    slots = spark.range(2**max_depth).select(F.col("id").cast("int").alias("slot"))
    levels = slots.join(F.broadcast(counts), "slot", "left").select(
        "slot",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"),
    )
    first = F.expr(f"shiftleft(shiftright(slot, {max_depth} - depth), {max_depth} - depth)")
    levels = levels.withColumn("bucket", first)
    held = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("held"))
    fits = (F.col("held") <= capacity) | (F.col("depth") == max_depth)
    best = (
        levels.join(held, ["depth", "bucket"])
        .groupBy("slot")
        .agg(F.min(F.when(fits, F.struct("depth", "bucket"))).alias("best"))
    )
    return best.select("slot", "best.depth", "best.bucket")


def build_index(
    keyed: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """Write the index and return its entries: key, sha, keep_id, group_size, and their
    ``bucket`` and place in the ``chain``."""
    portions = shared_table(_portions(keyed), "dedup-portions")
    keys = portions.select("key").distinct()
    slots = shared_table(directory(keys, capacity, max_depth).coalesce(1), "dedup-directory")
    slot = F.shiftrightunsigned("key", 64 - max_depth).cast("int")
    placed = portions.withColumn("slot", slot).join(F.broadcast(slots), "slot").drop("slot")
    owned = placed.withColumn("n_bytes", F.octet_length("norm")).repartitionByRange("bucket", "key")
    # The chain: texts of one key in order, and a new entry where the bytes change.
    chain = Window.partitionBy("bucket", "key").orderBy("n_bytes", "norm")
    differs = ~F.col("norm").eqNullSafe(F.lag("norm").over(chain))
    chained = owned.withColumn("differs", differs.cast("int"))
    chained = chained.withColumn("chain", F.sum("differs").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.max(F.when(F.col("differs") == 1, F.unhex(F.sha2("norm", 256)))).alias("sha")
    entries = chained.groupBy("bucket", "key", "chain").agg(
        first, F.sum("n").alias("group_size"), F.max("rank").alias("rank")
    )
    earlier = F.col("rank") % F.lit(PER_CODE_POINT)
    keep = F.when(earlier > 0, (F.lit(LARGEST_ID) - earlier).cast("bigint"))
    return shared_table(
        entries.select("key", "sha", keep.alias("keep_id"), "group_size", "chain", "bucket"),
        "dedup-index",
        by=["bucket"],
    )


def mark_duplicates(
    docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256.

    Texts are equal when their normalised forms have the same bytes. The row with the
    most code points stays, then the one with the smallest id.

    NULL and blank texts are one group. A NULL id comes after all others. Rows that
    repeat id and text are each counted, and as they can't be told apart, each is marked
    as kept; ``deduplicate`` returns one of them. Other columns are ignored. An empty
    table gives an empty result.
    """
    keyed = _keyed(docs)
    index = build_index(keyed, capacity, max_depth)
    digest = F.unhex(F.sha2("norm", 256)).alias("sha")
    rows = shared_table(keyed.select("doc_id", "key", digest), "dedup-rows")
    entries = index.select("key", "sha", "keep_id", "group_size")
    found = hot_join(rows, entries, ["key", "sha"], "group_size")
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one for each text."""
    keepers = build_index(_keyed(docs)).select("keep_id", "sha")
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    return one_row_each(docs, keepers, {"keep_id": F.col("doc_id"), "sha": digest})


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return mark_duplicates(documents(spark, sf_dir))


OP3_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, arg_min(doc_id, (-chars, doc_id)) AS keep_id
  FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""
