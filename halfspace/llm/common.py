"""What several operators share: tables in the shared folder, joins that keep hot keys
apart, and bounded slices of text inside a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halfspace.workspace import fresh_dir

# Bytes of text that a task turns into arrays at a time.
SLICE_BYTES = 4 * 1024 * 1024

# Longer texts are not learned from, so a sample fits the driver; all texts are scored.
SAMPLE_CHARS = 50_000

# Keys that get a broadcast of their own hold at least this share of all rows, so there
# are never more of them than its inverse.
HOT_SHARE = 1 / 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_table(df: DataFrame, purpose: str, by: Sequence[str] = ()) -> DataFrame:
    """Write rows to the folder that all executors share, and read them back.

    This cuts the lineage: what is lost with an executor is read again, not computed
    again, and later readers of nondeterministic rows agree on them.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a column as text, modulo a number; NULL counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(modulus))


def hot_join(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str) -> DataFrame:
    """Inner join of ``left`` to the one row that ``right`` has for each key.

    ``right`` carries each key's number of left rows as ``weight``. Keys with at least
    ``HOT_SHARE`` of all rows are broadcast, at most ``1 / HOT_SHARE`` of them whatever
    the input, so their rows stay where they are; all others are shuffled by key. Both
    sides are read twice and should be written tables.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    least = max(1, int(total * HOT_SHARE))
    hot = F.broadcast(right.where(F.col(weight) >= least))
    cold = right.where(F.col(weight) < least)
    rest = left.join(hot.select(*on), list(on), "left_anti")
    return left.join(hot, list(on)).unionByName(rest.join(cold, list(on)))


def one_row_each(docs: DataFrame, chosen: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` whose keys are in ``chosen``, one for each, with all columns.

    ``keys`` gives each key column of ``chosen`` as it is worked out from ``docs``; NULL
    equals NULL. Joining and removing repeated rows use the same columns, so whole rows
    are shuffled once.
    """
    prefix = "key"
    while any(column.lower().startswith(prefix) for column in docs.columns):
        prefix = f"_{prefix}"
    there = {f"{prefix}_no_{name}": F.coalesce(key.isNull(), F.lit(False)) for name, key in keys.items()}
    wanted = chosen.select(
        *[F.coalesce(name, _blank(chosen, name)).alias(f"{prefix}_of_{name}") for name in keys],
        *[F.col(name).isNull().alias(f"{prefix}_no_{name}") for name in keys],
    ).distinct()
    given = {
        f"{prefix}_of_{name}": F.coalesce(key, _blank(chosen, name)) for name, key in keys.items()
    }
    on = [*given, *there]
    return docs.withColumns({**given, **there}).join(wanted, on).dropDuplicates(on).select(
        *docs.columns
    )


def _blank(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return F.lit(b"" if kind.typeName() == "binary" else 0).cast(kind)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice has about ``most`` bytes of text, or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, fit: Column, most: int
) -> list[tuple[int, str, int]]:
    """(doc_id, text, label) of at most ``most`` labelled rows for each value of the label.

    Only rows that meet ``fit`` are taken, those with the smallest hash of their id
    first, so the sample does not depend on partitions. NULL ids, labels and texts, and
    texts of more than ``SAMPLE_CHARS``, are left out. An id that is labelled twice counts
    once, with the lower label, and so does one with several texts, with the first in
    order: those are reduced to one inside the tasks, however many there are. The chosen
    ids (at most ``2 * most``) are broadcast to the scan of the texts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
    )
    known = known.groupBy("doc_id").agg(F.min("label").alias("label")).where(fit)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("label") == v).orderBy(*order).limit(most) for v in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS)
    rows = texts.join(ids, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return sorted((row.doc_id, row.text, row.label) for row in rows.collect())


def steady_hash(number: int) -> int:
    """A hash of an id that is the same in every session (Knuth's multiplicative hash)."""
    return (number * 2654435761 & 0xFFFFFFFF) >> 8
