"""The corpus pipeline: from raw documents to packed sequences.

Each stage works on all that its predecessor kept. The classifiers learn from the
labelled rows among their own input that are not held out.

Each stage takes any table with ``doc_id`` and ``text``. All but the last return their
input's columns, whatever their names. A NULL text counts as an empty one, rows that repeat
an id or lack one are documents like others, equal texts are judged alike, and an empty table
gives an empty result. A text of any length is one task's work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from halfspace.llm import exact_dedup, packing, quality_crf, simhash, toxicity
from halfspace.llm.common import documents, shared_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network doesn't take for toxic.

    An empty text has no toxic word. Without labels of both kinds, all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels, toxicity.learnable()))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field takes for good.

    All empty texts have one score. Without labels of both kinds, scores say nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_crf.keep_good(docs, quality_crf.learn(docs, labels, quality_crf.learnable()))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.

    Empty texts are one group. Of rows equal in id and text, one stays.
    """
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Texts without words are one group. Documents of several groups that share an id, or
    lack one, each stay.
    """
    return simhash.keep_representatives(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences, with digests of their ids.

    An empty text is its end id alone.
    """
    return packing.digests(packing.pack(docs, *packing.public_vocabulary()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("packing", pack_sequences),
]

# The classifiers, SimHash and the tokenizer can't be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each stage's result is written and read back."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
