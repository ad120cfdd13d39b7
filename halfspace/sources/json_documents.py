"""Raw JSON documents, read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfspace.functions import parse_json
from halfspace.functions.documents import STRICT
from halfspace.sources.objects import read_texts
from halfspace.sources.split_arrays import split_elements


NOT_AN_ARRAY = "a document is blank, no array, or has null elements"


def elements(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per element of array documents: ``keep``, ``pos`` and ``payload``.

    An element's text is its JSON, written anew by the parser, and ``pos`` is its place in
    the array. An empty array gives one row without ``pos`` and ``payload``, so the
    document itself is still seen to have landed. A blank document, one that is no array,
    and a null element fail the query.
    """
    array = parse_json("payload", "array<string>")
    sound = F.when(
        array.isNotNull() & ~F.exists(array, lambda element: element.isNull()), array
    ).otherwise(F.raise_error(F.lit(NOT_AN_ARRAY)).cast("array<string>"))
    return documents.select(*keep, F.posexplode_outer(sound).alias("pos", "payload"))


def scan_documents(
    spark: SparkSession,
    paths: str | list[str],
    schema: str,
    array_files: bool = True,
    splittable: bool = False,
) -> DataFrame:
    """One row per JSON object over any number of files, matched to the schema by name.

    With ``array_files`` each file is one JSON array, the unit of one task, or with
    ``splittable``, for files of gigabytes, of as many as it has splits; otherwise each line
    is an object (or an array of objects), and files split freely. A value that does not
    fit the schema fails the query.
    """
    if not array_files:
        return spark.read.schema(schema).options(**STRICT).json(paths)
    # The multi-line JSON reader copies numbers that are read as text, such as those of a
    # location, so slowly that splitting the array first takes a quarter of the time.
    found = split_elements(spark, paths) if splittable else elements(read_texts(spark, paths))
    documents = found.where("payload IS NOT NULL")
    return documents.select(parse_json("payload", schema).alias("doc")).select("doc.*")
