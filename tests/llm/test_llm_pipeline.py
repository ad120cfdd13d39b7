"""The pipeline as a whole, and what it registers."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from halfspace.llm import exact_dedup, quality_crf, simhash, toxicity
from halfspace.llm.queries import ORACLES, QUERIES


def test_all_queries_are_registered():
    names = contract.queries()
    assert {*QUERIES, "pipeline"} <= set(names)
    assert set(ORACLES) <= set(contract.oracle_sql())
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Prose, toxic and junk documents, copies and near copies, with labels for most."""
    dice = random.Random(12)
    words = ["".join(dice.choices("abcdefghijklmnop", k=dice.randint(2, 9))) for _ in range(500)]
    prose = lambda n: ". ".join(" ".join(dice.choices(words, k=10)) for _ in range(n)) + "."
    rows = []
    for i in range(600):
        text = prose(8)
        if i % 5 == 0:
            text = text.replace(" ", " grumblor ", 3)
        elif i % 7 == 0:
            text = "\n".join("### $$$ " * 12 for _ in range(4))
        rows.append((i, text))
    clean = [r for r in rows if r[0] % 5 and r[0] % 7]
    rows += [(1000 + i, clean[i][1].replace(" ", "  ", 1)) for i in range(30)]
    rows += [(2000 + i, clean[40 + i][1] + " appendix") for i in range(20)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 7 != 0 or i % 5 == 0), int(i % 5 == 0)) for i in range(600)]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_pipeline_does_what_its_stages_say(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = [{r[0] for r in rows}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        left.append({r.doc_id for r in docs.collect()})
    toxic = {i for i in range(600) if i % 5 == 0}
    junk = {i for i in range(600) if i % 5 and i % 7 == 0}
    assert left[0] - left[1] == toxic
    assert left[1] - left[2] == junk
    # Each copy has one more code point than its original, so the original goes.
    assert len(left[2] - left[3]) == 30
    assert all(i < 600 for i in left[2] - left[3])
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left[4]


def test_stages_agree_with_their_operators(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    network = toxicity.learn(docs, labels, toxicity.learnable())
    below = toxicity.score(docs, network).where(f"score < {toxicity.DECISION}")
    assert ids(corpus_pipeline.drop_toxic(spark, docs, folder)) == ids(below)
    field = quality_crf.learn(docs, labels, quality_crf.learnable())
    good = quality_crf.score(docs, field).where(f"score >= {quality_crf.DECISION}")
    assert ids(corpus_pipeline.drop_low_quality(spark, docs, folder)) == ids(good)
    kept = exact_dedup.mark_duplicates(docs).where("kept")
    assert ids(corpus_pipeline.drop_copies(spark, docs, folder)) == ids(kept)
    first = simhash.near_duplicates(docs).where("doc_id = component_id")
    assert ids(corpus_pipeline.drop_near_copies(spark, docs, folder)) == ids(first)


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_and_nulls(spark, corpus, stage):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert stage(spark, docs.limit(0), folder).count() == 0
    odd = [(None, None, None, None), (1, None, "en", None), (1, "", None, "s"), (1, "", None, "s")]
    odd = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    assert stage(spark, odd, folder).count() > 0
