"""The registered queries against their SQL, and the pipeline against its parts."""

import os

import pytest
from compare import assert_same, open_tables
from pyspark.sql import functions as F

import corpus_pipeline
from tidewright.llm import mixing
from tidewright.llm.oracles import ORACLES
from tidewright.llm.queries import OTHER_WEIGHT, QUERIES, WEIGHTS

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert_same(QUERIES[name](spark, FOLDER), open_tables(FOLDER), ORACLES[name])


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    quality = {r.doc_id for r in QUERIES["op2_quality_forest"](spark, FOLDER).where("kept").collect()}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(found) <= quality and [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"
    left = docs.where(docs.doc_id.isin(list(quality)))
    from tidewright.llm import lsh_forest

    assert set(found) == {r.class_id for r in lsh_forest.near_copies(left).collect()}
    assert all(r.n_tokens > 0 for r in found.values())


def test_pipeline_tells_the_mixed_order(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # One source holds half of the rows, and files are small, so that Spark packs several in a task.
    docs = docs.selectExpr("doc_id", "text", "lang", "if(doc_id % 2 = 0, 'src0', source) source", "n_chars")
    stages = dict(corpus_pipeline.STAGES)
    mixed = stages["mixing sources"](spark, docs, FOLDER)
    mixed.write.option("maxRecordsPerFile", 7).parquet(f"{tmp_path}/mixed")
    read = spark.read.parquet(f"{tmp_path}/mixed")
    found = stages["BPE encoding"](spark, read, FOLDER)
    order = [r.doc_id for r in sorted(found.collect(), key=lambda r: r.position)]
    assert sorted(r.position for r in found.collect()) == list(range(docs.count()))
    key = F.xxhash64("doc_id")
    brute = mixing.scheduled(docs.select("doc_id", "source"), [key, F.col("doc_id")],
                             WEIGHTS, OTHER_WEIGHT, shared=True)
    assert order == [r.doc_id for r in brute.orderBy("position").collect()]
    # Without the stage the order is another one.
    docs.write.parquet(f"{tmp_path}/plain")
    plain = stages["BPE encoding"](spark, spark.read.parquet(f"{tmp_path}/plain"), FOLDER)
    assert order != [r.doc_id for r in plain.orderBy("position").collect()]
    unwritten = stages["BPE encoding"](spark, mixed, FOLDER)
    assert order == [r.doc_id for r in unwritten.orderBy("position").collect()]


def test_position_of_the_input_gives_way(spark):
    rows = spark.createDataFrame([(1, "stone river", "x", 3), (2, None, "y", 4)],
                                 "doc_id long, text string, position string, row_of_file int")
    found = dict(corpus_pipeline.STAGES)["BPE encoding"](spark, rows, FOLDER)
    assert sorted(r.position for r in found.collect()) == [0, 1]
