"""Queries with SQL against it, and the pipeline's rules."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import difference
from spendmart.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), ORACLE[name], SF) is None


def test_stages_keep_the_columns_and_pack_everything(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    docs = docs.unionByName(odd_docs.select(*columns))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns and docs.count() > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.agg(F.sum(F.when(F.col("start") == 0, 1))).first()[0] == docs.count()


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "ids_crc32"} <= set(out.columns) and out.count() > 0
