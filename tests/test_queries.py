"""Every registered query against its SQL, and the plans of the main ones."""

import re

import pytest

import __spark_entry__ as contract
from compare import difference
from plans_text import plan
from spendmart.operators.quality import reject_counts, validate
from spendmart.plans.clean import clean_ads
from spendmart.schemas import CHANNELS
from workload import inputs

SF = "/root/testdata/sf0.001"
# too small there for these to have rows
LARGER = {name: "/root/testdata/sf0.01" for name in ("row_range_slice", "file_order_slice", "geo_slice_rename", "fact_period")}


def test_every_query_has_an_oracle():
    assert set(contract.QUERIES) == set(contract.ORACLE)


@pytest.mark.parametrize("name", list(contract.QUERIES))
def test_query_equals_sql(spark, name):
    sf = LARGER.get(name, SF)
    assert difference(contract.queries()[name](spark, sf), contract.oracle_sql()[name], sf) is None


def test_entry_has_the_fact_schema(spark):
    assert contract.entry(spark).columns == [
        "channel_id", "date_id", "country_id", "impressions", "cost_usd",
    ]


def test_fact_plan_has_no_shuffle_and_no_python(spark):
    text = plan(contract.queries()["fact_ad_performance"](spark, SF))
    assert text.count("BroadcastHashJoin") >= 4
    assert not re.search(r"SortMergeJoin|Exchange hashpartitioning|Python|ArrowEval", text)


@pytest.mark.parametrize(
    ("name", "join"),
    [
        ("unmapped_codes", "LeftAnti"),
        ("geo_lookup_default", "LeftOuter"),
        ("normalize_google", "LeftOuter"),
        ("join_fx", "LeftOuter"),
    ],
)
def test_measured_tables_are_broadcast(spark, name, join):
    # Without this threshold Spark broadcasts only what is marked.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(contract.queries()[name](spark, SF), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and join in text and "SortMergeJoin" not in text


def test_aggregations_combine_before_the_shuffle(spark):
    for name in ("ingest_reject_counts", "partition_row_counts", "distinct_codes", "dedup_last_wins"):
        text = plan(contract.queries()[name](spark, SF), "simple")
        below = text.split("Exchange hashpartitioning")[1]
        assert "partial_" in below or "HashAggregate(keys" in below, name


def test_slice_is_a_bounded_merge(spark):
    text = plan(contract.queries()["row_range_slice"](spark, SF), "simple")
    assert "TakeOrderedAndProject" in text and "Checkpoint" not in text


def test_last_wins_hashes(spark):
    assert "SortAggregate" not in plan(contract.queries()["dedup_last_wins"](spark, SF), "simple")


def test_top_rows_are_not_sorted_whole(spark):
    assert "TakeOrderedAndProject" in plan(contract.queries()["preview_limit"](spark, SF), "simple")


def test_each_line_is_parsed_once(spark, tmp_path):
    spec = CHANNELS["facebook"]
    inputs.raw_lines(spark, SF, "facebook").write.text(str(tmp_path / "raw"))
    lines = spark.read.text(str(tmp_path / "raw")).withColumnRenamed("value", "line")
    for df in (clean_ads(lines, spec), reject_counts(validate(lines, spec))):
        # Map parses belong to the absent-key test and run only behind a null.
        assert plan(df).count("from_json(StructField") == 1


def test_nation_filter_reaches_the_scan(spark):
    text = plan(inputs.code_map(spark, SF))
    assert "LessThan(n_nationkey,23)" in text
    assert "ReadSchema: struct<n_nationkey:int,n_name:string>" in text
