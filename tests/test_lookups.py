"""Joins with lookup tables, key checks, numbering, de-duplication."""

import pytest
from pyspark.sql import functions as F

from plans_text import plan
from spendmart.operators import geo, lookup, numbering
from spendmart.plans import fact, rollups
from spendmart.plans.dims import build_dim_country, curate_target_file
from spendmart.sources.files import read_csv

COUNTRIES = [(1, "US", "United States"), (2, "NA", "Namibia")]
RATES = [(20240601, "USD", 1.0), (20240601, "EUR", 1.1), (20240701, "USD", 1.0)]
ADS = [
    ("USD", "US", "20240601", 10, 2.0),
    ("USD", "US", "20240601", 10, 2.0),
    ("EUR", "NA", "20240601", 3_000_000_000, 2.0),
    ("VND", "US", "20240601", 1, 2.0),
    ("USD", "XX", "20240602", 1, 2.0),
    (None, None, "20240601", 1, 2.0),
]


@pytest.fixture
def tables(spark):
    return (
        spark.createDataFrame(COUNTRIES, "country_id int, country string, country_name string"),
        spark.createDataFrame(RATES, "date_id int, currency string, exchange_rate_usd double"),
        spark.createDataFrame([(1, "facebook")], "channel_id int, channel string"),
    )


@pytest.fixture
def ads(spark):
    return spark.createDataFrame(
        ADS, "currency string, country string, date_id string, impressions bigint, cost double"
    )


def test_fact_keeps_every_row(ads, tables):
    rows = fact.build_fact({"facebook": ads, "google": ads}, fact.Lookups.checked(*tables))
    facebook = rows.where("channel_id = 1").collect()
    assert sorted([tuple(r)[1:] for r in facebook], key=str) == sorted(
        [
            ("20240601", 1, 10, 2.0),
            ("20240601", 1, 10, 2.0),
            ("20240601", 2, None, 2.2),
            ("20240601", 1, 1, None),
            ("20240602", None, 1, None),
            ("20240601", None, 1, None),
        ],
        key=str,
    )
    assert rows.where("channel_id IS NULL").count() == len(ADS)


def test_fact_types(ads, tables):
    rows = fact.build_fact({"facebook": ads}, fact.Lookups.checked(*tables))
    assert dict(rows.dtypes) == {
        "channel_id": "int",
        "date_id": "string",
        "country_id": "int",
        "impressions": "int",
        "cost_usd": "double",
    }


def test_no_channel_is_an_error(tables):
    with pytest.raises(ValueError, match="no input"):
        fact.build_fact({}, fact.Lookups.checked(*tables))


def test_rates_of_the_loaded_period_only(tables):
    assert fact.Lookups.checked(*tables, date_prefix="202406").rates.count() == 2


def test_repeated_key_stops_or_multiplies(spark, ads, tables):
    countries, rates, channels = tables
    twice = countries.union(spark.createDataFrame([(3, "US", "again")], countries.schema))
    with pytest.raises(ValueError, match="more than once"):
        fact.Lookups.checked(twice, rates, channels)
    lookups = fact.Lookups.checked(twice, rates, channels, allow_repeated_keys=True)
    assert fact.build_fact({"facebook": ads}, lookups).count() == len(ADS) + 3


def test_repeated_null_keys_are_no_error(spark):
    table = spark.createDataFrame([(1, None), (2, None)], "country_id int, country string")
    assert lookup.measure_lookup(table, ["country"]).repeated_keys == 0


def test_measured_size_decides_the_join(spark, ads, tables):
    countries = tables[0]
    size = lookup.measure_lookup(countries, ["country"])
    assert size.rows == 2 and size.bytes > 0
    small = lookup.sized_lookup(countries, ["country"])
    large = lookup.sized_lookup(countries, ["country"], broadcast_bytes=size.bytes - 1)
    assert "BroadcastHashJoin" in plan(lookup.join_country(ads, small))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(lookup.join_country(ads, large))
        assert "BroadcastHashJoin" in plan(lookup.join_country(ads, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_when_the_lookup_is_too_large_to_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    n = 60_000
    country = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string"))
    rows = spark.range(0, n, 1, 8).select(
        country.alias("country"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    table = spark.range(1000).select(
        F.col("id").cast("int").alias("country_id"),
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("country"),
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = lookup.join_country(
            rows, lookup.sized_lookup(table, ["country"], broadcast_bytes=0)
        )
        got = joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in final
    assert len(got) == n
    assert sum(r["country_id"] == 0 for r in got) == n // 3
    unmatched = sum(r["country_id"] is None for r in got)
    assert unmatched == sum(i % 3 != 0 and i % 1000 == 0 for i in range(n))


def test_last_of_each_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, at int, v string"
    )
    kept = geo.last_of_each_key(rows, ["k"], ["at"], ["v"])
    assert {(r["k"], r["v"]) for r in kept.collect()} == {("a", "z"), ("b", None)}


def test_distinct_codes(spark):
    rows = spark.createDataFrame([("1",), ("1",), (None,), ("2",)], "country_code string")
    assert {r[0] for r in geo.distinct_codes(rows).collect()} == {"1", "2"}


def test_number_in_order_over_many_partitions(spark):
    rows = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("k"))
    numbered = numbering.number_in_order(rows.repartition(16), "k", "n", first=10)
    assert sorted((r["k"], r["n"]) for r in numbered.collect()) == [(i, i + 10) for i in range(5000)]


def test_number_file_rows_over_many_blocks(spark, tmp_path):
    for name, start in (("a.csv", 0), ("b.csv", 3000)):
        body = "".join(f"{i},text {i}\n" for i in range(start, start + 3000))
        (tmp_path / name).write_text("id,text\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        numbered = numbering.number_file_rows(read_csv(spark, str(tmp_path)), "n")
        assert numbered.rdd.getNumPartitions() > 4
        got = sorted((r["n"], r["id"]) for r in numbered.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i + 1, str(i)) for i in range(6000)]


def test_row_range_is_inclusive(spark):
    numbered = spark.range(1, 10).withColumnRenamed("id", "n").withColumn("v", F.col("n"))
    assert [r["v"] for r in numbering.row_range(numbered, "n", 3, 5).collect()] == [3, 4, 5]


def test_dim_country_ids(spark):
    names = spark.createDataFrame([("US", "b"), ("AF", "a"), ("NA", "c")], "country string, country_name string")
    assert {tuple(r) for r in build_dim_country(names, 5).collect()} == {
        (5, "AF", "a"),
        (6, "NA", "c"),
        (7, "US", "b"),
    }


def test_curate_target_file(spark, tmp_path):
    header = "Criteria ID,Name,Canonical Name,Parent ID,Country Code,Target Type,Status\n"
    rows = [
        '1,Before,Before,,AA,Country,Active',
        '2,"Kept, one",Kept,,NA,Country,Active',
        '3,Region,Region,,BB,Region,Active',
        '4,Has parent,X,77,CC,Country,Active',
        '5,City,City,,DD,City,Active',
        '6,Text for missing,X,NA,EE,Region,Active',
        '7,After,After,,FF,Country,Active',
    ]
    path = tmp_path / "targets.csv"
    path.write_text(header + "\n".join(rows) + "\n")
    kept = curate_target_file(read_csv(spark, str(path)), first=2, last=6)
    assert kept.columns == ["Criteria ID", "Country Code", "Name"]
    assert {tuple(r) for r in kept.collect()} == {
        ("2", "NA", "Kept, one"),
        ("3", "BB", "Region"),
        ("6", "EE", "Text for missing"),
    }
    assert geo.rename_targets(kept).columns == ["country", "country_name"]


def test_na_can_be_read_as_null(spark, tmp_path):
    path = tmp_path / "geo.csv"
    path.write_text("country_code,Country\n2516,NA\n2004,AF\n")
    kept = geo.geo_map(read_csv(spark, str(path)))
    lost = geo.geo_map(read_csv(spark, str(path), missing="NA"))
    assert {(r["code"], r["iso"]) for r in kept.collect()} == {("2516", "NA"), ("2004", "AF")}
    assert {(r["code"], r["iso"]) for r in lost.collect()} == {("2516", None), ("2004", "AF")}


def test_cpm_without_impressions_is_null(spark):
    rows = spark.createDataFrame(
        [(1, "20240601", 1, 0, 2.0), (2, "20240601", 1, 500, 2.0)],
        "channel_id int, date_id string, country_id int, impressions int, cost_usd double",
    )
    got = {r["channel_id"]: r["cpm"] for r in rollups.cpm_by_channel(rows).collect()}
    assert got == {1: None, 2: 4.0}
