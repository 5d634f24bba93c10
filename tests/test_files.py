"""File sources and sinks, JDBC options, and the jobs end to end on generated files."""

import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import difference
from jobs import check_quality, curate_geo, ingest, load_country, load_fact
from plans_text import plan
from spendmart.plans.clean import clean_ads
from spendmart.schemas import CHANNELS
from spendmart.sinks.files import write_clean, write_csv, write_partitioned
from spendmart.sources import jdbc
from spendmart.sources.files import read_clean, read_csv, read_raw_lines
from spendmart.staging import new_path, shared_folder
from workload import queries

FB = CHANNELS["facebook"]


def fb(day, country="US", impressions="10", cost="1.5"):
    return json.dumps(
        {"Currency": "USD", "Country": country, "Day": day, "Impressions": impressions, "Amount spent": cost}
    )


def ga(day, code, impressions=10, cost=1.5):
    return json.dumps(
        {"Currency code": "EUR", "country_code": code, "Day": day, "Impr.": impressions, "Cost": cost}
    )


def put(path: Path, *rows: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(rows) + "\n")


def files(path) -> list[Path]:
    return sorted(Path(path).rglob("*.parquet"))


def test_raw_files_are_found_by_name(spark, tmp_path):
    put(tmp_path / "raw_fb_20240601.txt", "a", "b")
    put(tmp_path / "deep" / "er" / "raw_fb_20240602.txt", "c")
    put(tmp_path / "raw_fb_20240631.txt", "no such day")
    put(tmp_path / "raw_fb_latest.txt", "no day")
    put(tmp_path / "20240603.txt", "no separator")
    put(tmp_path / "raw_fb_20240601.json", "other type")
    dated = read_raw_lines(spark, str(tmp_path))
    assert sorted(r["line"] for r in dated.collect()) == ["a", "b", "c"]
    every = read_raw_lines(spark, str(tmp_path), dated_only=False)
    assert every.count() == 6


def test_clean_table_roundtrip_and_rerun(spark, lines, tmp_path):
    path = str(tmp_path / "clean")
    first = clean_ads(lines(fb("20240601"), fb("20240601"), fb("20240602"), fb("20240702")), FB)
    write_clean(first, path)
    write_clean(first, path)
    assert read_clean(spark, path).count() == 4
    write_clean(clean_ads(lines(fb("20240602", country="DE")), FB), path)
    days = {(r["date_id"], r["country"]) for r in read_clean(spark, path).collect()}
    assert days == {("20240601", "US"), ("20240602", "DE"), ("20240702", "US")}
    write_clean(clean_ads(lines(fb("20240602")), FB), path, mode="append", gather=False)
    assert read_clean(spark, path).count() == 5
    assert (Path(path) / "year=2024" / "month=6" / "day_of_month=2").is_dir()
    month = read_clean(spark, path, year=2024, month=6)
    assert month.count() == 4
    text = plan(month)
    assert "PartitionFilters: [isnotnull(year" in text and "month" in text.split("PartitionFilters")[1]
    assert "year=2024/month=6" in text.split("Location")[1].split("\n")[0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_clean(spark, path, year=2023)
    with pytest.raises(ValueError, match="needs its year"):
        read_clean(spark, path, month=6)
    assert "ReadSchema: struct<currency:string,country:string,impressions:bigint,cost:double>" in text


def test_records_per_file(spark, lines, tmp_path):
    rows = clean_ads(lines(*[fb("20240601", impressions=str(i)) for i in range(25)]), FB)
    write_clean(rows, str(tmp_path / "t"), file_rows=10)
    assert len(files(tmp_path / "t")) == 3
    assert read_clean(spark, str(tmp_path / "t")).count() == 25


def test_rows_come_back_whole_from_limited_files(spark, tmp_path):
    days = F.expr("timestamp_ntz'1995-01-01' + make_dt_interval(int(key % 400)) AS o_orderdate")
    orders = spark.range(1, 2501).withColumnRenamed("id", "key").select(
        F.col("key").alias("o_orderkey"), (F.col("key") % 31).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"),
        days, (F.col("key") * 1.25).cast("double").alias("o_totalprice"),
    )
    nations = spark.range(25).selectExpr("int(id) AS n_nationkey", "concat('NATION_', id) AS n_name")
    for name, table in (("orders", orders), ("nation", nations)):
        pq.write_table(table.toArrow(), tmp_path / f"{name}.parquet")
    sf = str(tmp_path)
    found = contract.queries()["records_per_file"](spark, sf)
    fields = ["channel", "currency", "country", "day", "impressions", "cost"]
    written = sorted(map(tuple, queries.clean_ads(spark, sf).select(*fields).collect()), key=repr)
    assert len(written) > 2000
    assert sorted(map(tuple, found.select(*fields[:3], "date_id", *fields[4:]).collect()), key=repr) == written
    assert found.agg(F.max("largest")).first()[0] == queries.FILE_ROWS
    assert difference(found, contract.oracle_sql()["records_per_file"], sf) is None


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 90_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30).alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write_partitioned(rows, str(tmp_path / "t"), ("day",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(tmp_path / "t" / "day=0")) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 90_000


def test_settings_are_restored_after_a_write(spark, lines, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    write_clean(clean_ads(lines(fb("20240601")), FB), str(tmp_path / "t"))
    assert spark.conf.get(key) == before


def test_existing_day_folders_can_be_read(spark, tmp_path):
    spark.createDataFrame(
        [("USD", "US", "20240603", 1, 2.0)],
        "currency string, country string, day string, impressions bigint, cost double",
    ).write.parquet(str(tmp_path / "year=2024" / "month=6" / "day=3"))
    row = read_clean(spark, str(tmp_path), day_partition="day").first()
    assert tuple(row) == ("USD", "US", "20240603", 1, 2.0)


def test_csv_roundtrip(spark, tmp_path):
    rows = [("1", 'with "quotes", comma'), ("2", None), ("3", "NA")]
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame(rows, "a string, b string"), path)
    assert sorted(map(tuple, read_csv(spark, path).collect())) == sorted(rows)
    with pytest.raises(Exception, match="(?i)exists"):
        write_csv(spark.createDataFrame(rows, "a string, b string"), path)


def test_staging_uses_the_folder_of_the_session(spark):
    folder = shared_folder(spark)
    assert new_path(spark, "x").startswith(folder)
    assert new_path(spark, "x") != new_path(spark, "x")


def test_jdbc_options():
    db = jdbc.Database("host", "ads", 3307, "me", "secret")
    assert "secret" not in repr(db)
    assert jdbc.read_options(db, "dim_country") == {
        "driver": "com.mysql.jdbc.Driver",
        "url": "jdbc:mysql://host:3307/ads",
        "dbtable": "dim_country",
        "user": "me",
        "password": "secret",
    }
    ranged = jdbc.read_options(
        db, "exchange_rates", partition_column="date_id", bounds=(20240101, 20241231), partitions=4
    )
    assert (ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("20240101", "20241231", "4")
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_options(db, "t", partition_column="date_id")
    written = jdbc.write_options(db, "fact_ad_performance", connections=8)
    assert (written["batchsize"], written["quoteIdentifiers"], written["numPartitions"]) == ("10000", "true", "8")


@pytest.fixture
def exports(tmp_path):
    raw = tmp_path / "raw"
    put(raw / "facebook_data" / "raw_data_fb_fb_20240601.txt", fb("20240601"), "broken", fb("20240601"))
    put(raw / "facebook_data" / "raw_data_fb_fb_20240602.txt", fb("20240602", "NA"), fb("x"), "")
    put(raw / "google_data" / "raw_data_ga_ga_20240601.txt", ga("20240601", 2516), ga("20240601", 7), ga("20240601", 2840, "x"))
    put(tmp_path / "geo.csv", "country_code,Country", "2516,XX", "2840,US", "2516,NA")
    put(tmp_path / "names.csv", "country,country_name", "US,United States", 'NA,"Namibia, N."')
    put(tmp_path / "rates.csv", "date_id,currency,exchange_rate_usd", "20240601,USD,1.0", "20240601,EUR,2.0")
    put(tmp_path / "channels.csv", "channel_id,channel", "1,facebook", "2,google")
    return tmp_path


def test_jobs_from_exports_to_fact(spark, exports):
    at = lambda name: str(exports / name)
    loading = ["--raw", at("raw"), "--geo", at("geo.csv"), "--out", at("clean"), "--layout", "days"]
    for _ in range(2):
        counts = ingest.run(ingest.arguments().parse_args(loading))
    assert counts["facebook"] == {"lines": 6, "malformed_json": 2, "invalid_day": 1, "invalid_metric": 0}
    assert counts["google"] == {"lines": 3, "malformed_json": 0, "invalid_day": 0, "invalid_metric": 1}

    load_country.run(
        load_country.arguments().parse_args(["--names", at("names.csv"), "--out", at("dim_country")])
    )
    arguments = [
        "--clean", at("clean"), "--countries", at("dim_country"), "--rates", at("rates.csv"),
        "--channel-table", at("channels.csv"), "--out", at("fact"), "--year", "2024", "--month", "6",
        "--layout", "days",
    ]
    for _ in range(2):
        seen = load_fact.run(load_fact.arguments().parse_args(arguments))
    assert seen == {"rows": 5, "no_country": 1, "no_rate": 1, "impressions_too_large": 0}
    rows = spark.read.parquet(at("fact")).select("channel_id", "date_id", "country_id", "impressions", "cost_usd")
    assert sorted([tuple(r) for r in rows.collect()], key=str) == sorted(
        [
            (1, 20240601, 2, 10, 1.5),
            (1, 20240601, 2, 10, 1.5),
            (1, 20240602, 1, 10, None),
            (2, 20240601, 1, 10, 3.0),
            (2, 20240601, None, 10, 3.0),
        ],
        key=str,
    )
    with pytest.raises(SystemExit, match="whole days"):
        load_fact.run(load_fact.arguments().parse_args([*arguments, "--channels", "google"]))


def test_quality_job(spark, exports):
    at = lambda name: str(exports / name)
    base = ["--raw", at("raw/google_data"), "--channel", "google", "--geo", at("geo.csv")]
    check_quality.run(
        check_quality.arguments().parse_args(["unmapped-codes", *base, "--out", at("unmapped")])
    )
    assert [r["country"] for r in read_csv(spark, at("unmapped")).collect()] == ["7"]
    check_quality.run(
        check_quality.arguments().parse_args(["null-metric", *base, "--out", at("nulls")])
    )
    assert read_csv(spark, at("nulls")).count() == 0


def test_geo_job(spark, exports):
    put(
        exports / "targets.csv",
        "Criteria ID,Name,Canonical Name,Parent ID,Country Code,Target Type,Status",
        "2004,Afghanistan,Afghanistan,,AF,Country,Active",
        "2008,Albania,Albania,,AL,Country,Active",
    )
    out = str(exports / "curated")
    curate_geo.run(
        curate_geo.arguments().parse_args(
            ["--targets", str(exports / "targets.csv"), "--out", out, "--first", "2", "--last", "9", "--rename"]
        )
    )
    rows = read_csv(spark, out)
    assert rows.columns == ["country", "country_name"]
    assert [tuple(r) for r in rows.collect()] == [("AL", "Albania")]
