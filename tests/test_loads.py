"""Tables kept as loads, merged schemas, slices in file order, the growing dimension, file accounts."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobs import ingest, load_country, load_fact
from plans_text import plan
from spendmart import loads
from spendmart.loads import Layout, load_counts, read_loads, remove_superseded, seen_keys, write_load
from spendmart.operators.normalize import common_fields, parse_lines
from spendmart.operators.shape import select_once
from spendmart.plans import clean, dims, rollups
from spendmart.schemas import CHANNELS
from spendmart.sources.files import listed_files, read_listed_lines
from spendmart.sources.merged import common_type, merged_schema, read_merged
from spendmart.sources.slices import file_row_range, overlapping_files
from test_files import fb, ga, put

FB, GA = CHANNELS["facebook"], CHANNELS["google"]
TYPES = {"int": T.IntegerType, "bigint": T.LongType, "string": T.StringType, "float": T.FloatType, "date": T.DateType}


def struct(ddl):
    fields = (f.split() for f in ddl.split(", "))
    return T.StructType([T.StructField(name, TYPES[kind]()) for name, kind in fields])


LAYOUT = Layout(struct("v int, part string, kind string, day int"), folders=("kind", "part"), keys=("day",))


def table(spark, *rows):
    return spark.createDataFrame(rows, LAYOUT.schema)


def values(spark, path, wanted=None):
    return sorted(r["v"] for r in read_loads(spark, path, LAYOUT, wanted).collect())


# --- loads


def test_a_load_replaces_the_keys_it_saw(spark, tmp_path):
    path = str(tmp_path / "t")
    write_load(table(spark, (1, "a", "x", 1), (2, "a", "y", 1), (3, "a", "x", 2), (4, "b", "x", 3)), path, LAYOUT)
    assert values(spark, path) == [1, 2, 3, 4]
    # day 1 has rows of kind y only now: those of kind x are gone as well
    write_load(table(spark, (5, "a", "y", 1)), path, LAYOUT)
    assert values(spark, path) == [3, 4, 5]
    assert values(spark, path, F.col("kind") == "x") == [3, 4]
    write_load(table(spark), path, LAYOUT, seen=spark.createDataFrame([(2,), (9,)], "day int"))
    assert values(spark, path) == [4, 5]
    assert sorted(r["day"] for r in seen_keys(spark, path, LAYOUT).collect()) == [1, 2, 3, 9]
    counts = load_counts(spark, path, LAYOUT, ["kind"])
    assert {r["kind"]: r["n"] for r in counts.collect()} == {"x": 1, "y": 1}


def test_null_keys_and_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    write_load(table(spark, (1, None, "x", None), (2, None, "x", 1)), path, LAYOUT)
    write_load(table(spark, (3, None, "x", None)), path, LAYOUT)
    assert values(spark, path) == [2, 3]
    with pytest.raises(Exception, match="no name for a folder"):
        write_load(table(spark, (4, "a/b", "x", 5)), path, LAYOUT)
    assert values(spark, path) == [2, 3]


def test_an_unfinished_load_is_never_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_load(table(spark, (1, "a", "x", 1)), path, LAYOUT)
    # rows without a manifest: the load died between the two
    table(spark, (2, "a", "x", 1)).write.partitionBy("kind", "part").parquet(f"{path}/rows/load={loads.new_load()}")
    assert values(spark, path) == [1]


def test_whole_folders_are_read_without_a_join(spark, tmp_path):
    path = str(tmp_path / "t")
    write_load(table(spark, (1, "a", "x", 1), (2, "a", "x", 2), (3, "b", "x", 3)), path, LAYOUT)
    text = plan(read_loads(spark, path, LAYOUT, F.col("part") == "b"))
    assert "Join" not in text and "part=b" in text and "part=a" not in text
    write_load(table(spark, (4, "a", "x", 2)), path, LAYOUT)
    assert values(spark, path) == [1, 3, 4]
    assert "BroadcastHashJoin" in plan(read_loads(spark, path, LAYOUT))


def test_loads_with_another_schema_are_aligned(spark, tmp_path):
    path = str(tmp_path / "t")
    narrow = Layout(struct("part string, kind string, day int"), LAYOUT.folders, LAYOUT.keys)
    write_load(spark.createDataFrame([("a", "x", 1)], narrow.schema), path, narrow)
    write_load(table(spark, (7, "a", "x", 2)), path, LAYOUT)
    wide = Layout(struct("v bigint, part string, kind string, day int"), LAYOUT.folders, LAYOUT.keys)
    rows = read_loads(spark, path, wide)
    assert dict(rows.dtypes)["v"] == "bigint"
    assert sorted(((r["day"], r["v"]) for r in rows.collect())) == [(1, None), (2, 7)]


def test_superseded_loads_can_be_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1, 2, 3):
        write_load(table(spark, (v, "a", "x", 1)), path, LAYOUT)
    assert remove_superseded(spark, path, LAYOUT) == 2
    assert values(spark, path) == [3] and len(list((Path(path) / "rows").iterdir())) == 1


# --- clean lines


def test_every_line_is_kept_with_its_verdict(spark, tmp_path):
    put(tmp_path / "raw_fb_20240601.txt", fb("20240601"), "broken", fb("20240602", cost="x"), fb("nonsense"))
    put(tmp_path / "raw_fb_20240603.txt", fb("20240604", impressions=None))
    files = listed_files(spark, str(tmp_path))
    path = str(tmp_path / "out")
    write_load(clean.judged_rows(read_listed_lines(spark, files), FB), path, clean.JUDGED_LOADS)
    assert [r["date_id"] for r in clean.read_accepted(spark, path).collect()] == ["20240601"]
    bad = {(r["reason"], r["day_of_month"], r["line"]) for r in clean.read_rejected(spark, path).collect()}
    assert bad == {
        ("malformed_json", 1, "broken"),
        ("invalid_metric", 2, fb("20240602", cost="x")),
        ("invalid_day", 1, fb("nonsense")),
        ("invalid_metric", 4, fb("20240604", impressions=None)),
    }
    # the day comes again and all of it is rejected: nothing of it is left among the accepted
    put(tmp_path / "again" / "raw_fb_20240601.txt", fb("20240601", cost="1,5"))
    again = read_listed_lines(spark, listed_files(spark, str(tmp_path / "again")))
    write_load(clean.judged_rows(again, FB), path, clean.JUDGED_LOADS)
    assert clean.read_accepted(spark, path).count() == 0
    assert clean.read_accepted(spark, path, year=2024, month=6).columns[2] == "date_id"
    assert clean.read_rejected(spark, path).count() == 3
    with pytest.raises(ValueError, match="needs its year"):
        clean.read_accepted(spark, path, month=6)


def test_one_pass_writes_both(spark, tmp_path):
    lines = spark.createDataFrame([(fb("20240601"), "raw_fb_20240601.txt")], "line string, file_name string")
    text = plan(clean.judged_rows(lines, FB))
    assert text.count("from_json(StructField") == 1 and text.count("from_json(MapType") <= 1


def test_defaults_need_one_map_parse(spark, lines):
    for spec in (FB, GA):
        parsed = parse_lines(lines(fb("20240601")), spec)
        text = plan(select_once(parsed, *common_fields(spec)))
        assert text.count("from_json(MapType") == 1


def test_absent_and_null_fields(spark, lines):
    some = lines(json.dumps({"Day": "20240601", "Impressions": None}), json.dumps({"Country": None, "Amount spent": "2"}), "[]")
    rows = select_once(parse_lines(some, FB), *common_fields(FB)).collect()
    assert tuple(rows[0]) == ("", "", "20240601", None, "0.0")
    assert tuple(rows[1]) == ("", None, "", "0", "2")
    assert tuple(rows[2]) == (None,) * 5


# --- files


def test_one_listing_accounts_for_all_files(spark, tmp_path):
    put(tmp_path / "raw_fb_20240601.txt", "a", "b")
    put(tmp_path / "deep" / "raw_fb_20240602.txt.txt", "c")
    put(tmp_path / "raw_fb_20240631.txt", "no such day")
    put(tmp_path / "raw_fb_latest.txt", "no day")
    files = listed_files(spark, str(tmp_path))
    found = {r["file_name"]: (r["file_day"], r["skipped"]) for r in files.collect()}
    assert found == {
        "raw_fb_20240601.txt": ("20240601", None),
        "raw_fb_20240602.txt.txt": ("20240602", None),
        "raw_fb_20240631.txt": ("20240631", "no_such_day"),
        "raw_fb_latest.txt": ("", "no_day"),
    }
    assert sorted(r["line"] for r in read_listed_lines(spark, files).collect()) == ["a", "b", "c"]
    assert read_listed_lines(spark, files.where("skipped is not null")).count() == 0


def test_slice_reads_only_overlapping_files(spark, tmp_path):
    for i in range(40):
        put(tmp_path / "t" / f"part-{i:03d}.csv", "k,v", *(f"{i * 10 + j},x" for j in range(10 if i != 3 else 0)))
    path = str(tmp_path / "t")
    rows = file_row_range(spark, path, 26, 41, name="row")
    # the file without rows takes no place
    assert [(r["row"], int(r["k"])) for r in rows.orderBy("row").collect()] == [
        (n, n - 1 if n <= 30 else n + 9) for n in range(26, 42)
    ]
    assert sorted(Path(f).name for f in rows.inputFiles()) == ["part-002.csv", "part-004.csv", "part-005.csv"]
    assert overlapping_files(spark, path, 1, 10) == ([f"file:{path}/part-000.csv"], 0)
    assert file_row_range(spark, path, 389, 500).count() == 2
    empty = file_row_range(spark, path, 1000, 2000, name="row")
    assert empty.count() == 0 and empty.columns == ["k", "v", "row"]
    with pytest.raises(ValueError, match="no rows"):
        file_row_range(spark, path, 5, 4)


def test_counting_stops_behind_the_last_row(spark, tmp_path, monkeypatch):
    from spendmart.sources import slices

    for i in range(100):
        put(tmp_path / f"part-{i:03d}.csv", "k", *map(str, range(5)))
    counted = []
    real = slices._row_counts
    monkeypatch.setattr(slices, "_row_counts", lambda s, files, **o: counted.extend(files) or real(s, files, **o))
    overlapping_files(spark, str(tmp_path), 3, 12)
    assert len(counted) == spark.sparkContext.defaultParallelism


# --- schemas


def test_types_are_widened(spark):
    wide = merged_schema([struct(d) for d in ("a int, b float", "c date, a bigint", "b int, c string")])
    assert wide.simpleString() == "struct<a:bigint,b:double,c:string>"
    assert common_type(T.DateType(), T.TimestampType()) == T.TimestampType()


def test_merged_days(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.0)], "n int, cost double").write.parquet(f"{path}/day=1")
    spark.createDataFrame([(3_000_000_000, "US")], "n bigint, country string").write.parquet(f"{path}/day=2")
    rows = read_merged(spark, path, partitions=struct("day int"))
    assert dict(rows.dtypes) == {"n": "bigint", "cost": "double", "country": "string", "day": "int"}
    assert sorted((r["day"], r["n"], r["cost"], r["country"]) for r in rows.collect()) == [
        (1, 1, 2.0, None), (2, 3_000_000_000, None, "US"),
    ]
    narrow = read_merged(spark, path, partitions=struct("day int"), schema=struct("n int, day int"))
    with pytest.raises(Exception, match="(?i)overflow"):
        narrow.collect()


# --- the growing dimension


def test_earlier_ids_stay(spark, tmp_path):
    path = str(tmp_path / "dim")
    names = lambda *rows: spark.createDataFrame(rows, "country string, country_name string")
    dims.grow_dim_country(names(("DE", "Germany"), ("NA", "Namibia")), path)
    for _ in range(2):
        dims.grow_dim_country(names(("AT", "Austria"), ("DE", "Deutschland"), ("FR", "b"), ("FR", "a")), path)
    got = {r["country"]: (r["country_id"], r["country_name"]) for r in spark.read.parquet(path).collect()}
    assert got == {"DE": (1, "Germany"), "NA": (2, "Namibia"), "AT": (3, "Austria"), "FR": (4, "a")}


# --- sums


def test_large_costs_count_and_order_does_not(spark):
    rows = [(1, 5e22), (1, 2.0), (2, 0.1), (2, 0.2), (2, -0.3), (3, None), (4, float("inf")), (5, 1e300), (5, 1e9)]
    fact = spark.createDataFrame([(c, "20240601", 1, 1, x) for c, x in rows], "channel_id int, date_id string, country_id int, impressions int, cost_usd double")
    got = {r["channel_id"]: r["cost_usd"] for r in rollups.spend_by_channel_and_day(fact).collect()}
    assert got[1] == 5e22 + 2.0 and got[5] == 1e300 + 1e9 and got[3] is None and got[4] != got[4]
    assert abs(got[2]) < 1e-15
    shuffled = fact.orderBy(F.rand(1))
    assert {r["channel_id"]: r["cost_usd"] for r in rollups.spend_by_channel_and_day(shuffled.where("channel_id = 2")).collect()} == {2: got[2]}


# --- jobs


def test_jobs_reload_one_channel_and_empty_a_day(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    put(tmp_path / "raw/facebook_data/raw_fb_20240601.txt", fb("20240601"), "broken")
    put(tmp_path / "raw/facebook_data/raw_fb_20240602.txt", fb("20240602"))
    put(tmp_path / "raw/google_data/raw_ga_20240601.txt", ga("20240601", 2840))
    put(tmp_path / "raw/google_data/raw_ga_later.txt", ga("20240601", 2840))
    put(tmp_path / "geo.csv", "country_code,Country", "2840,US")
    put(tmp_path / "names.csv", "country,country_name", "US,United States")
    put(tmp_path / "rates.csv", "date_id,currency,exchange_rate_usd", "20240601,USD,1.0", "20240601,EUR,2.0")
    put(tmp_path / "channels.csv", "channel_id,channel", "1,facebook", "2,google")
    loading = ["--raw", at("raw"), "--geo", at("geo.csv"), "--out", at("clean")]
    counts = ingest.run(ingest.arguments().parse_args(loading))
    assert counts["facebook"] == {"lines": 3, "malformed_json": 1, "invalid_day": 0, "invalid_metric": 0}
    assert counts["google"] == {"lines": 1, "malformed_json": 0, "invalid_day": 0, "invalid_metric": 0}
    for _ in range(2):
        load_country.run(load_country.arguments().parse_args(["--names", at("names.csv"), "--out", at("dim")]))
    arguments = [
        "--clean", at("clean"), "--countries", at("dim"), "--rates", at("rates.csv"),
        "--channel-table", at("channels.csv"), "--out", at("fact"), "--year", "2024", "--month", "6",
    ]
    load_fact.run(load_fact.arguments().parse_args(arguments))

    def facts():
        from spendmart.plans.fact import read_fact_loads

        return sorted((r["channel_id"], r["date_id"], r["cost_usd"]) for r in read_fact_loads(spark, at("fact")).collect())

    assert facts() == [(1, "20240601", 1.5), (1, "20240602", None), (2, "20240601", 3.0)]
    # Facebook's first day comes again without a valid line; Google is not loaded
    put(tmp_path / "raw/facebook_data/raw_fb_20240601.txt", fb("20240601", cost="?"))
    only = ["--channels", "facebook"]
    ingest.run(ingest.arguments().parse_args([*loading, *only]))
    load_fact.run(load_fact.arguments().parse_args([*arguments, *only]))
    assert facts() == [(1, "20240602", None), (2, "20240601", 3.0)]
    with pytest.raises(SystemExit, match="replace"):
        load_fact.run(load_fact.arguments().parse_args([*arguments, "--mode", "append"]))
