"""One query per operator: the library applied to the derived ad data, whole tables each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendmart.functions import dates, numbers, text
from spendmart.loads import write_load
from spendmart.operators import geo, lookup, normalize, numbering, quality
from spendmart.operators.shape import select_once
from spendmart.plans import clean as clean_plan
from spendmart.plans import dims, fact, rollups
from spendmart.schemas import CHANNELS, EXCHANGE_RATE_COLUMNS
from spendmart.sinks import files as sinks
from spendmart.sources import files as sources
from spendmart.sources.merged import read_merged
from spendmart.sources.slices import file_row_range
from spendmart.staging import new_path

from . import inputs

FACEBOOK = CHANNELS["facebook"]
GOOGLE = CHANNELS["google"]
SLICE = (300, 1100)
FILE_ROWS = 400

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared pieces ----------------------------------------------------------


def clean_by_channel(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    codes = inputs.code_map(spark, sf)
    return {
        name: clean_plan.clean_ads(inputs.raw_lines(spark, sf, name), spec, codes)
        for name, spec in CHANNELS.items()
    }


def ads_by_channel(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: fact.with_date_id(c) for name, c in clean_by_channel(spark, sf).items()}


def combined(spark: SparkSession, sf: str) -> DataFrame:
    return fact.combine_channels(ads_by_channel(spark, sf))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return fact.build_fact(ads_by_channel(spark, sf), inputs.lookups(spark, sf))


def both(by_channel: dict[str, DataFrame]) -> DataFrame:
    """The channels' rows together, with a ``channel`` column."""
    tagged = [rows.withColumn("channel", F.lit(name)) for name, rows in by_channel.items()]
    return tagged[0].unionByName(tagged[1])


def as_numbers(rows: DataFrame) -> DataFrame:
    """Metrics as numbers, and whether a cost was there: JSON numbers of the feeds reach text
    columns in the parser's spelling."""
    return rows.select(
        "currency",
        "country",
        "day",
        numbers.parse_long(F.col("impressions")).alias("impressions"),
        numbers.parse_double(F.col("cost")).alias("cost"),
        F.col("cost").isNotNull().alias("has_cost"),
    )


def load_lines(spark: SparkSession, sf: str) -> dict[str, str]:
    """Every channel's lines as one load; the channels' paths."""
    root, codes = new_path(spark, "judged"), inputs.code_map(spark, sf)
    paths = {}
    for name, spec in CHANNELS.items():
        paths[name] = f"{root}/{spec.prefix}"
        lines = inputs.daily_lines(inputs.orders(spark, sf, name), name)
        write_load(clean_plan.judged_rows(lines, spec, codes), paths[name], clean_plan.JUDGED_LOADS)
    return paths


# --- sources and sinks ------------------------------------------------------


@query
def scan_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Text files in nested folders, read back as lines and counted by folder."""
    root = new_path(spark, "raw")
    for spec in CHANNELS.values():
        inputs.raw_lines(spark, sf, spec.channel).write.text(f"{root}/{spec.prefix}/daily")
    counts = []
    for spec in CHANNELS.values():
        lines = sources.read_raw_lines(spark, f"{root}/{spec.prefix}", dated_only=False)
        counts.append(
            lines.agg(
                F.lit(spec.prefix).alias("prefix"),
                F.count("*").alias("n_lines"),
                F.count_if(~F.col("line").endswith("}")).alias("n_cut"),
                F.sum(F.length("line")).alias("n_chars"),
            )
        )
    return counts[0].unionByName(counts[1])


@query
def json_lines_parse(spark: SparkSession, sf: str) -> DataFrame:
    """The raw values of well-formed lines, no defaults."""
    rows = {
        name: quality.raw_fields(inputs.raw_lines(spark, sf, name), spec) for name, spec in CHANNELS.items()
    }
    return both({name: as_numbers(r) for name, r in rows.items()})


@query
def file_date_filter(spark: SparkSession, sf: str) -> DataFrame:
    """File names of which some lack a date and some carry an impossible one."""
    key = F.col("key")
    name = (
        F.when(key % 7 == 0, F.concat(F.lit("raw_data_fb_"), key.cast("string"), F.lit(".txt")))
        .when(key % 11 == 0, F.lit("raw_data_fb_20240631.txt"))
        .when(key % 13 == 0, F.concat(F.col("day"), F.lit(".txt")))
        .otherwise(F.concat(F.lit("raw_data_fb_"), F.col("day"), F.lit(".txt")))
    )
    files = inputs.orders(spark, sf).select("key", name.alias("file_name"))
    return sources.dated_files(files)


@query
def file_account(spark: SparkSession, sf: str) -> DataFrame:
    """Real files, some of another kind, without a day, with an impossible one or a doubled suffix:
    which are read, which are skipped and why, and how many lines were read. One listing serves both."""
    key, month = F.col("key"), F.substring("day", 1, 6)
    name = (
        F.when(key % 17 == 0, F.concat(F.lit("raw_data_fb_"), month, F.lit("01.csv")))
        .when(key % 7 == 0, F.concat(F.lit("raw_data_fb_"), month, F.lit(".txt")))
        .when(key % 11 == 0, F.concat(F.lit("raw_data_fb_"), F.substring("day", 1, 4), F.lit("0231.txt")))
        .when(key % 13 == 0, F.concat(F.lit("raw_data_fb_"), month, F.lit("02.txt.txt")))
        .otherwise(F.concat(F.lit("raw_data_fb_"), month, F.lit("01.txt")))
    )
    path = new_path(spark, "named-files")
    lines = F.concat(F.col("key").cast("string"), F.lit(" "), F.col("currency"))
    inputs.write_named_files(inputs.orders(spark, sf).select(lines.alias("line"), name.alias("file_name")), path)
    files = sources.listed_files(spark, path)
    read = sources.read_listed_lines(spark, files).groupBy("file_name").agg(F.count("*").alias("n_lines"))
    return files.drop("path").join(read, "file_name", "left")


@query
def scan_geo_map(spark: SparkSession, sf: str) -> DataFrame:
    """A code map written as CSV and read back; ``NA`` must stay a country."""
    path = new_path(spark, "geo_map")
    targets = inputs.geo_targets(spark, sf)
    sinks.write_csv(
        targets.select(
            F.col("Criteria ID").alias("country_code"), F.col("Country Code").alias("Country")
        ),
        path,
    )
    codes = geo.geo_map(sources.read_csv(spark, path))
    return codes.select(F.col("code").alias("country_code"), F.col("iso").alias("country"))


@query
def scan_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """One month of the stored clean lines; other folders are neither listed nor read."""
    paths = load_lines(spark, sf)
    return both({name: clean_plan.read_accepted(spark, path, year=1998, month=6) for name, path in paths.items()})


@query
def scan_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Years stored without a country and with narrow impressions, and later ones with both wide."""
    path = new_path(spark, "clean-by-year")
    rows = clean_ads(spark, sf).drop("day_of_month", "month")
    early = rows.where("year < 1995").withColumn("impressions", F.col("impressions").cast("int")).drop("country")
    sinks.write_partitioned(early, path, ("year",), mode="append")
    sinks.write_partitioned(rows.where("year >= 1995"), path, ("year",), mode="append")
    return read_merged(spark, path, partitions=T.StructType([T.StructField("year", T.IntegerType())]))


@query
def scan_dims(spark: SparkSession, sf: str) -> DataFrame:
    """The rate table stored with numeric days, read with ``date_id`` as text."""
    rates = inputs.exchange_rates(spark, sf, numeric_days=True)
    return sources.project(rates, EXCHANGE_RATE_COLUMNS)


@query
def partitioned_write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    paths = load_lines(spark, sf)
    return both({name: clean_plan.read_accepted(spark, path) for name, path in paths.items()})


@query
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every line once: accepted ones with their fields, rejected ones with reason, file and length."""
    judged = {}
    for name, path in load_lines(spark, sf).items():
        good = clean_plan.read_accepted(spark, path).withColumn("reason", F.lit(quality.ACCEPTED))
        bad = clean_plan.read_rejected(spark, path)
        day = dates.date_id(F.col("year"), F.col("month"), F.col("day_of_month"))
        bad = bad.select("reason", day.alias("date_id"), "file_name", F.length("line").alias("n_chars"))
        judged[name] = good.unionByName(bad, allowMissingColumns=True)
    return both(judged)


@query
def clean_reload(spark: SparkSession, sf: str) -> DataFrame:
    """June 1998 comes again with no valid cost: its days are empty, the others as before."""
    paths, codes = load_lines(spark, sf), inputs.code_map(spark, sf)
    for name, path in paths.items():
        june = inputs.orders(spark, sf, name).where(F.col("day").startswith("199806"))
        lines = inputs.daily_lines(june.withColumn("flaw", F.lit("comma_cost")), name)
        write_load(clean_plan.judged_rows(lines, CHANNELS[name], codes), path, clean_plan.JUDGED_LOADS)
    return both({name: clean_plan.read_accepted(spark, path) for name, path in paths.items()})


@query
def fact_write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "fact")
    fact.load_fact(facts(spark, sf), path)
    return fact.read_fact_loads(spark, path)


@query
def fact_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Google's June 1998 comes again at half the cost and without its 15th; Facebook's stays."""
    path = new_path(spark, "fact")
    fact.load_fact(facts(spark, sf), path)
    june = fact.read_fact_loads(spark, path, first_day="19980601", last_day="19980630").where("channel_id = 2")
    halved = june.where("date_id <> '19980615'").withColumn("cost_usd", F.col("cost_usd") * 0.5)
    fact.load_fact(halved, path, seen=june.select("channel_id", "date_id"))
    return fact.read_fact_loads(spark, path)


@query
def fact_period(spark: SparkSession, sf: str) -> DataFrame:
    """One month of the stored fact table; other months' folders are not listed."""
    path = new_path(spark, "fact")
    fact.load_fact(facts(spark, sf), path)
    return fact.read_fact_loads(spark, path, first_day="19980601", last_day="19980630")


@query
def records_per_file(spark: SparkSession, sf: str) -> DataFrame:
    """Clean rows written by channel and year with a limit of rows a file, and read back: each one whole,
    with its channel's and year's rows, files and the largest one's rows."""
    path, folder = new_path(spark, "clean"), ["channel", "year"]
    sinks.write_partitioned(clean_ads(spark, sf), path, tuple(folder), file_rows=FILE_ROWS)
    rows = spark.read.parquet(path)
    files = rows.groupBy(*folder, F.col("_metadata.file_path")).count()
    sizes = files.groupBy(*folder).agg(
        F.sum("count").alias("n_rows"), F.count("*").alias("n_files"), F.max("count").alias("largest")
    )
    fields = ("currency", "country", F.col("day").alias("date_id"), "impressions", "cost")
    # one row for each channel and year
    return rows.join(F.broadcast(sizes), folder).select(*folder, *fields, "n_rows", "n_files", "largest")


@query
def geo_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "geo_targets")
    sinks.write_csv(geo.curate_targets(inputs.geo_targets(spark, sf)), path)
    read = sources.read_csv(spark, path)
    return read.withColumnsRenamed(
        {"Criteria ID": "criteria_id", "Country Code": "country_code", "Name": "name"}
    )


# --- projections ------------------------------------------------------------


@query
def normalize_facebook(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalize(inputs.raw_lines(spark, sf, "facebook"), FACEBOOK)


@query
def normalize_google(spark: SparkSession, sf: str) -> DataFrame:
    codes = inputs.code_map(spark, sf)
    rows = normalize.normalize(inputs.raw_lines(spark, sf, "google"), GOOGLE, codes)
    # JSON numbers reach the text columns in the parser's spelling, so they are compared as
    # numbers here.
    return rows.select(
        "currency",
        "country",
        "day",
        numbers.parse_long(F.col("impressions")).alias("impressions"),
        numbers.parse_double(F.col("cost")).alias("cost"),
    )


@query
def join_country_fx(spark: SparkSession, sf: str) -> DataFrame:
    return fact.join_country_fx(combined(spark, sf), inputs.lookups(spark, sf))


@query
def channel_tag(spark: SparkSession, sf: str) -> DataFrame:
    prefix = F.when(F.col("key") % 2 == 0, FACEBOOK.prefix).otherwise(GOOGLE.prefix)
    return inputs.orders(spark, sf).select("key", text.channel_of_prefix(prefix).alias("channel"))


@query
def geo_targets_curate(spark: SparkSession, sf: str) -> DataFrame:
    return geo.curate_targets(inputs.geo_targets(spark, sf)).toDF(
        "criteria_id", "country_code", "name"
    )


@query
def geo_rename(spark: SparkSession, sf: str) -> DataFrame:
    return geo.rename_targets(geo.curate_targets(inputs.geo_targets(spark, sf)))


@query
def geo_slice_rename(spark: SparkSession, sf: str) -> DataFrame:
    """The whole curation: a range of the file's rows, filtered, projected and renamed."""
    return dims.curated_slice(spark, write_targets(spark, sf), *SLICE, rename=True)


# --- filters ----------------------------------------------------------------


@query
def drop_invalid_day(spark: SparkSession, sf: str) -> DataFrame:
    codes = inputs.code_map(spark, sf)
    rows = {
        name: quality.drop_invalid_day(normalize.normalize(inputs.raw_lines(spark, sf, name), spec, codes))
        for name, spec in CHANNELS.items()
    }
    return both({name: as_numbers(r) for name, r in rows.items()})


@query
def drop_invalid_metrics(spark: SparkSession, sf: str) -> DataFrame:
    codes = inputs.code_map(spark, sf)
    rows = {
        name: normalize.normalize(inputs.raw_lines(spark, sf, name), spec, codes)
        for name, spec in CHANNELS.items()
    }
    return both({name: quality.drop_invalid_metrics(r) for name, r in rows.items()})


@query
def null_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.raw_fields(inputs.raw_lines(spark, sf, "facebook"), FACEBOOK)
    return quality.null_metric_rows(rows)


@query
def row_range_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Rows 300 to 1100 of the targets in key order, wherever the rows are stored."""
    targets = inputs.geo_targets(spark, sf).select(
        F.col("Criteria ID").cast("bigint").alias("criteria_id"), F.col("Name").alias("name")
    )
    return numbering.rows_in_order(targets, ["criteria_id"], *SLICE)


def write_targets(spark: SparkSession, sf: str) -> str:
    """The targets as CSV in key order, in files of 200 rows."""
    path = new_path(spark, "targets")
    ordered = inputs.geo_targets(spark, sf).orderBy(F.col("Criteria ID").cast("bigint"))
    sinks.write_csv(ordered, path, file_rows=200)
    return path


@query
def file_order_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Rows 300 to 1100 as they lie in the files; files behind them are not read."""
    rows = file_row_range(spark, write_targets(spark, sf), *SLICE, name="row")
    return rows.select("row", F.col("Criteria ID").cast("bigint").alias("criteria_id"), F.col("Name").alias("name"))


# --- joins ------------------------------------------------------------------


@query
def geo_lookup_default(spark: SparkSession, sf: str) -> DataFrame:
    code = F.when(F.col("flaw") != "null_country", (F.col("country") + 2000).cast("string"))
    rows = inputs.orders(spark, sf).select("key", code.alias("country"))
    return geo.map_country_codes(rows, inputs.code_map(spark, sf), "country")


@query
def join_country(spark: SparkSession, sf: str) -> DataFrame:
    countries = lookup.sized_lookup(inputs.dim_country(spark, sf), ["country"])
    return lookup.join_country(combined(spark, sf), countries).select(
        "channel", "date_id", "country", "country_id"
    )


@query
def join_fx(spark: SparkSession, sf: str) -> DataFrame:
    rates = lookup.sized_lookup(inputs.exchange_rates(spark, sf), ["date_id", "currency"])
    return lookup.join_rates(combined(spark, sf), rates).select(
        "date_id", "currency", "cost", "exchange_rate_usd"
    )


@query
def join_channel(spark: SparkSession, sf: str) -> DataFrame:
    channels = lookup.sized_lookup(inputs.dim_channel(spark), ["channel"])
    return lookup.join_channel(combined(spark, sf), channels).select(
        "channel", "date_id", "impressions", "channel_id"
    )


@query
def unmapped_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.raw_fields(inputs.raw_lines(spark, sf, "google"), GOOGLE)
    missing = quality.unmapped_codes(rows, inputs.code_map(spark, sf))
    return missing.select("currency", F.col("country").alias("country_code"), "day")


# --- aggregations -----------------------------------------------------------


@query
def partition_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    clean = clean_by_channel(spark, sf)
    return both({name: clean_plan.partition_row_counts(rows) for name, rows in clean.items()})


@query
def ingest_reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = [
        quality.reject_counts(
            quality.validate(inputs.raw_lines(spark, sf, name), spec)
        ).select(F.lit(name).alias("channel"), "reason", "n")
        for name, spec in CHANNELS.items()
    ]
    return counts[0].unionByName(counts[1])


@query
def channel_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return fact.channel_row_counts(combined(spark, sf))


@query
def distinct_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.raw_fields(inputs.raw_lines(spark, sf, "google"), GOOGLE)
    return geo.distinct_codes(rows, "country").withColumnRenamed("country", "country_code")


@query
def dedup_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    customers = inputs.table(spark, sf, "customer").select(
        (F.col("c_nationkey") + 2000).cast("string").alias("country_code"),
        F.col("c_name").alias("country"),
        "c_custkey",
    )
    return geo.last_of_each_key(customers, ["country_code"], ["c_custkey"], ["country"])


# --- sort, union, scalar functions ------------------------------------------


@query
def preview_limit(spark: SparkSession, sf: str) -> DataFrame:
    rows = combined(spark, sf)
    order = ["date_id", "currency", "country", "impressions", "cost", "channel"]
    return fact.preview(rows.select(*order), 10, order)


@query
def union_channels(spark: SparkSession, sf: str) -> DataFrame:
    return combined(spark, sf)


@query
def json_get_default(spark: SparkSession, sf: str) -> DataFrame:
    """Absent cost becomes 0.0 and absent country empty text; null impressions stay null."""
    rows = {}
    for name, spec in CHANNELS.items():
        parsed = normalize.parse_lines(inputs.raw_lines(spark, sf, name), spec)
        fields = select_once(parsed, "well_formed", *normalize.common_fields(spec))
        rows[name] = as_numbers(fields.where("well_formed"))
    return both(rows)


@query
def string_fns(spark: SparkSession, sf: str) -> DataFrame:
    """File names with blanks of several kinds around them, other suffixes and doubled ones."""
    key = F.col("key")
    suffix = F.when(key % 5 == 0, ".csv").when(key % 5 == 1, ".TXT").when(key % 5 == 2, ".txt.txt").otherwise(".txt")
    name = F.concat(F.lit(" \t"), F.lit("raw data_"), F.col("day"), suffix, F.lit("\v \r\n"))
    return inputs.orders(spark, sf).select(
        "key",
        text.stripped(name).alias("stripped"),
        text.stripped(name).endswith(".txt").alias("is_txt"),
        text.file_day(text.stripped(name)).alias("last_part"),
        F.col("impressions").cast("string").alias("impressions_text"),
    )


def spelled_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days of which some don't exist, have marks, blanks or too few digits, or lie out of range."""
    key, day = F.col("key"), F.col("day")
    spelled = (
        F.when(key % 9 == 0, "20240631")
        .when(key % 9 == 1, F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)))
        .when(key % 9 == 2, F.concat(day, F.lit(" ")))
        .when(key % 9 == 3, F.substring(day, 1, 7))
        .when(key % 9 == 4, F.concat(F.lit("3"), F.substring(day, 2, 7)))
        .otherwise(day)
    )
    return inputs.orders(spark, sf).select("key", dates.parse_day(spelled).alias("date"))


@query
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return spelled_days(spark, sf).select(
        "key",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day_of_month"),
    )


@query
def date_format(spark: SparkSession, sf: str) -> DataFrame:
    """Days as text again, and the days before and after them."""
    return spelled_days(spark, sf).select(
        "key",
        dates.day_text(F.col("date")).alias("day"),
        dates.day_text(F.date_sub("date", 1)).alias("day_before"),
        dates.day_text(F.date_add("date", 1)).alias("day_after"),
    )


@query
def safe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Number spellings, good and bad, chosen by order key."""
    key = F.col("key")
    n = F.col("impressions").cast("string")
    spelled = (
        F.when(key % 10 == 0, F.concat(F.lit(" "), n, F.lit(" ")))
        .when(key % 10 == 1, F.concat(F.lit("+"), n))
        .when(key % 10 == 2, F.concat(n, F.lit("e1")))
        .when(key % 10 == 3, F.concat(F.lit("-"), n, F.lit(".9")))
        .when(key % 10 == 4, F.concat(n, F.lit("d")))
        .when(key % 10 == 5, F.lit("1e400"))
        .when(key % 10 == 6, F.lit("nan"))
        .when(key % 10 == 7, F.lit("1,234"))
        .when(key % 10 == 8, F.lit(""))
        .otherwise(n)
    )
    return inputs.orders(spark, sf).select(
        "key",
        numbers.parse_long(spelled).alias("whole"),
        numbers.parse_double(spelled).alias("number"),
    )


@query
def round_cost(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.orders(spark, sf).select(
        "key", numbers.round_cost(F.col("cost") / F.lit(7.0)).alias("cost")
    )


@query
def date_id(spark: SparkSession, sf: str) -> DataFrame:
    date = dates.parse_day(F.col("day"))
    parts = F.year(date), F.month(date), F.dayofmonth(date)
    return inputs.orders(spark, sf).select("key", dates.date_id(*parts).alias("date_id"))


@query
def cost_to_usd(spark: SparkSession, sf: str) -> DataFrame:
    joined = fact.join_country_fx(combined(spark, sf), inputs.lookups(spark, sf))
    return fact.with_cost_usd(joined).select("date_id", "currency", "cost_original", "cost_usd")


# --- pipelines --------------------------------------------------------------


@query
def clean_ads(spark: SparkSession, sf: str) -> DataFrame:
    frames = [c.withColumn("channel", F.lit(n)) for n, c in clean_by_channel(spark, sf).items()]
    return frames[0].unionByName(frames[1])


@query
def dim_country_build(spark: SparkSession, sf: str) -> DataFrame:
    """Country names written as CSV, read back and given ids."""
    path = new_path(spark, "country_names")
    names = inputs.table(spark, sf, "customer").select(
        F.col("c_name").alias("country"),
        F.concat(F.lit('The "'), F.col("c_mktsegment"), F.lit('", one')).alias("country_name"),
    )
    sinks.write_csv(names, path)
    return dims.build_dim_country(sources.read_csv(spark, path))


@query
def dim_country_growth(spark: SparkSession, sf: str) -> DataFrame:
    """One segment's countries, then all of them: the first keep their ids."""
    path = new_path(spark, "dim_country")
    names = inputs.table(spark, sf, "customer").select(
        F.col("c_name").alias("country"), F.lower("c_mktsegment").alias("country_name"), "c_mktsegment"
    )
    dims.grow_dim_country(names.where("c_mktsegment = 'BUILDING'"), path)
    dims.grow_dim_country(names, path)
    return spark.read.parquet(path)


@query
def fact_ad_performance(spark: SparkSession, sf: str) -> DataFrame:
    return facts(spark, sf)


# --- dashboard summaries ----------------------------------------------------


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    """Engines turn a decimal into a double with different last bits."""
    return rows.withColumns({c: F.round(c, 4) for c in columns})


@query
def rollup_channel_day(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rollups.spend_by_channel_and_day(facts(spark, sf)), "cost_usd")


@query
def rollup_country_top(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rollups.top_countries(facts(spark, sf), 10), "cost_usd")


@query
def cpm_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rollups.cpm_by_channel(facts(spark, sf)), "cost_usd", "cpm")
