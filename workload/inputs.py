"""Ad data derived from the driver's tables with column expressions.

Every order becomes one raw line of one channel; the line's text is built from the order, and
the order key decides which flaw, if any, the line carries. ``FIXTURES.md`` lists the flaws
and what must become of them. ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmart.functions.dates import day_text
from spendmart.operators.geo import geo_map
from spendmart.operators.lookup import sized_lookup
from spendmart.operators.shape import select_once
from spendmart.plans.fact import Lookups
from spendmart.staging import staged

# Fixed values, shared with oracle.py: (divisor of the order key, flaw); first match wins.
FLAWS = (
    (97, "truncated"),
    (89, "impossible_day"),
    (83, "comma_cost"),
    (79, "no_cost"),
    (73, "null_impressions"),
    (71, "fraction"),
    (67, "suffix_cost"),
    (61, "no_country"),
    (59, "null_country"),
    (53, "repeated_day"),
    (47, "trailing_text"),
    (43, "long_cost"),
    (41, "odd_number"),
    (37, "not_finite"),
)
COUNTRIES = 27  # two more than the nation table has
MAPPED_NATIONS = 23  # codes of the remaining ones are not in the code map
UNRATED_CURRENCY = "5-LOW"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The same text in Spark SQL and in the oracle's SQL.
FLAW_SQL = (
    "CASE "
    + " ".join(f"WHEN o_orderkey % {d} = 0 THEN '{name}'" for d, name in FLAWS)
    + " ELSE 'none' END"
)


def orders(spark: SparkSession, sf_dir: str, channel: str | None = None) -> DataFrame:
    """One row per order with the parts a raw line is made of."""
    source = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    if channel is not None:
        source = source.where(key % 2 == (0 if channel == "facebook" else 1))
    return source.select(
        key.alias("key"),
        F.expr(FLAW_SQL).alias("flaw"),
        F.col("o_orderpriority").alias("currency"),
        (F.col("o_custkey") % COUNTRIES).alias("country"),
        day_text(F.col("o_orderdate")).alias("day"),
        (key % 10007).alias("impressions"),
        F.col("o_totalprice").alias("cost"),
    )


# Members of a raw line as SQL text, by flaw. Facebook has text values only; Google has numbers,
# and country codes that are numbers in some lines and text in others.
FACEBOOK_LINE = """concat(
  '{"Currency":"', currency, '"',
  CASE flaw WHEN 'no_country' THEN ''
            WHEN 'null_country' THEN ',"Country":null'
            ELSE concat(',"Country":"NATION_', country, '"') END,
  CASE flaw WHEN 'impossible_day' THEN ',"Day":"20240631"'
            WHEN 'repeated_day' THEN concat(',"Day":"19000101","Day":"', day, '"')
            ELSE concat(',"Day":"', day, '"') END,
  CASE flaw WHEN 'null_impressions' THEN ',"Impressions":null'
            WHEN 'fraction' THEN concat(',"Impressions":"', impressions, '.7"')
            WHEN 'odd_number' THEN concat(',"Impressions":" ', impressions, ' "')
            ELSE concat(',"Impressions":"', impressions, '"') END,
  CASE flaw WHEN 'comma_cost' THEN ',"Amount spent":"1,234"'
            WHEN 'no_cost' THEN ''
            WHEN 'suffix_cost' THEN ',"Amount spent":"12d"'
            WHEN 'long_cost' THEN concat(',"Amount spent":"', key % 1000, '.12345678"')
            WHEN 'not_finite' THEN ',"Amount spent":"inf"'
            ELSE concat(',"Amount spent":"', cost, '"') END,
  '}')"""
GOOGLE_LINE = """concat(
  '{"Currency code":"', currency, '"',
  CASE WHEN flaw = 'no_country' THEN ''
       WHEN flaw = 'null_country' THEN ',"country_code":null'
       WHEN key % 4 = 1 THEN concat(',"country_code":', country + 2000)
       ELSE concat(',"country_code":"', country + 2000, '"') END,
  CASE flaw WHEN 'impossible_day' THEN ',"Day":"20240631"'
            WHEN 'repeated_day' THEN concat(',"Day":"19000101","Day":"', day, '"')
            ELSE concat(',"Day":"', day, '"') END,
  CASE flaw WHEN 'null_impressions' THEN ',"Impr.":null'
            WHEN 'fraction' THEN concat(',"Impr.":', impressions, '.7')
            WHEN 'odd_number' THEN concat(',"Impr.":', impressions, 'e1')
            ELSE concat(',"Impr.":', impressions) END,
  CASE flaw WHEN 'comma_cost' THEN ',"Cost":"1,234"'
            WHEN 'no_cost' THEN ''
            WHEN 'suffix_cost' THEN ',"Cost":"12d"'
            WHEN 'long_cost' THEN concat(',"Cost":', key % 1000, '.12345678')
            WHEN 'not_finite' THEN ',"Cost":NaN'
            ELSE concat(',"Cost":', cost) END,
  '}')"""
ENDED_LINE = """CASE flaw WHEN 'truncated' THEN substring(line, 1, length(line) - 5)
          WHEN 'trailing_text' THEN concat(line, ' tail}')
          ELSE line END"""


def lines_of(rows: DataFrame, channel: str) -> DataFrame:
    """``line`` of rows as ``orders`` makes them, with their other columns."""
    line = F.expr(FACEBOOK_LINE if channel == "facebook" else GOOGLE_LINE)
    # Built once per order, as a file's lines would be.
    lines = select_once(rows, "key", "flaw", "day", line.alias("line"))
    return lines.withColumn("line", F.expr(ENDED_LINE))


def raw_lines(spark: SparkSession, sf_dir: str, channel: str) -> DataFrame:
    """``line``: one JSON text per order of the channel, flaws included."""
    return lines_of(orders(spark, sf_dir, channel), channel).select("line")


def daily_lines(rows: DataFrame, channel: str) -> DataFrame:
    """``line, file_name``: the lines of ``rows`` as they would lie in one file a day."""
    name = F.concat(F.lit(f"raw_data_{channel}_"), F.col("day"), F.lit(".txt"))
    return lines_of(rows, channel).select("line", name.alias("file_name"))


def write_named_files(rows: DataFrame, root: str) -> None:
    """Write ``line`` of ``rows`` to one text file for each ``file_name``, below ``root``.

    Spark names its files itself, so they are written to folders by name and then renamed.
    """
    spark = rows.sparkSession
    draft = f"{root}-draft"
    rows.select("line", "file_name").repartition("file_name").write.partitionBy("file_name").text(draft)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(root))
    for part in files.globStatus(path(f"{draft}/file_name=*/part-*")):
        name = part.getPath().getParent().getName().removeprefix("file_name=")
        files.rename(part.getPath(), path(f"{root}/{name}"))


def code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country code map over the nations, checked and marked for the lookup."""
    nations = table(spark, sf_dir, "nation").where(F.col("n_nationkey") < MAPPED_NATIONS)
    codes = geo_map(
        nations.select(
            (F.col("n_nationkey") + 2000).cast("string").alias("country_code"),
            F.col("n_name").alias("Country"),
        )
    )
    return sized_lookup(codes, ["code"])


def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return nations.select(
        F.col("n_nationkey").alias("country_id"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("Country "), F.col("n_nationkey").cast("string")).alias("country_name"),
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    return spark.range(1, 3, 1, 1).select(
        F.col("id").cast("int").alias("channel_id"),
        F.when(F.col("id") == 1, "facebook").otherwise("google").alias("channel"),
    )


def exchange_rates(spark: SparkSession, sf_dir: str, *, numeric_days: bool = False) -> DataFrame:
    """A rate for every day and currency that occurs, one currency excepted.

    Staged as a table, which is what rates are: the aggregation over all orders then runs once
    and not again for the size check and for the join. ``numeric_days`` stores ``date_id`` as
    a number.
    """
    pairs = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") != UNRATED_CURRENCY)
        .select(F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("c"))
        .distinct()
    )
    day = day_text(F.col("date"))
    rates = pairs.select(
        (day.cast("int") if numeric_days else day).alias("date_id"),
        F.col("c").alias("currency"),
        (F.lit(0.5) + (F.dayofyear("date") % 50) / F.lit(100.0)).alias("exchange_rate_usd"),
    )
    return staged(rates, "exchange_rates")


def lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    return Lookups.checked(
        dim_country(spark, sf_dir), exchange_rates(spark, sf_dir), dim_channel(spark)
    )


def geo_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A geo-targets table: every customer is one target, all columns text."""
    key = F.col("c_custkey")
    kind = F.when(key % 5 == 0, "Country").when(key % 5 == 1, "Region").otherwise("City")
    parent = F.when(key % 3 != 0, (F.lit(1000) + F.col("c_nationkey")).cast("string"))
    code = F.when(key % 50 == 0, "NA").otherwise(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    )
    return table(spark, sf_dir, "customer").select(
        (key + 100000).cast("string").alias("Criteria ID"),
        F.concat(F.col("c_name"), F.lit(", "), F.col("c_mktsegment")).alias("Name"),
        parent.alias("Parent ID"),
        code.alias("Country Code"),
        kind.alias("Target Type"),
    )
