"""Clean Parquet + lookup tables -> fact rows, to Parquet or a database."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from jobs.common import add_database_arguments, database, lookup_table
from spendmart.functions.dates import date_id
from spendmart.loads import seen_keys
from spendmart.operators.shape import union_all
from spendmart.plans.clean import JUDGED_LOADS, in_period, read_accepted
from spendmart.plans.fact import Lookups, build_fact, load_fact
from spendmart.schemas import (
    CHANNELS,
    DIM_CHANNEL_COLUMNS,
    DIM_COUNTRY_COLUMNS,
    EXCHANGE_RATE_COLUMNS,
    channel_spec,
)
from spendmart.session import get_session
from spendmart.sinks.files import write_fact
from spendmart.sources.files import read_clean
from spendmart.sources.jdbc import append_table


def clean_by_channel(spark, args: argparse.Namespace) -> dict[str, DataFrame]:
    read = {}
    for channel in args.channels:
        path = f"{args.clean}/{channel_spec(channel).prefix}"
        if args.layout == "loads":
            read[channel] = read_accepted(spark, path, year=args.year, month=args.month)
        else:
            read[channel] = read_clean(spark, path, year=args.year, month=args.month, day_partition=args.day_partition)
    return read


def days_seen(spark, args: argparse.Namespace, channels: DataFrame) -> DataFrame:
    """``channel_id, date_id`` of every day that the period's clean loads saw, with rows or without."""
    days = []
    for channel in args.channels:
        keys = seen_keys(spark, f"{args.clean}/{channel_spec(channel).prefix}", JUDGED_LOADS, in_period(args.year, args.month))
        day = date_id(F.col("year"), F.col("month"), F.col("day_of_month"))
        days.append(keys.where("year is not null").select(F.lit(channel).alias("channel"), day.alias("date_id")))
    return union_all(days).join(channels, "channel", "left").select("channel_id", "date_id")


def run(args: argparse.Namespace) -> dict:
    db = database(args)
    partly = set(args.channels) != set(CHANNELS)
    if db is None and args.layout == "days" and args.mode == "overwrite" and partly:
        raise SystemExit("overwrite replaces whole days of all channels: load all, or use --layout loads")
    if db is None and args.layout == "loads" and args.mode == "append":
        raise SystemExit("loads replace the days they see; --mode append goes with --layout days")
    spark = get_session("load fact")
    # The prefix of the days loaded; without a year there is none.
    period = ""
    if args.year is not None:
        period = f"{args.year:04d}" + (f"{args.month:02d}" if args.month is not None else "")
    lookups = Lookups.checked(
        lookup_table(spark, args.countries, DIM_COUNTRY_COLUMNS, db),
        lookup_table(spark, args.rates, EXCHANGE_RATE_COLUMNS, db),
        lookup_table(spark, args.channel_table, DIM_CHANNEL_COLUMNS, db),
        date_prefix=period,
        allow_repeated_keys=args.allow_repeated_keys,
    )
    seen = Observation()
    fact = build_fact(clean_by_channel(spark, args), lookups).observe(
        seen,
        F.count("*").alias("rows"),
        F.count_if(F.col("country_id").isNull()).alias("no_country"),
        F.count_if(F.col("cost_usd").isNull()).alias("no_rate"),
        F.count_if(F.col("impressions").isNull()).alias("impressions_too_large"),
    )
    if db is not None:
        append_table(fact, db, args.out, connections=args.db_connections)
    elif args.layout == "loads":
        load_fact(fact, args.out, seen=days_seen(spark, args, lookups.channels))
    else:
        write_fact(fact, args.out, mode=args.mode)
    print(seen.get)
    return seen.get


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--clean", required=True, help="output folder of the ingest job")
    parser.add_argument("--countries", required=True, help="table name or CSV/Parquet path")
    parser.add_argument("--rates", required=True)
    parser.add_argument("--channel-table", required=True)
    parser.add_argument("--out", required=True, help="folder, or table name with a database")
    parser.add_argument("--channels", nargs="+", default=list(CHANNELS))
    parser.add_argument("--year", type=int)
    parser.add_argument("--month", type=int)
    parser.add_argument(
        "--layout",
        choices=["loads", "days"],
        default="loads",
        help="of the clean and the fact table: loads replaces the days and channels loaded, days whole days",
    )
    parser.add_argument("--day-partition", default="day_of_month", help="for --layout days")
    parser.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    parser.add_argument(
        "--allow-repeated-keys",
        action="store_true",
        help="let a repeated lookup key multiply rows instead of stopping",
    )
    add_database_arguments(parser)
    return parser


if __name__ == "__main__":
    run(arguments().parse_args())
