"""Arguments the jobs share."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from spendmart.sources.files import project, read_csv
from spendmart.sources.jdbc import Database, read_table

PASSWORD_VARIABLE = "SPENDMART_DB_PASSWORD"


def add_database_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--db-host", help="database host; without it tables are files")
    parser.add_argument("--db-port", type=int, default=3306)
    parser.add_argument("--db-name")
    parser.add_argument("--db-user", default="")
    parser.add_argument("--db-connections", type=int, help="tasks that write at the same time")


def database(args: argparse.Namespace) -> Database | None:
    if not args.db_host:
        return None
    password = os.environ.get(PASSWORD_VARIABLE)
    if not (args.db_name and args.db_user and password):
        raise SystemExit(f"a database needs --db-name, --db-user and {PASSWORD_VARIABLE}")
    return Database(args.db_host, args.db_name, args.db_port, args.db_user, password)


def lookup_table(
    spark: SparkSession, source: str, columns: dict[str, str], db: Database | None
) -> DataFrame:
    """A lookup table by name from the database, or by path from CSV or Parquet."""
    if db is not None:
        return read_table(spark, db, source, columns)
    if source.endswith(".csv"):
        return project(read_csv(spark, source), columns)
    return project(spark.read.parquet(source), columns)
