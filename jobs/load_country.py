"""Country names CSV -> country dimension, to Parquet or a database."""

from __future__ import annotations

import argparse

from jobs.common import add_database_arguments, database
from spendmart.plans.dims import build_dim_country, country_names, grow_dim_country
from spendmart.session import get_session
from spendmart.sources.files import read_csv
from spendmart.sources.jdbc import append_table


def run(args: argparse.Namespace) -> None:
    spark = get_session("load country")
    names = read_csv(spark, args.names)
    db = database(args)
    if db is not None:
        # The database numbers the rows itself.
        append_table(country_names(names), db, args.out, connections=args.db_connections)
    elif args.mode == "grow":
        grow_dim_country(names, args.out)
    else:
        build_dim_country(names, args.first_id).write.mode(args.mode).parquet(args.out)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--names", required=True, help="CSV with country and country_name")
    parser.add_argument("--out", required=True, help="folder, or table name with a database")
    parser.add_argument("--first-id", type=int, default=1, help="not for --mode grow")
    parser.add_argument(
        "--mode",
        choices=["grow", "overwrite", "append", "errorifexists"],
        default="grow",
        help="grow adds countries the table lacks and keeps the others' ids",
    )
    add_database_arguments(parser)
    return parser


if __name__ == "__main__":
    run(arguments().parse_args())
