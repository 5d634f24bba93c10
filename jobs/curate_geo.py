"""Geo-targets CSV -> the countries and regions in a row range, as CSV."""

from __future__ import annotations

import argparse

from spendmart.plans.dims import curated_slice
from spendmart.schemas import GEO_FIRST_ROW, GEO_LAST_ROW
from spendmart.session import get_session
from spendmart.sinks.files import write_csv


def run(args: argparse.Namespace) -> None:
    spark = get_session("curate geo targets")
    write_csv(curated_slice(spark, args.targets, args.first, args.last, rename=args.rename), args.out)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--targets", required=True)
    parser.add_argument("--out", required=True, help="folder that does not exist yet")
    parser.add_argument("--first", type=int, default=GEO_FIRST_ROW)
    parser.add_argument("--last", type=int, default=GEO_LAST_ROW)
    parser.add_argument("--rename", action="store_true", help="write country, country_name")
    return parser


if __name__ == "__main__":
    run(arguments().parse_args())
