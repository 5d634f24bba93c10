"""Quality questions on raw exports: rows without impressions, codes the map lacks."""

from __future__ import annotations

import argparse

from jobs.ingest import read_geo_map
from spendmart.operators.quality import null_metric_rows, raw_fields, unmapped_codes
from spendmart.schemas import CHANNELS, channel_spec
from spendmart.session import get_session
from spendmart.sinks.files import write_csv
from spendmart.sources.files import read_raw_lines


def run(args: argparse.Namespace) -> None:
    spark = get_session("check quality")
    rows = raw_fields(read_raw_lines(spark, args.raw), channel_spec(args.channel))
    if args.check == "null-metric":
        found = null_metric_rows(rows, args.metric)
    else:
        found = unmapped_codes(rows, read_geo_map(spark, args.geo))
    write_csv(found, args.out)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("check", choices=["null-metric", "unmapped-codes"])
    parser.add_argument("--raw", required=True)
    parser.add_argument("--channel", choices=list(CHANNELS), required=True)
    parser.add_argument("--metric", choices=["impressions", "cost"], default="impressions")
    parser.add_argument("--geo", help="country code map CSV for unmapped-codes")
    parser.add_argument("--out", required=True, help="folder that does not exist yet")
    return parser


if __name__ == "__main__":
    run(arguments().parse_args())
