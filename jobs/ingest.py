"""Raw exports of all channels -> clean Parquet, with a count of rejected lines."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation
from pyspark.sql import functions as F

from spendmart.loads import load_counts, write_load
from spendmart.operators.geo import geo_map, last_of_each_key, map_key
from spendmart.operators.lookup import sized_lookup
from spendmart.operators.numbering import number_file_rows
from spendmart.operators.quality import REASONS, reject_metrics, validate
from spendmart.plans.clean import JUDGED_LOADS, clean_rows, judged_rows
from spendmart.schemas import CHANNELS, channel_spec
from spendmart.session import get_session
from spendmart.sinks.files import write_clean
from spendmart.sources.files import listed_files, read_csv, read_listed_lines


def read_geo_map(spark, path: str, missing: str | None = None):
    """The code map; where a code occurs again, the later row of the file counts."""
    numbered = number_file_rows(read_csv(spark, path, missing=missing, multi_line=True), "_row")
    spelled = numbered.withColumn("country_code", map_key(F.col("country_code").cast("string")))
    codes = last_of_each_key(spelled, ["country_code"], ["_row"], ["Country"])
    return sized_lookup(geo_map(codes), ["code"])


def run_loads(spark, args: argparse.Namespace, spec, lines, codes) -> dict[str, int]:
    """One load with accepted and rejected lines; counts from what it committed."""
    path = f"{args.out}/{spec.prefix}"
    load = write_load(
        judged_rows(lines, spec, codes), path, JUDGED_LOADS, gather=not args.in_place, file_rows=args.file_rows or None
    )
    counts = {row["reason"]: row["n"] for row in load_counts(spark, path, JUDGED_LOADS, ["reason"], load).collect()}
    return {"lines": sum(counts.values()), **{reason: counts.get(reason, 0) for reason in REASONS}}


def run_days(spark, args: argparse.Namespace, spec, lines, codes) -> dict[str, int]:
    """Accepted lines in day folders; counts as observed while writing."""
    seen = Observation()
    checked = validate(lines, spec).observe(seen, *reject_metrics())
    write_clean(
        clean_rows(checked, spec, codes),
        f"{args.out}/{spec.prefix}",
        mode=args.mode,
        gather=not args.in_place,
        file_rows=args.file_rows or None,
    )
    return seen.get


def run(args: argparse.Namespace) -> dict[str, dict]:
    if args.layout == "loads" and args.mode == "append":
        raise SystemExit("loads replace the days they see; --mode append goes with --layout days")
    spark = get_session("ingest")
    codes = read_geo_map(spark, args.geo, args.missing) if args.geo else None
    counts = {}
    for channel in args.channels:
        spec = channel_spec(channel)
        files = listed_files(spark, f"{args.raw}/{spec.prefix}")
        for row in files.where("skipped is not null").collect():
            print(channel, "left out:", row["file_name"], row["skipped"])
        write = run_loads if args.layout == "loads" else run_days
        counts[channel] = write(spark, args, spec, read_listed_lines(spark, files), codes)
        print(channel, counts[channel])
    return counts


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder with one subfolder per channel")
    parser.add_argument("--geo", help="country code map CSV, needed for channels with codes")
    parser.add_argument("--missing", help="text of the code map to read as null, such as NA")
    parser.add_argument("--out", required=True)
    parser.add_argument("--channels", nargs="+", default=list(CHANNELS))
    parser.add_argument(
        "--layout",
        choices=["loads", "days"],
        default="loads",
        help="loads keeps rejected lines and replaces every day seen; days has a folder a day and no manifest",
    )
    parser.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    parser.add_argument("--in-place", action="store_true", help="write without a shuffle")
    parser.add_argument(
        "--file-rows", type=int, default=0, help="rows per file, 0 for no limit"
    )
    return parser


if __name__ == "__main__":
    run(arguments().parse_args())
