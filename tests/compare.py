"""Runs queries in Spark and their SQL in DuckDB and compares rows exactly."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def in_name_order(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def difference(df, sql: str, sf_dir: str) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    columns, expected = oracle_rows(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got = in_name_order(df.columns, [tuple(r) for r in df.collect()])
    want = in_name_order(columns, expected)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None if got else "no rows"
