"""What each query must return, as SQL over the driver's tables."""

from __future__ import annotations

from .inputs import COUNTRIES, FLAW_SQL, MAPPED_NATIONS, UNRATED_CURRENCY

# Raw fields of every order; `reason` says why a line is rejected.
ORDERS = f"""
src AS (
  SELECT o_orderkey AS key,
         {FLAW_SQL} AS flaw,
         CASE WHEN o_orderkey % 2 = 0 THEN 'facebook' ELSE 'google' END AS channel,
         o_orderpriority AS currency,
         o_custkey % {COUNTRIES} AS country_no,
         strftime(o_orderdate, '%Y%m%d') AS day,
         CAST(o_orderdate AS DATE) AS date,
         o_orderkey % 10007 AS shown,
         o_totalprice AS price
  FROM orders
)"""

RAW = (
    ORDERS
    + f""",
raw AS (
  SELECT src.*,
         CASE WHEN flaw IN ('truncated', 'trailing_text') THEN 'malformed_json'
              WHEN flaw = 'impossible_day' THEN 'invalid_day'
              WHEN flaw IN ('comma_cost', 'null_impressions', 'suffix_cost', 'not_finite')
                THEN 'invalid_metric' END AS reason,
         CASE WHEN channel = 'facebook' THEN
                CASE flaw WHEN 'no_country' THEN '' WHEN 'null_country' THEN NULL
                     ELSE 'NATION_' || country_no END
              WHEN flaw IN ('no_country', 'null_country') OR country_no >= {MAPPED_NATIONS}
                THEN 'Unknown'
              ELSE 'NATION_' || country_no END AS country,
         CASE WHEN flaw IN ('no_country', 'null_country') THEN NULL
              WHEN channel = 'facebook' THEN 'NATION_' || country_no
              ELSE CAST(2000 + country_no AS VARCHAR) END AS raw_country,
         CASE WHEN flaw = 'impossible_day' THEN '20240631' ELSE day END AS raw_day,
         CASE flaw WHEN 'null_impressions' THEN NULL
                   WHEN 'fraction' THEN shown || '.7'
                   WHEN 'odd_number' THEN ' ' || shown || ' '
                   ELSE CAST(shown AS VARCHAR) END AS raw_impressions,
         CASE flaw WHEN 'comma_cost' THEN '1,234'
                   WHEN 'no_cost' THEN NULL
                   WHEN 'suffix_cost' THEN '12d'
                   WHEN 'long_cost' THEN (key % 1000) || '.12345678'
                   WHEN 'not_finite' THEN 'inf'
                   ELSE CAST(price AS VARCHAR) END AS raw_cost,
         CASE WHEN flaw = 'odd_number' AND channel = 'google' THEN shown * 10
              ELSE shown END AS impressions,
         CASE flaw WHEN 'no_cost' THEN 0.0::double
                   WHEN 'long_cost' THEN (key % 1000)::double + 0.123457::double
                   ELSE round_even(price, 6) END AS cost
  FROM src
)"""
)

CLEAN = (
    RAW
    + """,
clean AS (
  SELECT channel, currency, country, day, day AS date_id, impressions,
         CASE flaw WHEN 'long_cost' THEN CAST((key % 1000) || '.123457' AS DOUBLE)
                   ELSE cost END AS cost,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day_of_month
  FROM raw WHERE reason IS NULL
)"""
)

_RATES = f"""
  SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS date_id, o_orderpriority AS currency,
         0.5::double + (dayofyear(o_orderdate) % 50) / 100.0::double AS exchange_rate_usd
  FROM orders WHERE o_orderpriority <> '{UNRATED_CURRENCY}'"""

FACT = (
    CLEAN
    + f""",
rates AS ({_RATES}),
joined AS (
  SELECT c.channel, c.date_id, n.n_nationkey AS country_id, c.currency, r.exchange_rate_usd,
         c.cost AS cost_original, c.impressions, c.cost * r.exchange_rate_usd AS cost_usd
  FROM clean c
  LEFT JOIN nation n ON c.country = n.n_name
  LEFT JOIN rates r ON c.date_id = r.date_id AND c.currency = r.currency
),
fact AS (
  SELECT CASE channel WHEN 'facebook' THEN 1 WHEN 'google' THEN 2 END AS channel_id, date_id,
         country_id, CAST(impressions AS INTEGER) AS impressions, cost_usd
  FROM joined
)"""
)

TARGETS = """
targets AS (
  SELECT c_custkey + 100000 AS criteria_id, c_name || ', ' || c_mktsegment AS name,
         c_custkey % 3 = 0 AS no_parent,
         CASE WHEN c_custkey % 50 = 0 THEN 'NA' ELSE 'N' || c_nationkey END AS country_code,
         CASE c_custkey % 5 WHEN 0 THEN 'Country' WHEN 1 THEN 'Region' ELSE 'City' END AS kind
  FROM customer
)"""

_CURATED = "FROM targets WHERE kind IN ('Country', 'Region') AND no_parent"


def _line_chars(channel: str) -> str:
    """Length of a raw line, member by member."""
    if channel == "facebook":
        currency, country_key, shown_key, cost_key = "Currency", "Country", "Impressions", "Amount spent"
        quotes = "2"
        country_quotes = "2"
        odd = "length(shown::varchar) + 2 + 2"
        bad = "length('inf') + 2"
        country_value = "length('NATION_' || country_no)"
    else:
        currency, country_key, shown_key, cost_key = "Currency code", "country_code", "Impr.", "Cost"
        quotes = "0"
        country_quotes = "CASE WHEN key % 4 = 1 THEN 0 ELSE 2 END"
        odd = "length(shown::varchar) + 2"
        bad = "length('NaN')"
        country_value = "4"
    member = {k: len(f',"{k}":') for k in (country_key, "Day", shown_key, cost_key)}
    whole = f"""
      {len('{' + f'"{currency}":""' + '}')} + length(currency)
      + CASE flaw WHEN 'no_country' THEN 0 WHEN 'null_country' THEN {member[country_key] + 4}
             ELSE {member[country_key]} + {country_value} + {country_quotes} END
      + CASE flaw WHEN 'repeated_day' THEN {2 * (member["Day"] + 10)} ELSE {member["Day"] + 10} END
      + {member[shown_key]} + CASE flaw WHEN 'null_impressions' THEN 4
             WHEN 'fraction' THEN length(shown::varchar) + 2 + {quotes}
             WHEN 'odd_number' THEN {odd} ELSE length(shown::varchar) + {quotes} END
      + CASE flaw WHEN 'no_cost' THEN 0 ELSE {member[cost_key]} END
      + CASE flaw WHEN 'no_cost' THEN 0 WHEN 'comma_cost' THEN 7 WHEN 'suffix_cost' THEN 5
             WHEN 'long_cost' THEN length((key % 1000)::varchar) + 9 + {quotes}
             WHEN 'not_finite' THEN {bad} ELSE length(price::varchar) + {quotes} END"""
    return f"{whole} + CASE flaw WHEN 'truncated' THEN -5 WHEN 'trailing_text' THEN 6 ELSE 0 END"


def _scan(channel: str) -> str:
    return f"""
  SELECT '{channel}_data' AS prefix, count(*) AS n_lines,
         count(*) FILTER (WHERE flaw = 'truncated') AS n_cut,
         CAST(sum({_line_chars(channel)}) AS BIGINT) AS n_chars
  FROM src WHERE channel = '{channel}'"""


_WELL_FORMED = "(reason IS NULL OR reason <> 'malformed_json')"
_FACEBOOK = f"FROM raw WHERE channel = 'facebook' AND {_WELL_FORMED}"
_GOOGLE = f"FROM raw WHERE channel = 'google' AND {_WELL_FORMED}"
_RAW_FIELDS = (
    "currency, raw_country AS country, raw_day AS day, raw_impressions AS impressions, "
    "raw_cost AS cost"
)
_TEXT_FIELDS = (
    "currency, country, raw_day AS day, raw_impressions AS impressions, "
    "coalesce(raw_cost, '0.0') AS cost"
)
_TOTAL = "CAST(sum(CAST(cost_usd AS DECIMAL(38, 16))) AS DOUBLE)"
_CLEAN_COLUMNS = "channel, currency, country, date_id, impressions, cost"
_FACT_COLUMNS = "channel_id, date_id, country_id, impressions, cost_usd"


_NUMBERS = """currency, {country} AS country, raw_day AS day,
  CASE WHEN flaw = 'null_impressions' THEN NULL ELSE impressions END AS impressions,
  CASE WHEN flaw IN ('comma_cost', 'suffix_cost', 'not_finite') THEN NULL
       WHEN flaw = 'long_cost' THEN CAST(raw_cost AS DOUBLE)
       WHEN flaw = 'no_cost' THEN {no_cost} ELSE price END AS cost,
  {has_cost} AS has_cost"""
_TEXT_CODE = "CASE WHEN flaw = 'no_country' THEN '' ELSE raw_country END"
_VALID_DAY = "key % 9 > 4"


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {
    "scan_json_lines": _select(
        ORDERS, f"{_scan('facebook')} UNION ALL {_scan('google')}"
    ),
    "json_lines_parse": _select(
        RAW,
        f"""SELECT channel, {_NUMBERS.format(country="raw_country", no_cost="NULL", has_cost="flaw <> 'no_cost'")}
FROM raw WHERE {_WELL_FORMED}""",
    ),
    "file_account": _select(
        ORDERS,
        """SELECT file_name, file_day, skipped, CASE WHEN skipped IS NULL THEN count(*) END AS n_lines FROM (
  SELECT CASE WHEN key % 7 = 0 THEN 'raw_data_fb_' || substr(day, 1, 6) || '.txt'
              WHEN key % 11 = 0 THEN 'raw_data_fb_' || substr(day, 1, 4) || '0231.txt'
              WHEN key % 13 = 0 THEN 'raw_data_fb_' || substr(day, 1, 6) || '02.txt.txt'
              ELSE 'raw_data_fb_' || substr(day, 1, 6) || '01.txt' END AS file_name,
         CASE WHEN key % 7 = 0 THEN '' WHEN key % 11 = 0 THEN substr(day, 1, 4) || '0231'
              WHEN key % 13 = 0 THEN substr(day, 1, 6) || '02' ELSE substr(day, 1, 6) || '01' END AS file_day,
         CASE WHEN key % 7 = 0 THEN 'no_day' WHEN key % 11 = 0 THEN 'no_such_day' END AS skipped
  FROM src WHERE key % 17 <> 0) GROUP BY file_name, file_day, skipped""",
    ),
    "file_date_filter": _select(
        ORDERS,
        """SELECT key, 'raw_data_fb_' || day || '.txt' AS file_name, day AS file_day FROM src
WHERE key % 7 <> 0 AND key % 11 <> 0 AND key % 13 <> 0""",
    ),
    "scan_geo_map": _select(
        TARGETS,
        "SELECT CAST(criteria_id AS VARCHAR) AS country_code, country_code AS country FROM targets",
    ),
    "scan_partitioned": _select(
        CLEAN,
        f"SELECT {_CLEAN_COLUMNS} FROM clean WHERE year = 1998 AND month = 6",
    ),
    "scan_merged": _select(
        CLEAN,
        """SELECT channel, currency, CASE WHEN year >= 1995 THEN country END AS country, day, impressions,
  cost, year FROM clean""",
    ),
    "scan_dims": _RATES,
    "partitioned_write_roundtrip": _select(CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "quarantine": _select(
        CLEAN,
        f"""SELECT channel, 'accepted' AS reason, date_id, currency, country, impressions, cost,
  NULL AS file_name, NULL AS n_chars FROM clean
UNION ALL
SELECT channel, reason, day, NULL, NULL, NULL, NULL, 'raw_data_' || channel || '_' || day || '.txt',
  CASE channel WHEN 'facebook' THEN {_line_chars("facebook")} ELSE {_line_chars("google")} END
FROM raw WHERE reason IS NOT NULL""",
    ),
    "clean_reload": _select(CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean WHERE NOT (year = 1998 AND month = 6)"),
    "fact_reload": _select(
        FACT,
        """SELECT channel_id, date_id, country_id, impressions,
  CASE WHEN channel_id = 2 AND date_id BETWEEN '19980601' AND '19980630' THEN cost_usd * 0.5::double
       ELSE cost_usd END AS cost_usd
FROM fact WHERE NOT (channel_id = 2 AND date_id = '19980615')""",
    ),
    "fact_write_roundtrip": _select(FACT, f"SELECT {_FACT_COLUMNS} FROM fact"),
    "fact_period": _select(
        FACT, f"SELECT {_FACT_COLUMNS} FROM fact WHERE date_id BETWEEN '19980601' AND '19980630'"
    ),
    "records_per_file": _select(
        CLEAN,
        f"""SELECT {_CLEAN_COLUMNS}, year, count(*) OVER folder AS n_rows,
  CAST(ceil(count(*) OVER folder / 400.0) AS BIGINT) AS n_files, least(count(*) OVER folder, 400) AS largest
FROM clean WINDOW folder AS (PARTITION BY channel, year)""",
    ),
    "geo_csv_roundtrip": _select(
        TARGETS,
        f"SELECT CAST(criteria_id AS VARCHAR) AS criteria_id, country_code, name {_CURATED}",
    ),
    "normalize_facebook": _select(RAW, f"SELECT {_TEXT_FIELDS} {_FACEBOOK}"),
    "normalize_google": _select(
        RAW,
        f"""SELECT currency, country, raw_day AS day,
  CASE flaw WHEN 'null_impressions' THEN NULL ELSE impressions END AS impressions,
  CASE WHEN flaw IN ('comma_cost', 'suffix_cost', 'not_finite') THEN NULL
       WHEN flaw = 'long_cost' THEN CAST(raw_cost AS DOUBLE) ELSE cost END AS cost {_GOOGLE}""",
    ),
    "join_country_fx": _select(
        FACT,
        """SELECT channel, date_id, country_id, currency, exchange_rate_usd, cost_original,
  impressions FROM joined""",
    ),
    "channel_tag": _select(ORDERS, "SELECT key, channel FROM src"),
    "geo_targets_curate": _select(
        TARGETS,
        f"SELECT CAST(criteria_id AS VARCHAR) AS criteria_id, country_code, name {_CURATED}",
    ),
    "geo_rename": _select(
        TARGETS, f"SELECT country_code AS country, name AS country_name {_CURATED}"
    ),
    "drop_invalid_day": _select(
        RAW,
        f"""SELECT channel, {_NUMBERS.format(country="country", no_cost="0.0::double", has_cost="true")}
FROM raw WHERE {_WELL_FORMED} AND flaw <> 'impossible_day'""",
    ),
    "drop_invalid_metrics": _select(
        RAW,
        f"""SELECT channel, currency, country, raw_day AS day, impressions,
  CASE flaw WHEN 'long_cost' THEN CAST((key % 1000) || '.123457' AS DOUBLE) ELSE cost END AS cost
FROM raw WHERE {_WELL_FORMED} AND (reason IS NULL OR reason <> 'invalid_metric')""",
    ),
    "null_metric_rows": _select(
        RAW, f"SELECT {_RAW_FIELDS} {_FACEBOOK} AND raw_impressions IS NULL"
    ),
    "row_range_slice": """SELECT criteria_id, name FROM (
  SELECT c_custkey + 100000 AS criteria_id, c_name || ', ' || c_mktsegment AS name,
         row_number() OVER (ORDER BY c_custkey) AS position FROM customer)
WHERE position BETWEEN 300 AND 1100""",
    "file_order_slice": """SELECT row_number() OVER (ORDER BY c_custkey) AS row, c_custkey + 100000 AS criteria_id,
  c_name || ', ' || c_mktsegment AS name FROM customer QUALIFY row BETWEEN 300 AND 1100""",
    "geo_slice_rename": _select(
        TARGETS,
        f"""SELECT country_code AS country, name AS country_name FROM (
  SELECT *, row_number() OVER (ORDER BY criteria_id) AS position FROM targets)
{_CURATED.removeprefix("FROM targets")} AND position BETWEEN 300 AND 1100""",
    ),
    "geo_lookup_default": _select(
        ORDERS,
        f"""SELECT key, CASE WHEN flaw = 'null_country' OR country_no >= {MAPPED_NATIONS}
  THEN 'Unknown' ELSE 'NATION_' || country_no END AS country FROM src""",
    ),
    "join_country": _select(
        CLEAN,
        """SELECT channel, date_id, country, n_nationkey AS country_id
FROM clean LEFT JOIN nation ON country = n_name""",
    ),
    "join_fx": _select(
        FACT, "SELECT date_id, currency, cost_original AS cost, exchange_rate_usd FROM joined"
    ),
    "join_channel": _select(
        CLEAN,
        """SELECT channel, date_id, impressions,
  CASE channel WHEN 'facebook' THEN 1 ELSE 2 END AS channel_id FROM clean""",
    ),
    "unmapped_codes": _select(
        RAW,
        f"""SELECT currency, raw_country AS country_code, raw_day AS day {_GOOGLE}
AND (raw_country IS NULL OR country_no >= {MAPPED_NATIONS})""",
    ),
    "partition_row_counts": _select(
        CLEAN,
        """SELECT channel, year, month, day_of_month, count(*) AS n FROM clean GROUP BY ALL""",
    ),
    "ingest_reject_counts": _select(
        RAW,
        "SELECT channel, reason, count(*) AS n FROM raw WHERE reason IS NOT NULL GROUP BY ALL",
    ),
    "channel_row_counts": _select(
        CLEAN, "SELECT channel, count(*) AS n FROM clean GROUP BY channel"
    ),
    "distinct_codes": _select(
        RAW,
        f"SELECT DISTINCT raw_country AS country_code {_GOOGLE} AND raw_country IS NOT NULL",
    ),
    "dedup_last_wins": """SELECT CAST(2000 + c_nationkey AS VARCHAR) AS country_code,
  arg_max(c_name, c_custkey) AS country FROM customer GROUP BY c_nationkey""",
    "preview_limit": _select(
        CLEAN,
        """SELECT date_id, currency, country, impressions, cost, channel FROM clean
ORDER BY date_id, currency, country NULLS FIRST, impressions, cost, channel LIMIT 10""",
    ),
    "union_channels": _select(CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "json_get_default": _select(
        RAW,
        f"""SELECT channel, {_NUMBERS.format(country=_TEXT_CODE, no_cost="0.0::double", has_cost="true")}
FROM raw WHERE {_WELL_FORMED}""",
    ),
    "string_fns": _select(
        ORDERS,
        """SELECT key, 'raw data_' || day || suffix AS stripped, key % 5 > 1 AS is_txt,
  CASE WHEN key % 5 > 1 THEN day ELSE '' END AS last_part, CAST(shown AS VARCHAR) AS impressions_text
FROM (SELECT *, CASE key % 5 WHEN 0 THEN '.csv' WHEN 1 THEN '.TXT' WHEN 2 THEN '.txt.txt' ELSE '.txt' END AS suffix
      FROM src)""",
    ),
    "date_parts": _select(
        ORDERS,
        f"""SELECT key, CASE WHEN {_VALID_DAY} THEN CAST(year(date) AS INTEGER) END AS year,
  CASE WHEN {_VALID_DAY} THEN CAST(month(date) AS INTEGER) END AS month,
  CASE WHEN {_VALID_DAY} THEN CAST(day(date) AS INTEGER) END AS day_of_month FROM src""",
    ),
    "date_format": _select(
        ORDERS,
        f"""SELECT key, CASE WHEN {_VALID_DAY} THEN day END AS day,
  CASE WHEN {_VALID_DAY} THEN strftime(date - 1, '%Y%m%d') END AS day_before,
  CASE WHEN {_VALID_DAY} THEN strftime(date + 1, '%Y%m%d') END AS day_after FROM src""",
    ),
    "safe_numeric": _select(
        ORDERS,
        """SELECT key,
  CASE key % 10 WHEN 0 THEN shown WHEN 1 THEN shown WHEN 2 THEN shown * 10
       WHEN 3 THEN -shown WHEN 9 THEN shown END AS whole,
  CASE key % 10 WHEN 0 THEN shown::double WHEN 1 THEN shown::double
       WHEN 2 THEN (shown * 10)::double WHEN 3 THEN CAST('-' || shown || '.9' AS DOUBLE)
       WHEN 9 THEN shown::double END AS number FROM src""",
    ),
    "round_cost": _select(
        ORDERS, "SELECT key, round_even(price / 7.0::double, 6) AS cost FROM src"
    ),
    "date_id": _select(ORDERS, "SELECT key, day AS date_id FROM src"),
    "cost_to_usd": _select(FACT, "SELECT date_id, currency, cost_original, cost_usd FROM joined"),
    "clean_ads": _select(
        CLEAN,
        """SELECT channel, currency, country, day, impressions, cost, year, month, day_of_month
FROM clean""",
    ),
    "dim_country_build": """SELECT CAST(row_number() OVER (ORDER BY c_name) AS INTEGER) AS country_id,
  c_name AS country, 'The "' || c_mktsegment || '", one' AS country_name FROM customer""",
    "dim_country_growth": """SELECT CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN r ELSE r + n END AS INTEGER) AS country_id,
  c_name AS country, lower(c_mktsegment) AS country_name FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment = 'BUILDING' ORDER BY c_name) AS r,
         count(*) FILTER (WHERE c_mktsegment = 'BUILDING') OVER () AS n FROM customer)""",
    "fact_ad_performance": _select(FACT, f"SELECT {_FACT_COLUMNS} FROM fact"),
    "rollup_channel_day": _select(
        FACT,
        f"""SELECT channel_id, date_id, CAST(sum(impressions) AS BIGINT) AS impressions,
  round({_TOTAL}, 4) AS cost_usd FROM fact GROUP BY channel_id, date_id""",
    ),
    "rollup_country_top": _select(
        FACT,
        f"""SELECT country_id, round({_TOTAL}, 4) AS cost_usd FROM fact GROUP BY country_id
ORDER BY {_TOTAL} DESC NULLS LAST, country_id NULLS LAST LIMIT 10""",
    ),
    "cpm_by_channel": _select(
        FACT,
        f"""SELECT channel_id, CAST(sum(impressions) AS BIGINT) AS impressions,
  round({_TOTAL}, 4) AS cost_usd,
  round({_TOTAL} * 1000 / nullif(sum(impressions), 0), 4) AS cpm
FROM fact GROUP BY channel_id""",
    ),
}
