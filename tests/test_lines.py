"""Line parsing and validation: what is accepted, what is rejected and why."""

import json

import pytest
from pyspark.sql import functions as F

from spendmart.operators import quality
from spendmart.operators.geo import geo_map
from spendmart.operators.normalize import normalize
from spendmart.plans.clean import clean_ads
from spendmart.schemas import CHANNELS, channel_spec

FB = CHANNELS["facebook"]
GA = CHANNELS["google"]
GOOD = {
    "Currency": "USD",
    "Country": "US",
    "Day": "20240601",
    "Impressions": "12",
    "Amount spent": "3.5",
}


def fb(**changes):
    record = GOOD | changes
    return json.dumps({k: v for k, v in record.items() if v is not ...})


def reasons(lines, *texts, spec=FB):
    return [r["reason"] for r in quality.validate(lines(*texts), spec).collect()]


@pytest.mark.parametrize(
    "text",
    [
        "",
        "   ",
        "5",
        "null",
        "[1]",
        '[{"Currency":"USD"}]',
        "{'Currency':'USD'}",
        fb() + " tail}",
        fb() + fb(),
        fb() + "," + fb(),
        fb()[:-1],
        fb()[:-9],
        fb().replace(",", "", 1),
        "x" + fb(),
    ],
)
def test_malformed_lines(lines, text):
    assert reasons(lines, text) == [quality.MALFORMED]


@pytest.mark.parametrize(
    "text",
    [
        fb(),
        "  \t" + fb() + " \r",
        fb(extra={"a": {"b": 1}}),
        fb(extra="brace } in text"),
        fb(extra=[{"a": "}"}]),
    ],
)
def test_well_formed_lines(lines, text):
    assert reasons(lines, text) == [None]


def test_absent_is_default_but_null_is_rejected(lines):
    rows = quality.validate(
        lines(fb(Impressions=...), fb(**{"Amount spent": ...}), fb(Impressions=None)), FB
    ).collect()
    assert [(r["impressions"], r["cost"], r["reason"]) for r in rows] == [
        (0, 3.5, None),
        (12, 0.0, None),
        (None, 3.5, quality.INVALID_METRIC),
    ]


def test_absent_text_fields(lines):
    rows = normalize(lines(fb(Currency=..., Country=...), fb(Currency=None, Country=None)), FB)
    assert [(r["currency"], r["country"]) for r in rows.collect()] == [("", ""), (None, None)]
    assert reasons(lines, fb(Day=...)) == [quality.INVALID_DAY]


def test_last_of_repeated_keys_wins(lines):
    text = fb()[:-1] + ', "Day": "20240602", "Impressions": "7"}'
    row = quality.validate(lines(text), FB).first()
    assert (str(row["date"]), row["impressions"], row["reason"]) == ("2024-06-02", 7, None)


def test_number_where_text_is_expected(lines):
    row = quality.validate(lines(fb(Currency=5, Day=20240601, Impressions=12)), FB).first()
    assert (row["currency"], row["impressions"], row["reason"]) == ("5", 12, None)


@pytest.mark.parametrize(
    "day",
    ["20240631", "2024-06-01", "2024061", "", None, " 20240601", "20240601 ", "30000101", "15000101", "202406011"],
)
def test_invalid_days(lines, day):
    assert reasons(lines, fb(Day=day)) == [quality.INVALID_DAY]


@pytest.mark.parametrize(
    "metric",
    ["1,234", "", "12d", "0x1A", "1_000", "nan", "inf", "-inf", "Infinity", "1e400", "-1e400", None, ".", "e5"],
)
@pytest.mark.parametrize("key", ["Impressions", "Amount spent"])
def test_invalid_metrics(lines, key, metric):
    assert reasons(lines, fb(**{key: metric})) == [quality.INVALID_METRIC]


def test_bare_nan_and_infinity(lines):
    texts = [fb(**{"Amount spent": float(v)}) for v in ("nan", "inf", "-inf")]
    assert reasons(lines, *texts) == [quality.INVALID_METRIC] * 3


def test_reason_order(lines):
    assert reasons(lines, fb(Day="x", Impressions="x")) == [quality.INVALID_DAY]


@pytest.mark.parametrize(
    ("text", "whole", "number"),
    [
        (" 12 ", 12, 12.0),
        ("+3", 3, 3.0),
        ("1e3", 1000, 1000.0),
        ("12.7", 12, 12.7),
        ("-12.7", -12, -12.7),
        ("-5", -5, -5.0),
        ("5.", 5, 5.0),
        (".5", 0, 0.5),
        ("9007199254740993", 9007199254740993, 9007199254740992.0),
        ("3000000000", 3000000000, 3e9),
    ],
)
def test_valid_metrics(lines, text, whole, number):
    row = quality.validate(lines(fb(**{"Impressions": text, "Amount spent": text})), FB).first()
    assert (row["impressions"], row["cost"], row["reason"]) == (whole, number, None)


def test_impressions_beyond_bigint_are_rejected(lines):
    too_large = ["9223372036854775808", "1e30"]
    assert reasons(lines, *[fb(Impressions=t) for t in too_large]) == [quality.INVALID_METRIC] * 2


@pytest.mark.parametrize(
    ("cost", "rounded"),
    [("0.0000025", 2e-06), ("1.0000005", 1.000001), ("1.23456789", 1.234568), ("-0.0000015", -2e-06), ("1e305", 1e305)],
)
def test_cost_rounds_half_to_even(lines, cost, rounded):
    row = quality.validate(lines(fb(**{"Amount spent": cost})), FB).first()
    assert row["cost"] == rounded


@pytest.fixture
def codes(spark):
    rows = [("2004", "AF"), ("2516", "NA"), ("2999", None), ("02008", "AL")]
    return geo_map(spark.createDataFrame(rows, "country_code string, Country string"))


@pytest.mark.parametrize(
    ("code", "country"),
    [
        ("2004", "AF"),
        (2004, "AF"),
        (2004.0, "Unknown"),
        ("2516", "NA"),
        ("2999", None),
        ("2008", "AL"),
        ("99999", "Unknown"),
        (None, "Unknown"),
        (..., "Unknown"),
    ],
)
def test_google_country(lines, codes, code, country):
    record = {"Currency code": "USD", "country_code": code, "Day": "20240601", "Impr.": 1, "Cost": 2}
    text = json.dumps({k: v for k, v in record.items() if v is not ...})
    assert clean_ads(lines(text), GA, codes).first()["country"] == country


def test_google_needs_a_code_map(lines):
    with pytest.raises(ValueError, match="country code map"):
        clean_ads(lines("{}"), GA)
    with pytest.raises(ValueError, match="country code map"):
        normalize(lines("{}"), GA)


def test_facebook_country_na_is_kept(lines):
    assert clean_ads(lines(fb(Country="NA")), FB).first()["country"] == "NA"


def test_clean_row(lines):
    assert clean_ads(lines(fb()), FB).first().asDict() == {
        "currency": "USD",
        "country": "US",
        "day": "20240601",
        "impressions": 12,
        "cost": 3.5,
        "year": 2024,
        "month": 6,
        "day_of_month": 1,
    }


def test_equal_rows_are_kept(lines):
    assert clean_ads(lines(fb(), fb()), FB).count() == 2


def test_accepted_and_rejected_make_the_input(lines):
    checked = quality.validate(
        lines(fb(), fb(), "", "x", fb(Day="x"), fb(Impressions="x"), fb(Impressions=None)), FB
    )
    counts = {r["reason"]: r["n"] for r in quality.reject_counts(checked).collect()}
    assert counts == {
        quality.MALFORMED: 2,
        quality.INVALID_DAY: 1,
        quality.INVALID_METRIC: 2,
    }
    assert quality.accepted(checked).count() + sum(counts.values()) == checked.count()


def test_unknown_channel_and_missing_columns(spark):
    with pytest.raises(ValueError, match="unknown channel"):
        channel_spec("radio")
    with pytest.raises(ValueError, match="lacks columns"):
        quality.validate(spark.range(1), FB)


def test_null_metric_rows(lines):
    rows = quality.raw_fields(lines(fb(), fb(Impressions=None), fb(Impressions=...), "x"), FB)
    assert quality.null_metric_rows(rows).count() == 2
    assert quality.null_metric_rows(rows, "cost").count() == 0


def test_unmapped_codes_compare_by_value_and_keep_nulls(lines, codes):
    texts = [json.dumps({"country_code": c}) for c in ("2004", 2004, 2004.0, 7, "x", None)] + ["{}"]
    found = quality.unmapped_codes(quality.raw_fields(lines(*texts), GA), codes)
    values = [r["country"] for r in found.orderBy(F.asc_nulls_last("country")).collect()]
    assert values == ["7", "x", None, None]
