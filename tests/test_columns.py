import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import dates as D
from tidemark.sources.files import inline_table


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


@pytest.mark.parametrize(
    "value, expected",
    [("2024-02-29", dt.date(2024, 2, 29)), ("", None), ("  ", None), ("2023-02-29", None), ("junk", None), (None, None)],
)
def test_blank_or_bad_dates_become_null(spark, value, expected):
    assert one(spark, C.to_date_or_null(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize("value, expected", [("$1,234.50", "1234.50"), ("12", "12.00"), ("", None), ("free", None)])
def test_money_text(spark, value, expected):
    got = one(spark, C.money_text(F.lit(value)))
    assert (None if got is None else str(got)) == expected


def test_greatest_is_null_when_one_input_is(spark):
    assert one(spark, C.greatest_or_null(F.lit(1), F.lit(2))) == 2
    assert one(spark, C.greatest_or_null(F.lit(1), F.lit(None).cast("int"))) is None


@pytest.mark.parametrize("value, expected", [("123456789", "XXXXX6789"), ("1234", "XXXX"), ("12", "XX"), ("", ""), (None, None)])
def test_mask(spark, value, expected):
    assert one(spark, C.mask_keep_last(F.lit(value).cast("string"))) == expected


def test_role_mask(spark):
    assert one(spark, C.role_mask(F.lit("987654321"), "ADMIN", ["ADMIN"])) == "987654321"
    assert one(spark, C.role_mask(F.lit("987654321"), "ANALYST", ["ADMIN"])) == "XXXXX4321"


def test_band_edges_are_half_open_and_null_is_optional(spark):
    data = inline_table(spark, [(9.99,), (10.0,), (20.0,), (None,)], "v double")
    plain, position = C.band("v", [10, 20], ["low", "mid", "high"])
    zero, _ = C.band("v", [10, 20], ["low", "mid", "high"], null_as_zero=True)
    got = [tuple(r) for r in data.select(plain, position, zero).collect()]
    assert got == [("low", 1, "low"), ("mid", 2, "mid"), ("high", 3, "high"), (None, None, "low")]


@pytest.mark.parametrize(
    "value, expected",
    [("1st September, 2020", dt.date(2020, 9, 1)), ("22nd May, 2021", dt.date(2021, 5, 22)), ("31st February, 2021", None), (None, None)],
)
def test_ordinal_date(spark, value, expected):
    assert one(spark, C.ordinal_date(F.lit(value).cast("string"))) == expected


def test_marker_functions(spark):
    text = F.lit("sales_batch-2020_v2.csv")
    assert one(spark, C.between_marks(text, "batch-", "_")) == "2020"
    assert one(spark, C.after(text, "nothing")) is None
    assert one(spark, C.before(text, "nothing")) is None
    assert one(spark, C.last_token(text, "_")) == "v2.csv"


@pytest.mark.parametrize("name", ["orderKeyId", "order key-id", "ORDER_KEY_ID", "_order.keyId_"])
def test_upper_snake(spark, name):
    assert C.upper_snake(name) == "ORDER_KEY_ID" == one(spark, C.upper_snake_col(F.lit(name)))


def test_surrogate_key_tells_null_from_text(spark):
    keys = {one(spark, C.surrogate_key(F.lit("a"), F.lit(v).cast("string"))) for v in (None, "", "b")}
    assert len(keys) == 3


def test_safe_ratio(spark):
    assert one(spark, C.safe_ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, C.safe_ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize(
    "kind, value, expected", [("millions", 1234567, "$1.23M"), ("percent", 0.125, "12.50%"), ("units", 1234.4, "1,234"), ("price", 1.5, "1.50")]
)
def test_metric_text(spark, kind, value, expected):
    assert one(spark, C.metric_text(F.lit(float(value)), kind)) == expected


def test_linear_score_has_a_floor(spark):
    assert one(spark, C.linear_score(F.lit(100.0), 722.14, 0.0107)) == 0.0
    assert one(spark, C.linear_score(F.lit(829.14), 722.14, 0.0107)) == pytest.approx(10000)


def test_local_day_boundary(spark):
    utc = F.lit("2023-09-30 14:00:00").cast("timestamp_ntz")
    assert one(spark, C.utc_to_zone(utc, "Australia/Melbourne")) == dt.datetime(2023, 10, 1, 0, 0)
    assert one(spark, C.zone_to_utc(F.lit("2023-10-01").cast("timestamp_ntz"), "Australia/Melbourne")) == dt.datetime(2023, 9, 30, 14, 0)


def test_fiscal_year_starts_in_month(spark):
    days = inline_table(spark, [("2024-06-30",), ("2024-07-01",)], "d string").select(F.col("d").cast("date").alias("date"))
    got = [tuple(r) for r in D.with_fiscal_attributes(days, 7).select("fiscal_year", "fiscal_month", "fiscal_quarter", "fiscal_week").collect()]
    assert got == [(2023, 12, 4, 53), (2024, 1, 1, 1)]


def test_calendar_covers_whole_years(spark):
    fact = inline_table(spark, [("2023-05-05",), ("2024-02-29",)], "d string")
    days = D.calendar_for(fact, "d").agg(F.count("date"), F.min("date"), F.max("date")).first()
    assert tuple(days) == (731, dt.date(2023, 1, 1), dt.date(2024, 12, 31))
