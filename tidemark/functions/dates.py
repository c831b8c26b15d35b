"""Calendars: generated days, calendar and fiscal attributes, data-driven flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def days_between(bounds: DataFrame, start: str, end: str, name: str = "date", step_days: int = 1) -> DataFrame:
    """One row per day from each ``(start, end)`` row."""
    steps = F.sequence(F.col(start), F.col(end), F.expr(f"interval {int(step_days)} day"))
    return bounds.select(F.explode(steps).alias(name))


def calendar_for(fact: DataFrame, date_col: str, whole_years: bool = True) -> DataFrame:
    """Calendar that covers a fact: first day of its first year to last day of its last year."""
    day = F.col(date_col).cast("date")
    bounds = fact.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    if whole_years:
        bounds = bounds.select(
            F.trunc("lo", "year").alias("lo"), F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("hi")
        )
    return days_between(bounds, "lo", "hi")


def quarter_of(month: Column) -> Column:
    return F.ceil(month / 3).cast("int")


def with_calendar_attributes(days: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    first_of_month, first_of_quarter, first_of_year = (F.trunc(d, g) for g in ("month", "quarter", "year"))
    weekday = F.weekday(d) + 1
    day = F.dayofmonth(d)
    suffix = (
        F.when(day.isin(11, 12, 13), F.lit("th"))
        .when(day % 10 == 1, F.lit("st"))
        .when(day % 10 == 2, F.lit("nd"))
        .when(day % 10 == 3, F.lit("rd"))
        .otherwise(F.lit("th"))
    )
    quarter = F.quarter(d)
    return days.select(
        "*",
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        day.alias("day_of_month"),
        suffix.alias("day_suffix"),
        weekday.alias("iso_weekday"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        F.when(weekday >= 6, F.lit("Yes")).otherwise(F.lit("No")).alias("is_weekend"),
        (F.floor((day - 1) / 7) + 1).cast("int").alias("weekday_in_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("iso_week"),
        (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int").alias("week_of_year"),
        (F.floor((day - 1 + F.weekday(first_of_month)) / 7) + 1).cast("int").alias("week_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM-yyyy").alias("month_year"),
        F.date_format(d, "MMyyyy").alias("mmyyyy"),
        (F.year(d) * 100 + F.month(d)).alias("yyyymm"),
        quarter.alias("quarter"),
        F.element_at(F.array(*[F.lit(x) for x in ("First", "Second", "Third", "Fourth")]), quarter).alias("quarter_name"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), quarter.cast("string")).alias("quarter_code"),
        (F.year(d) * 10 + quarter).alias("quarter_sort"),
        F.year(d).alias("year"),
        first_of_month.alias("first_of_month"),
        F.last_day(d).alias("last_of_month"),
        first_of_quarter.alias("first_of_quarter"),
        F.date_sub(F.add_months(first_of_quarter, 3), 1).alias("last_of_quarter"),
        first_of_year.alias("first_of_year"),
        F.date_sub(F.add_months(first_of_year, 12), 1).alias("last_of_year"),
        F.add_months(first_of_month, 1).alias("first_of_next_month"),
        F.add_months(first_of_year, 12).alias("first_of_next_year"),
        F.dayofmonth(F.last_day(d)).alias("days_in_month"),
        F.when(day == 1, F.lit("Yes")).otherwise(F.lit("No")).alias("is_first_day"),
        F.when(d == F.last_day(d), F.lit("Yes")).otherwise(F.lit("No")).alias("is_last_day"),
    )


def with_fiscal_attributes(days: DataFrame, start_month: int, date: str = "date") -> DataFrame:
    """Fiscal attributes; the fiscal year carries the calendar year it starts in."""
    d = F.col(date)
    fiscal_year = F.when(F.month(d) >= start_month, F.year(d)).otherwise(F.year(d) - 1)
    fiscal_month = F.pmod(F.month(d) - F.lit(start_month), F.lit(12)) + 1
    fiscal_quarter = quarter_of(fiscal_month)
    start = F.make_date(fiscal_year, F.lit(start_month), F.lit(1))
    return days.select(
        "*",
        fiscal_year.alias("fiscal_year"),
        fiscal_month.alias("fiscal_month"),
        F.lpad(fiscal_month.cast("string"), 2, "0").alias("fiscal_month_text"),
        fiscal_quarter.alias("fiscal_quarter"),
        F.concat(F.lit("FY"), fiscal_year.cast("string"), F.lit("-Q"), fiscal_quarter.cast("string")).alias(
            "fiscal_quarter_code"
        ),
        (fiscal_year * 100 + fiscal_month).alias("fiscal_yyyymm"),
        (F.floor(F.date_diff(d, start) / 7) + 1).cast("int").alias("fiscal_week"),
    )


def with_data_flags(calendar: DataFrame, fact: DataFrame, date_col: str, date: str = "date") -> DataFrame:
    """``has_data``, ``is_latest_date``, ``is_latest_month``, ``in_future`` relative to the fact's last day."""
    days = fact.select(F.col(date_col).cast("date").alias("__day")).distinct()
    latest = days.agg(F.max("__day")).scalar()
    yes_no = lambda c: F.when(c, F.lit("Yes")).otherwise(F.lit("No"))
    d = F.col(date)
    return (
        calendar.join(days, d == F.col("__day"), "left")
        .withColumn("has_data", yes_no(F.col("__day").isNotNull()))
        .withColumn("is_latest_date", yes_no(d == latest))
        .withColumn("is_latest_month", yes_no(F.trunc(d, "month") == F.trunc(latest, "month")))
        .withColumn("in_future", yes_no(d > latest))
        .drop("__day")
    )
