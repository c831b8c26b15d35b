"""Time-intelligence measures of a sales fact: day, month and year to date, last year, growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import safe_ratio

PERIODS = ["day", "mtd", "mtd_ly", "ytd", "ytd_ly"]


def latest_day(fact: DataFrame, date_col: str) -> Column:
    """The report date when none is given: the fact's last day, read by one small job.

    It comes back as a literal, so filters built on it are constants that prune partitions, files
    and row groups at planning time. A sub-query could not.
    """
    return F.lit(fact.agg(F.max(F.col(date_col)).cast("date")).first()[0]).cast("date")


def period_conditions(date: Column, asof: Column) -> dict[str, Column]:
    last_year = F.add_months(asof, -12)
    return {
        "day": date == asof,
        "mtd": (date >= F.trunc(asof, "month")) & (date <= asof),
        "mtd_ly": (date >= F.trunc(last_year, "month")) & (date <= last_year),
        "ytd": (date >= F.trunc(asof, "year")) & (date <= asof),
        "ytd_ly": (date >= F.trunc(last_year, "year")) & (date <= last_year),
    }


def period_totals(
    fact: DataFrame,
    date_col: str,
    measures: dict[str, Column],
    asof: Column,
    group: Sequence[str] = (),
    periods: Sequence[str] = PERIODS,
) -> DataFrame:
    """``{measure}_{period}`` sums per group from one scan limited to the dates any period needs."""
    oldest = F.trunc(F.add_months(asof, -12), "year")
    rows = fact.filter((F.col(date_col) >= oldest) & (F.col(date_col) < F.date_add(asof, 1)))
    wanted = period_conditions(F.col(date_col).cast("date"), asof)
    sums = [F.sum(F.when(wanted[p], m)).alias(f"{n}_{p}") for n, m in measures.items() for p in periods]
    return rows.groupBy(*group).agg(*sums)


def growth(current: Column, base: Column) -> Column:
    """Relative change; null when current is missing or the base is null or zero."""
    return safe_ratio(current, base) - 1


def growth_blank_zero(current: Column, base: Column) -> Column:
    """Growth in the report style that shows a zero change as blank."""
    change = safe_ratio(current.cast("double") - base.cast("double"), base)
    return F.when(change != 0, change)


def same_period_last_year(daily: DataFrame, date_col: str, value: str) -> DataFrame:
    """Adds ``{value}_ly``: the total of the same calendar day a year earlier.

    29 February of a leap year looks at 28 February; each earlier day is used once per target day.
    """
    base = daily.select(F.col(date_col).alias("__d"), F.col(value).alias(f"{value}_ly"))
    return daily.join(base, F.add_months(F.col(date_col), -12) == F.col("__d"), "left").drop("__d")


def metric_table(wide: DataFrame, cells: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(metric_index, metric, calculation, value) rows out of one wide aggregate row."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("metric_index"), F.lit(m).alias("metric"), F.lit(c).alias("calculation"),
                     v.cast("double").alias("value"))
            for i, (m, c, v) in enumerate(cells)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")
