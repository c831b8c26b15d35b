"""Load generators. Every value is a hash of a row id, so a rerun or a lost task repeats it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_number

TICKERS = ["ORE", "FIR", "KELP", "DUNE", "MARL"]


def ticks(ids: DataFrame, id_col: str, start: str, tickers: Sequence[str] = TICKERS) -> DataFrame:
    """(event_time, ticker, price) per id: one tick a second from ``start``, price in [0, 100)."""
    n = F.col(id_col)
    symbol = F.element_at(F.array(*[F.lit(t) for t in tickers]), (hash_number(n, salt="ticker") % len(tickers) + 1).cast("int"))
    return ids.select(
        n.alias("tick_id"),
        F.timestamp_add("SECOND", n, F.lit(start).cast("timestamp_ntz")).alias("event_time"),
        symbol.alias("ticker"),
        ((hash_number(n, salt="price") % 10000) / 100).alias("price"),
    )


def uniform(n: Column, salt: str, low: int, high: int) -> Column:
    """Whole number in [low, high]."""
    return F.lit(low) + hash_number(n, salt=salt) % (high - low + 1)


def facts(ids: DataFrame, id_col: str, first_day: str, span_days: int, id_ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """Sales facts with uniform days, amounts and customer ids out of several id ranges."""
    n = F.col(id_col)
    pick = hash_number(n, salt="range") % len(id_ranges)
    customer = uniform(n, "customer", *id_ranges[-1])
    for i in range(len(id_ranges) - 2, -1, -1):
        customer = F.when(pick == i, uniform(n, "customer", *id_ranges[i])).otherwise(customer)
    return ids.select(
        n.alias("fact_id"),
        F.date_add(F.lit(first_day).cast("date"), uniform(n, "day", 0, span_days - 1).cast("int")).alias("order_date"),
        customer.alias("customer_id"),
        uniform(n, "quantity", 1, 100).alias("quantity"),
        (uniform(n, "amount", 1000, 500000) / 100).alias("amount"),
    )


def daily_entries(days: DataFrame, day: str, extra: int = 5) -> DataFrame:
    """At least one row per day plus 0 to ``extra`` more."""
    more = (hash_number(F.col(day), salt="extra") % (extra + 1)).cast("int")
    rows = days.select(F.col(day).alias("entry_date"), F.explode(F.sequence(F.lit(0), more)).alias("entry_no"))
    return rows.withColumn("amount", (hash_number("entry_date", "entry_no", salt="amount") % 100000) / 100)
