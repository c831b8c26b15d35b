"""Join helpers: unique lookups, filter propagation along relationships, default-value keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import split_join


def unique_lookup(table: DataFrame, key: str, value: str, ambiguous: str = "null") -> DataFrame:
    """(key, value, ambiguous): the one value of each key.

    A key with several values gives null, or stops the query when ``ambiguous`` is ``error``.
    Only the least and greatest value are kept per key, never the list of them.
    """
    found = table.groupBy(key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    several = F.col("__lo") != F.col("__hi")
    if ambiguous == "error":
        stop = F.raise_error(F.concat(F.lit(f"several values of {value} for {key} "), F.col(key).cast("string")))
        chosen = F.when(several, stop).otherwise(F.col("__lo"))
    else:
        chosen = F.when(~several, F.col("__lo"))
    return found.select(key, chosen.alias(value), F.coalesce(several, F.lit(False)).alias("ambiguous"))


def filter_along(table: DataFrame, filtered: DataFrame, on: Sequence[tuple[str, str]], unique: bool = True) -> DataFrame:
    """Rows of ``table`` that a filtered neighbour still reaches; pairs are (table, neighbour) columns.

    Many-to-one from dimension to fact. For a two-way edge the fact is the neighbour, whose keys
    repeat: with ``unique=False`` each key is reduced to one before the shuffle.
    """
    keys = filtered.select(*[F.col(theirs).alias(mine) for mine, theirs in on])
    names = [mine for mine, _ in on]
    if unique:
        return table.join(keys, names, "left_semi")
    return split_join(table, keys.distinct(), names, "left_semi")


def default_key(value: Column | str, default) -> Column:
    """A join key in which null stands for the default value and so equals it (unlike ``<=>``)."""
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(default))


def converted_total(
    sales: DataFrame, rates: DataFrame, key: Sequence[str], amount: Column, rate: str, group: Sequence[str],
    per_row_measure: bool = False,
) -> DataFrame:
    """Sum of ``amount * rate`` with the rate looked up by key.

    ``per_row_measure`` repeats the report engine's behaviour in which a measure inside a row
    iteration sees every exact duplicate of the row: n equal rows count n times their total.
    """
    if per_row_measure:
        sales = sales.groupBy(*sales.columns).agg(F.count(F.lit(1)).alias("__n"))
        weight = F.col("__n") * F.col("__n")
    else:
        weight = F.lit(1)
    joined = sales.withColumn("__amount", amount * weight).join(rates.select(*key, rate), list(key))
    return joined.groupBy(*group).agg(F.sum(F.col("__amount") * F.col(rate)).alias("converted"))
