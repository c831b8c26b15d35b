"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "__join_key"


def _key(on: Sequence[str], null_safe: bool) -> Column:
    whole = F.struct(*[F.col(c) for c in on])
    if null_safe:
        return whole
    present = F.lit(True)
    for c in on:
        present = present & F.col(c).isNotNull()
    return F.when(present, whole)


def split_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join on equally named columns whose hot keys AQE can split.

    AQE splits a hot partition only where both inputs come straight from a shuffle. A right side
    that was just grouped by the join columns would be joined in place, hot key and all. Joining
    on the columns as one struct gives it a small shuffle of its own. With ``null_safe`` null
    keys match each other.
    """
    keyed = right.select(_key(on, null_safe).alias(_KEY), *[c for c in right.columns if c not in on])
    return left.withColumn(_KEY, _key(on, null_safe)).join(keyed, _KEY, how).drop(_KEY)
