"""Ranges of equal depth over a composite order: bounds from one sampling pass, kept in the plan as literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CELL = "__cell"
_HASH = "__hash"


def _literal(value, kind: T.DataType) -> Column:
    if value is not None and isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if value is not None and isinstance(kind, T.TimestampNTZType):
        # By way of text: a Python datetime would be read in the driver's time zone.
        return F.lit(value.isoformat(" ")).cast(kind)
    return F.lit(value).cast(kind)


def range_bounds(df: DataFrame, order: Sequence[str], ranges: int, per_range: int = 32) -> list[tuple]:
    """At most ``ranges - 1`` ascending keys (values of ``order``) that cut ``df`` into ranges of about equal depth.

    Every row falls into one of ``ranges * per_range`` cells by a hash of the row's place, and each cell keeps its row
    of least hash: an even sample of fixed size in one pass, shrunk in each task before the shuffle. What
    reaches the driver depends on ``ranges`` alone. Nulls order first. An empty table has no bounds.
    """
    kinds = [df.schema[c].dataType for c in order]
    place = F.xxhash64(F.monotonically_increasing_id())
    picked = [
        (F.unix_micros(F.col(f"`{c}`")) if isinstance(k, T.TimestampType) else F.col(f"`{c}`")).alias(f"c{i}")
        for i, (c, k) in enumerate(zip(order, kinds))
    ]
    names = [f"c{i}" for i in range(len(order))]
    rows = df.select(*picked, place.alias(_HASH)).withColumn(_CELL, F.pmod(_HASH, F.lit(ranges * per_range)))
    # One aggregate per column: fixed-width columns then stay in a hash aggregation.
    sample = rows.groupBy(_CELL).agg(*[F.min_by(n, _HASH).alias(n) for n in names]).orderBy(*names).select(*names).collect()
    cuts = (sample[len(sample) * i // ranges] for i in range(1, ranges)) if sample else ()
    return list(dict.fromkeys(tuple(r) for r in cuts))


def range_number(df: DataFrame, order: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """Number of the range, from 0, that holds a row of ``df``: how many of ``bounds`` are at or before its key.

    The bounds are literals of the plan and the search halves them, so that every read, and every retry after a lost
    executor, gives a row the same number.
    """
    if not bounds:
        return F.lit(0)
    kinds = [df.schema[c].dataType for c in order]
    key = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(order)])
    table = F.array(*[F.struct(*[_literal(v, k).alias(f"c{i}") for i, (v, k) in enumerate(zip(b, kinds))]) for b in bounds])
    steps = F.array(*[F.lit(2**i) for i in reversed(range(len(bounds).bit_length()))])
    # Beyond the last bound ``get`` is null, and so is the comparison.
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at))
