"""Order-dependent operators that survive hot keys.

A plain window puts a whole key into one task. Here the rows are cut into ranges of equal depth along (keys, order): one
sampling pass draws the bounds, which then stand in the plan as literals. The window runs per (key, range), and one small
row per (key, range) carries the state across the ranges of a key: a row offset, a running sum, the last row. Results are
those of the plain window. A task never holds more of a key than a range, and the walk over the ranges, also
without keys, sees as many rows as there are ranges, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import range_bounds, range_number
from tidemark.operators.skew import split_join
from tidemark.session import file_count

WINDOW_LIMIT = 1000  # Spark's spark.sql.optimizer.windowGroupLimitThreshold
SALTS = 64

_GROUP = "__group"
_RANGE = "__range"


def _key_order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None) -> DataFrame:
    """Keys and range as one struct: null keys equal null keys, and the window and the join on it share one shuffle.

    There are as many ranges as the cluster's shuffle is wide, unless the caller says otherwise.
    """
    along = [*keys, *order]
    bounds = range_bounds(df, along, ranges or file_count(df.sparkSession))
    number = range_number(df, along, bounds).alias(_RANGE)
    return df.withColumn(_GROUP, F.struct(*[F.col(k) for k in keys], number))


def _per_range(rows: DataFrame, keys: Sequence[str], *aggregates: Column):
    """One row per (keys, range), and the window that walks the ranges of a key in order."""
    edges = rows.groupBy(_GROUP).agg(*aggregates)
    walk = Window.partitionBy(*[F.col(f"{_GROUP}.{k}") for k in keys]).orderBy(f"{_GROUP}.{_RANGE}")
    return edges, walk


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number", ranges: int | None = None
) -> DataFrame:
    """``row_number() over (partition by keys order by order)``; ``order`` is ascending and total."""
    rows = _ranged(df, keys, order, ranges)
    edges, walk = _per_range(rows, keys, F.count(F.lit(1)).alias("__n"))
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.select(_GROUP, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy(_GROUP).orderBy(*order))
    numbered = rows.withColumn("__rn", inside).join(offsets, _GROUP)
    return numbered.withColumn(name, F.col("__rn") + F.col("__offset")).drop("__rn", "__offset", _GROUP)


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str], ranges: int | None = None
) -> DataFrame:
    """``sum(column) over (partition by keys order by order rows unbounded preceding)`` for each
    ``{name: column}``."""
    rows = _ranged(df, keys, order, ranges)
    edges, walk = _per_range(rows, keys, *[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()])
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.select(_GROUP, *[F.sum(f"__s_{n}").over(before).alias(f"__o_{n}") for n in sums])
    inside = Window.partitionBy(_GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select("*", *[F.sum(c).over(inside).alias(f"__r_{n}") for n, c in sums.items()]).join(offsets, _GROUP)
    for n in sums:
        here, earlier = F.col(f"__r_{n}"), F.col(f"__o_{n}")
        out = out.withColumn(n, F.when(earlier.isNull(), here).otherwise(earlier + F.coalesce(here, F.lit(0))))
    return out.drop(_GROUP, *[f"__{x}_{n}" for n in sums for x in "ro"])


def neighbour_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    prefix: str = "previous_",
    forward: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Values of the previous (or next) row in order: ``lag`` / ``lead`` by one row."""
    step, edge_of = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    rows = _ranged(df, keys, order, ranges).withColumn("__v", F.struct(*values))
    edges, walk = _per_range(rows, keys, edge_of(F.col("__v"), _key_order(order)).alias("__edge"))
    carried = edges.select(_GROUP, step("__edge").over(walk).alias("__carry"))
    inside = step("__v").over(Window.partitionBy(_GROUP).orderBy(*order))
    out = rows.withColumn("__in", inside).join(carried, _GROUP)
    hit = F.coalesce(F.col("__in"), F.col("__carry"))
    for v in values:
        out = out.withColumn(f"{prefix}{v}", hit[v])
    return out.drop("__v", "__in", "__carry", _GROUP)


def last_marked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, ranges: int | None = None
) -> DataFrame:
    """Latest non-null ``value`` at or before each row (forward fill)."""
    rows = _ranged(df, keys, order, ranges).withColumn("__m", value)
    marked = F.when(F.col("__m").isNotNull(), _key_order(order))
    edges, walk = _per_range(rows, keys, F.max_by(F.col("__m"), marked).alias("__last"))
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(_GROUP, F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    inside = Window.partitionBy(_GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn("__in", F.last("__m", ignorenulls=True).over(inside)).join(carried, _GROUP)
    return filled.withColumn(name, F.coalesce(F.col("__in"), F.col("__carry"))).drop("__m", "__in", "__carry", _GROUP)


def with_group_totals(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Whole-group aggregates beside each row.

    Aggregates shrink before the shuffle and the join back can be split by AQE when a key is
    hot; ``agg() over (partition by ...)`` could not.
    """
    return split_join(df, df.groupBy(*keys).agg(*aggregates), keys, null_safe=True)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, first by ``order``. Spark limits each key to one row before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def first_n_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None):
    """At most ``n`` rows per key (a report or a sample of n); also limited before the shuffle.

    Beyond the size up to which Spark limits a window early, each key is first cut per salt of
    the row's hash, so that a hot key spreads; the best n are among the best n of every salt.
    """
    name = rank or "__rn"
    if n >= WINDOW_LIMIT:
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        per_salt = Window.partitionBy(*keys, "__salt").orderBy(*order)
        df = salted.withColumn("__cut", F.row_number().over(per_salt)).filter(F.col("__cut") <= n).drop("__salt", "__cut")
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_with_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows that share the greatest ``order`` value of their key (rank = 1).

    Greatest value by pre-aggregation, then an equi-join: tied rows of a hot key stay spread. A key
    with only null ``order`` values keeps all its rows.
    """
    top = df.groupBy(*keys).agg(F.max(order).alias(order))
    return split_join(df, top, [*keys, order], "left_semi", null_safe=True)
