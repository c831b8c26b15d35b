"""Aggregation helpers: labelled rows, regression, histograms, spreading, hierarchy closure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_col, safe_ratio
from tidemark.session import cut_lineage


def distinct_count(value: Column | str, max_error: float | None = None) -> Column:
    """Exact distinct count, or a sketch of bounded size with the given relative error."""
    return F.count_distinct(as_col(value)) if max_error is None else F.approx_count_distinct(as_col(value), max_error)


def labelled_extremes(df: DataFrame, value: Column | str) -> DataFrame:
    """Rows (measure, value) for min, max and avg out of one aggregate."""
    v = as_col(value)
    one = df.agg(F.min(v).cast("double").alias("min"), F.max(v).cast("double").alias("max"),
                 safe_ratio(F.sum(v), F.count(v)).alias("avg"))
    return one.unpivot([], ["min", "max", "avg"], "measure", "value")


def line_fit(df: DataFrame, x: Column | str, y: Column | str) -> DataFrame:
    """Least-squares line: n, slope, intercept; null when x does not vary.

    Spark's regression aggregates merge centred moments, which stay exact where plain sums of
    squares over many rows would cancel.
    """
    x, y = as_col(x).cast("double"), as_col(y).cast("double")
    fit = df.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    return fit.select("n", *[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in ("slope", "intercept")])


def equation_text(slope: Column, intercept: Column) -> Column:
    return F.concat(F.lit("y = "), F.format_string("%.2f", slope), F.lit(" X + "), F.format_string("%.2f", intercept))


def grouped_r_squared(df: DataFrame, group: str, x: Column, y: Column) -> DataFrame:
    """R squared over groups: x and y are aggregated per group first, then Pearson squared.

    Only groups with a non-null product count towards n; sums skip nulls one by one.
    """
    points = df.groupBy(group).agg(x.cast("double").alias("x"), y.cast("double").alias("y"))
    s = points.agg(
        F.count(F.col("x") * F.col("y")).cast("double").alias("n"),
        F.sum("x").alias("sx"),
        F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum(F.col("y") * F.col("y")).alias("syy"),
    )
    n = F.col("n")
    spread = (n * F.col("sxx") - F.col("sx") * F.col("sx")) * (n * F.col("syy") - F.col("sy") * F.col("sy"))
    pearson = F.try_divide(n * F.col("sxy") - F.col("sx") * F.col("sy"), F.sqrt(spread))
    return s.select(n.cast("bigint").alias("n"), (pearson * pearson).alias("r_squared"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the data's min and max; the max falls into the last bin."""
    v = F.col(value).cast("double")
    limits = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    position = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor(F.try_divide(v - lo, width)).cast("int") + 1, F.lit(bins))
    )
    return (
        df.filter(v.isNotNull())
        .groupBy(position.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (lo + (F.col("bin") - 1) * width).alias("bin_start"), width.alias("bin_width"), "n")
    )


def square_root_bins(df: DataFrame) -> int:
    """Bin count by the square-root rule (one count action, an integer comes back)."""
    return max(1, int(-(-(df.count() ** 0.5) // 1)))


def share_of_total(df: DataFrame, keys: Sequence[str], value: Column, name: str = "amount") -> DataFrame:
    """Group totals with their share of the grand total of the unfiltered input.

    The grand total adds up the group totals, so the input is read once.
    """
    grouped = df.groupBy(*keys).agg(F.sum(value).alias(name))
    grand = grouped.agg(F.sum(name)).scalar()
    return grouped.withColumn("share", safe_ratio(F.col(name), grand))


def spread_over_days(
    df: DataFrame, start: str, end: str, amount: Column, keys: Sequence[str] = (), name: str = "day"
) -> DataFrame:
    """Amounts split evenly over the days they span (both ends count), summed per day and key.

    No row is multiplied by its days: each adds its daily rate at its first day and takes it back
    after its last, and a running sum over the calendar gives the daily totals.
    """
    first = F.col(start).cast("date")
    last = F.greatest(first, F.col(end).cast("date"))
    rate = amount.cast("decimal(18,2)") / (F.date_diff(last, first) + 1)
    rated = df.select(*keys, first.alias("__first"), last.alias("__last"), rate.alias("__rate"))
    opening = F.struct(F.col("__first").alias(name), F.col("__rate").alias("r"), F.lit(1).alias("n"))
    closing = F.struct(F.date_add("__last", 1).alias(name), (-F.col("__rate")).alias("r"), F.lit(-1).alias("n"))
    steps = rated.select(*keys, F.explode(F.array(opening, closing)).alias("s")).select(*keys, "s.*")
    daily = steps.groupBy(*keys, name).agg(F.sum("r").alias("r"), F.sum("n").alias("n"))
    bounds = daily.groupBy(*keys).agg(F.min(name).alias("lo"), F.max(name).alias("hi"))
    calendar = bounds.select(*keys, F.explode(F.sequence("lo", "hi")).alias(name))
    running = Window.partitionBy(*keys).orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    totals = calendar.join(daily, [*keys, name], "left").select(
        *keys, name, F.sum("r").over(running).alias("amount"), F.sum("n").over(running).alias("n_active")
    )
    return totals.filter("n_active > 0")


def hierarchy_closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """All (node, ancestor, depth) pairs of a parent-child graph, one row per path; a cycle raises ``ValueError``.

    Paths double: those of exactly the length reached so far are joined with all known ones, so the rounds
    grow with the logarithm of the depth. Each path splits in one way only, so none repeats. Every round
    is checkpointed; a lost executor costs one round at most. A node of a cycle becomes its own
    ancestor in the round that reaches the cycle's length. Edges with a null end lead no further.
    """
    links = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth"))
    newest, closure, reach = cut_lineage(links), None, 1
    while not newest.isEmpty():
        if (own := newest.where("node = ancestor").select("node").first()) is not None:
            raise ValueError(f"the hierarchy has a cycle through {own['node']!r}")
        closure = newest if closure is None else closure.unionByName(newest)
        far = newest.where(F.col("depth") == reach).select("node", F.col("ancestor").alias("__via"))
        onward = closure.select(F.col("node").alias("__at"), "ancestor", (F.col("depth") + reach).alias("depth"))
        newest = cut_lineage(far.join(onward, F.col("__via") == F.col("__at")).select("node", "ancestor", "depth"))
        reach *= 2
    return newest if closure is None else closure


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Two sources at one grain: left value, right value, variance (a missing right side counts as 0)."""
    a = left.groupBy(*keys).agg(F.sum(value).alias("left_value"))
    b = right.groupBy(*keys).agg(F.sum(value).alias("right_value"))
    both = a.join(b, list(keys), "left")
    return both.withColumn("variance", F.col("left_value") - F.coalesce(F.col("right_value"), F.lit(0)))
