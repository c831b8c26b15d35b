"""Order operators by ranges equal the plain windows, also on hot, null and tied keys."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordered as O
from tidemark.operators.ranges import range_bounds, range_number
from tidemark.operators.topn import rows_of_top_members, sequence_ids, top_members, top_one


@pytest.fixture(scope="module")
def data(spark):
    """One key holds a third of the rows, one key is null, order values repeat."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (n % 17).cast("string")))
    return spark.range(3000).select(
        n, key.alias("key"), (F.hash("id") % 400).alias("at"), F.when(n % 5 != 0, n % 11).alias("value")
    ).cache()


@pytest.fixture(params=[1, 7, 300])
def ranges(request):
    """One range, a few, and so many that most keys are cut."""
    return request.param


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_number_rows(data, ranges):
    w = Window.partitionBy("key").orderBy("at", "id")
    same(O.number_rows(data, ["key"], ["at", "id"], ranges=ranges), data.withColumn("row_number", F.row_number().over(w).cast("bigint")))


def test_number_rows_without_key(data, ranges):
    w = Window.orderBy("at", "id")
    same(O.number_rows(data, [], ["at", "id"], ranges=ranges), data.withColumn("row_number", F.row_number().over(w).cast("bigint")))


def test_running_sum(data, ranges):
    w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = data.withColumn("total", F.sum("value").over(w)).withColumn("ids", F.sum("id").over(w))
    same(O.running_sums(data, ["key"], ["at", "id"], {"total": "value", "ids": "id"}, ranges), want)


@pytest.mark.parametrize("forward", [False, True])
def test_neighbour_row(data, forward, ranges):
    w = Window.partitionBy("key").orderBy("at", "id")
    step = F.lead if forward else F.lag
    want = data.withColumn("x_value", step("value").over(w)).withColumn("x_id", step("id").over(w))
    same(O.neighbour_row(data, ["key"], ["at", "id"], ["value", "id"], "x_", forward, ranges), want)


def test_last_marked(data, ranges):
    w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("value") > 8, F.col("id"))
    same(O.last_marked(data, ["key"], ["at", "id"], mark, "m", ranges), data.withColumn("m", F.last(mark, ignorenulls=True).over(w)))


def test_group_totals_keep_null_keys(data):
    w = Window.partitionBy("key")
    want = data.withColumn("total", F.sum("value").over(w)).withColumn("n", F.count(F.lit(1)).over(w))
    same(O.with_group_totals(data, ["key"], F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")), want)


def test_latest_with_ties(data):
    w = Window.partitionBy("key").orderBy(F.col("at").desc())
    want = data.withColumn("r", F.rank().over(w)).filter("r = 1").drop("r")
    same(O.latest_with_ties(data, ["key"], "at").select(*data.columns), want)


def test_latest_by_key_limits_before_the_shuffle(data):
    out = O.latest_by_key(data, ["key"], [F.col("at").desc(), F.col("id")])
    assert out.count() == data.select("key").distinct().count()
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_large_n_per_key_is_cut_per_salt(data, monkeypatch):
    w = Window.partitionBy("key").orderBy("at", "id")
    want = data.withColumn("r", F.row_number().over(w)).filter("r <= 30")
    plain = O.first_n_by_key(data, ["key"], [F.col("at"), F.col("id")], 30, "r")
    monkeypatch.setattr(O, "WINDOW_LIMIT", 10)
    same(O.first_n_by_key(data, ["key"], [F.col("at"), F.col("id")], 30, "r"), want)
    same(plain, want)


def test_one_shuffle_of_the_rows(spark, data):
    """Window and join share the exchange: one for the rows, two for range counts, one for the join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = O.number_rows(data, ["key"], ["at", "id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 4


def test_ranges_bound_every_task(spark):
    """One key holds nine tenths of the rows, one order value a third: no group of a task is much above its share."""
    n = F.col("id")
    hot = spark.range(20_000).select(
        n, F.when(n % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), n.cast("string"))).alias("key"), F.when(n % 3 > 0, n % 1000).otherwise(5).alias("at"))
    for keys in (["key"], []):
        groups = O._ranged(hot, keys, ["at", "id"], 40).groupBy("__group").count()
        assert groups.agg(F.max("count")).first()[0] < 3 * 20_000 / 40
    got = O.number_rows(hot, ["key"], ["at", "id"], ranges=40)
    same(got, hot.withColumn("row_number", F.row_number().over(Window.partitionBy("key").orderBy("at", "id")).cast("bigint")))


def test_walk_without_keys_sees_ranges_only(spark, data):
    """What comes together in a single task is one row for each range, not the table."""
    out = O.running_sums(data, [], ["at", "id"], {"total": "value"}, ranges=12)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    single = [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]
    assert single and all("Aggregate" in plan.splitlines()[i + 1] or "Aggregate" in plan.splitlines()[i + 2] for i in single)
    assert O._ranged(data, [], ["at", "id"], 12).select("__group").distinct().count() <= 12


def test_bounds_of_every_type(spark):
    """Bounds are literals of the column's own type: numbers order as in Spark, also nulls, NaN and times."""
    rows = spark.range(400).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("ä~Z"), (F.col("id") % 40).cast("string"))).alias("s"),
        F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).when(F.col("id") % 7 > 1, F.col("id") - 200.5).alias("d"),
        (F.col("id") / 8).cast("decimal(12,3)").alias("m"), F.date_add(F.lit("1969-12-25").cast("date"), (F.col("id") % 30).cast("int")).alias("day"),
        F.timestamp_micros(F.col("id") * 3_600_000_001 + 1_711_843_200_000_000).alias("t"),
        (F.timestamp_micros(F.col("id") * 3_600_000_001 + 1_711_843_200_000_000)).cast("timestamp_ntz").alias("n"), (F.col("id") % 2 == 0).alias("b"))
    for order in (["s", "i"], ["d", "i"], ["m"], ["day", "i"], ["t"], ["n"], ["b", "i"], ["b", "s", "d", "i"]):
        bounds = range_bounds(rows, order, 8)
        assert 5 <= len(bounds) <= 7
        numbered = rows.withColumn("r", range_number(rows, order, bounds)).orderBy(*order).collect()
        numbers = [x["r"] for x in numbered]
        assert numbers == sorted(numbers) and set(numbers) == set(range(len(bounds) + 1))
    assert range_bounds(rows.limit(0), ["i"], 8) == []


def test_split_join_shuffles_both_sides(spark, data):
    """The grouped side gets a shuffle of its own; only then can AQE split a hot key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = O.with_group_totals(data, ["key"], F.sum("value").alias("total"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(__join_key") == 2


def test_top_members_keep_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1), (None, 9)], "m string, v int")
    assert {r["m"] for r in top_members(df, "m", F.sum("v"), 2).collect()} == {"a", "b", "c"}
    assert rows_of_top_members(df, "m", F.sum("v"), 1).count() == 1
    assert top_one(df.filter("m is not null"), "m", F.sum("v")).first()["m"] == "a"


def test_sequence_ids(data):
    ids = sequence_ids(data, ["id"], start=7, increment=3, name="seq")
    assert ids.filter(F.col("seq") != 7 + F.col("id") * 3).isEmpty()
