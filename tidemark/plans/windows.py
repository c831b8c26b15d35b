"""Window queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import ordered as O
from tidemark.operators import statistics as S
from tidemark.operators.measures import latest_day
from tidemark.plans.registry import query

PRICE = "CAST(o_totalprice AS DECIMAL(12,2))"


@query("w01_latest_by_key", """
    SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    return O.latest_by_key(rows, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).drop("ts")


@query("w02_latest_with_ties", """
    SELECT o_custkey, o_orderkey FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC) = 1""")
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", F.trunc("o_orderdate", "month").alias("month"))
    return O.latest_with_ties(rows, ["o_custkey"], "month").drop("month")


@query("w03_global_row_number", """
    SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_number FROM events""")
def _(t):
    return O.number_rows(t.events.select("event_id", "ts"), [], ["ts", "event_id"]).drop("ts")


@query("w04_line_number", """
    SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS line_number FROM events""")
def _(t):
    rows = t.events.select("event_id", "event_type", "ts")
    return O.number_rows(rows, ["event_type"], ["ts", "event_id"], "line_number").drop("ts", "event_type")


@query("w05_partition_total", f"""
    SELECT o_orderkey, o_custkey, CAST(SUM({PRICE}) OVER (PARTITION BY o_custkey) AS DOUBLE) AS customer_total FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", C.money("o_totalprice").alias("price"))
    return O.with_group_totals(rows, ["o_custkey"], F.sum("price").alias("customer_total")).drop("price")


@query("w06_first_last_value", """
    SELECT event_id, user_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER w AS last_type FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def _(t):
    moment = F.struct("ts", "event_id")
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return O.with_group_totals(rows, ["user_id"], F.min_by("event_type", moment).alias("first_type"),
                               F.max_by("event_type", moment).alias("last_type")).drop("event_type", "ts")


@query("w07_created_modified", """
    SELECT event_id, CAST(MIN(ts) OVER (PARTITION BY user_id) AS VARCHAR) AS created_on, CAST(MAX(ts) OVER (PARTITION BY user_id) AS VARCHAR) AS modified_on FROM events""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return O.with_group_totals(rows, ["user_id"], F.min("ts").alias("created_on"), F.max("ts").alias("modified_on")).drop("ts", "user_id")


@query("w08_gap_to_previous", """
    WITH g AS (SELECT date_diff('microsecond', LAG(ts) OVER (ORDER BY ts, event_id), ts) AS gap FROM events)
    SELECT COUNT(gap) AS n_gaps, CAST(SUM(gap) AS DOUBLE) / COUNT(gap) / 1000000 AS mean_gap FROM g WHERE gap IS NOT NULL""")
def _(t):
    rows = O.neighbour_row(t.events.select("ts", "event_id"), [], ["ts", "event_id"], ["ts"])
    gap = F.timestamp_diff("MICROSECOND", F.col("previous_ts"), F.col("ts"))
    return rows.agg(F.count(gap).alias("n_gaps"), (C.safe_ratio(F.sum(gap), F.count(gap)) / 1e6).alias("mean_gap"))


@query("w09_start_complete_pairs", """
    WITH e AS (SELECT user_id, event_id, ts, event_type FROM events WHERE event_type IN ('signup', 'purchase')),
    l AS (SELECT *, LAG(event_type) OVER w AS previous_type, LAG(ts) OVER w AS previous_ts FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    d AS (SELECT date_diff('microsecond', previous_ts, ts) AS us FROM l WHERE previous_type = 'signup' AND event_type = 'purchase')
    SELECT 'min' AS measure, CAST(MIN(us) AS DOUBLE) AS value FROM d UNION ALL SELECT 'max', MAX(us) FROM d
    UNION ALL SELECT 'avg', CAST(SUM(us) AS DOUBLE) / COUNT(us) FROM d""")
def _(t):
    marks = t.events.filter(F.col("event_type").isin("signup", "purchase")).select("user_id", "event_id", "ts", "event_type")
    rows = O.neighbour_row(marks, ["user_id"], ["ts", "event_id"], ["event_type", "ts"])
    pairs = rows.filter("previous_event_type = 'signup' AND event_type = 'purchase'")
    return S.labelled_extremes(pairs, F.timestamp_diff("MICROSECOND", F.col("previous_ts"), F.col("ts")))


@query("w10_time_to_next_failure", """
    WITH f AS (SELECT user_id, ts, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events WHERE event_type = 'error')
    SELECT user_id, COUNT(next_ts) AS n_pairs, CAST(SUM(date_diff('microsecond', ts, next_ts)) AS DOUBLE) / COUNT(next_ts) AS mean_us FROM f GROUP BY user_id""")
def _(t):
    failures = t.events.filter("event_type = 'error'").select("user_id", "event_id", "ts")
    rows = O.neighbour_row(failures, ["user_id"], ["ts", "event_id"], ["ts"], "next_", forward=True)
    gap = F.timestamp_diff("MICROSECOND", F.col("ts"), F.col("next_ts"))
    return rows.groupBy("user_id").agg(F.count(gap).alias("n_pairs"), C.safe_ratio(F.sum(gap), F.count(gap)).alias("mean_us"))


@query("w11_recency_label", """
    WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
    SELECT o_custkey, o_orderkey, CASE n WHEN 1 THEN 'CURRENT' WHEN 2 THEN 'PREVIOUS' WHEN 3 THEN '2ND_PREVIOUS' ELSE 'OLDER' END AS recency FROM r""")
def _(t):
    # Only three ranks per customer are ever labelled; they are found with a limited window and joined back.
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    newest = O.first_n_by_key(rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 3, "n")
    label = C.decode("n", {1: "CURRENT", 2: "PREVIOUS", 3: "2ND_PREVIOUS"}, "OLDER")
    return rows.join(newest.select("o_orderkey", "n"), "o_orderkey", "left").select("o_custkey", "o_orderkey", label.alias("recency"))


@query("w12_cumulative_month", f"""
    WITH a AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders),
    daily AS (SELECT CAST(o_orderdate AS DATE) AS d, SUM({PRICE}) AS v FROM orders GROUP BY 1),
    cur AS (SELECT day(daily.d) AS dom, CAST(SUM(v) OVER (ORDER BY daily.d) AS DOUBLE) AS this_year FROM daily, a WHERE daily.d >= date_trunc('month', a.d)),
    prev AS (SELECT day(daily.d) AS dom, CAST(SUM(v) OVER (ORDER BY daily.d) AS DOUBLE) AS last_year FROM daily, a
             WHERE daily.d >= date_trunc('month', a.d - INTERVAL 12 MONTH) AND daily.d < date_trunc('month', a.d - INTERVAL 12 MONTH) + INTERVAL 1 MONTH)
    SELECT COALESCE(cur.dom, prev.dom) AS day_of_month, this_year, last_year FROM cur FULL JOIN prev ON cur.dom = prev.dom""")
def _(t):
    this_month = F.trunc(latest_day(t.orders, "o_orderdate"), "month")

    def month_series(first, name):
        rows = t.orders.filter((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < F.add_months(first, 1)))
        daily = rows.groupBy(F.dayofmonth("o_orderdate").alias("day_of_month")).agg(F.sum(C.money("o_totalprice")).alias("v"))
        running = Window.orderBy("day_of_month").rowsBetween(Window.unboundedPreceding, 0)  # at most 31 rows
        return daily.select("day_of_month", F.sum("v").over(running).alias(name))

    last_year = month_series(F.add_months(this_month, -12), "last_year")
    return month_series(this_month, "this_year").join(last_year, "day_of_month", "full")


@query("w13_new_today_flag", """
    SELECT event_id, CASE WHEN strftime(ts, '%Y%m%d%H') = strftime(MIN(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE)), '%Y%m%d%H') THEN 'Y' ELSE 'N' END AS is_new FROM events""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    flagged = O.with_group_totals(rows, ["user_id", "day"], F.min("ts").alias("first_ts"))
    return flagged.select("event_id", C.yes_no(C.hour_key("ts") == C.hour_key("first_ts")).alias("is_new"))
