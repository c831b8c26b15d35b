"""Filter and predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.measures import latest_day
from tidemark.plans.registry import query


@query("f01_newest_load", """
    SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)""")
def _(t):
    events = t.events
    return events.filter(F.col("ts") >= latest_day(events, "ts")).select("event_id", "event_type")


@query("f02_relative_dates", """
    WITH a AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders)
    SELECT CAST(COUNT(*) FILTER (o_orderdate >= d - 7) AS BIGINT) AS last_7, CAST(COUNT(*) FILTER (o_orderdate >= d - 30) AS BIGINT) AS last_30,
           CAST(COUNT(*) FILTER (o_orderdate >= d - 90) AS BIGINT) AS last_90,
           COUNT(*) FILTER (o_orderdate >= d - INTERVAL 6 MONTH) AS last_6_months,
           COUNT(*) FILTER (o_orderdate >= date_trunc('month', d)) AS month_to_date,
           COUNT(*) FILTER (o_orderdate >= date_trunc('month', d) - INTERVAL 1 MONTH AND o_orderdate < date_trunc('month', d)) AS previous_month
    FROM orders, a""")
def _(t):
    asof = latest_day(t.orders, "o_orderdate")
    d, month = F.col("o_orderdate"), F.trunc(asof, "month")
    recent = t.orders.filter(d >= F.add_months(asof, -6))
    return recent.agg(
        F.count_if(d >= F.date_sub(asof, 7)).alias("last_7"),
        F.count_if(d >= F.date_sub(asof, 30)).alias("last_30"),
        F.count_if(d >= F.date_sub(asof, 90)).alias("last_90"),
        F.count_if(d >= F.add_months(asof, -6)).alias("last_6_months"),
        F.count_if(d >= month).alias("month_to_date"),
        F.count_if((d >= F.add_months(month, -1)) & (d < month)).alias("previous_month"),
    )


@query("f03_case_insensitive_prefix", """
    SELECT doc_id, n_chars FROM documents WHERE text ILIKE 'the%' AND lang LIKE 'e_' AND text LIKE '%and%'""")
def _(t):
    return t.documents.filter(F.col("text").ilike("the%") & F.col("lang").like("e_") & F.col("text").like("%and%")).select(
        "doc_id", "n_chars")


@query("f04_in_lists", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O')
    AND o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') AND o_orderstatus <> 'P' AND o_custkey IS NOT NULL""")
def _(t):
    return t.orders.filter(
        F.col("o_orderstatus").isin("F", "O") & ~F.col("o_orderpriority").isin("5-LOW", "4-NOT SPECIFIED")
        & (F.col("o_orderstatus") != "P") & F.col("o_custkey").isNotNull()
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("f05_range_slicer", """
    SELECT p_partkey, p_size, p_type FROM part WHERE p_size BETWEEN 10 AND 20 AND p_type IN ('SMALL', 'PROMO')""")
def _(t):
    return t.part.filter(F.col("p_size").between(10, 20) & F.col("p_type").isin("SMALL", "PROMO")).select(
        "p_partkey", "p_size", "p_type")


@query("f06_latest_run_rows", """
    SELECT event_type, COUNT(*) AS n_rows FROM events
    WHERE ts >= (SELECT ts FROM events WHERE event_type = 'signup' ORDER BY ts DESC, event_id DESC LIMIT 1) GROUP BY event_type""")
def _(t):
    start = t.events.filter(F.col("event_type") == "signup").agg(F.max("ts")).scalar()
    return t.events.filter(F.col("ts") >= start).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query("f07_active_window", """
    WITH a AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders),
    done AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 7 END AS completed FROM orders)
    SELECT o_orderkey FROM done, a WHERE completed + 14 >= d OR (completed IS NULL AND CAST(o_orderdate AS DATE) + 15 >= d)""")
def _(t):
    asof = latest_day(t.orders, "o_orderdate")
    completed = F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("o_orderdate").cast("date"), 7))
    rows = t.orders.withColumn("completed", completed)
    return rows.filter(
        (F.date_add("completed", 14) >= asof)
        | (F.col("completed").isNull() & (F.date_add(F.col("o_orderdate").cast("date"), 15) >= asof))
    ).select("o_orderkey")


@query("f08_local_day_bound", """
    SELECT event_id FROM events WHERE strftime(timezone('Australia/Melbourne', timezone('UTC', ts)), '%Y%m%d') >= '20240115'""")
def _(t):
    # The local day start is turned into UTC once, so the bound reaches the file scan.
    bound = C.zone_to_utc(F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), "Australia/Melbourne")
    return t.events.filter(F.col("ts") >= bound).select("event_id")


@query("f09_soft_delete", """
    WITH d AS (SELECT user_id, MAX(CASE WHEN event_type = 'error' THEN ts END) AS deleted_on, COUNT(*) AS n_events FROM events GROUP BY user_id)
    SELECT user_id, n_events FROM d WHERE deleted_on IS NULL OR deleted_on < TIMESTAMP '2024-01-29 00:00:00'""")
def _(t):
    users = t.events.groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("deleted_on"), F.count(F.lit(1)).alias("n_events"))
    alive = F.col("deleted_on").isNull() | (F.col("deleted_on") < F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    return users.filter(alive).select("user_id", "n_events")


@query("f10_query_parameters", """
    SELECT 'ordered' AS side, COUNT(*) AS n_rows FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3
    UNION ALL SELECT 'shipped', COUNT(*) FROM lineitem WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 3""")
def _(t):
    text = """
        SELECT 'ordered' AS side, count(*) AS n_rows FROM {orders}
        WHERE o_orderdate >= make_date(:year, :period, 1) AND o_orderdate < add_months(make_date(:year, :period, 1), 1)
        UNION ALL
        SELECT 'shipped', count(*) FROM {lineitem}
        WHERE l_shipdate >= make_date(:year, :period, 1) AND l_shipdate < add_months(make_date(:year, :period, 1), 1)"""
    return t.spark.sql(text, args={"year": 1998, "period": 3}, orders=t.orders, lineitem=t.lineitem)
