"""Aggregation and statistics queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import statistics as S
from tidemark.operators.lookups import converted_total
from tidemark.operators.measures import latest_day
from tidemark.plans.joins import NET, net
from tidemark.plans.registry import query

PRICE = "CAST(o_totalprice AS DECIMAL(12,2))"


def count_rows(name="n_rows"):
    return F.count(F.lit(1)).alias(name)


@query("a01_group_by", f"""
    SELECT o_orderstatus, o_orderpriority, CAST(SUM({PRICE}) AS DOUBLE) AS total, CAST(SUM({PRICE}) AS DOUBLE) / COUNT(*) AS mean,
           MIN(o_totalprice) AS low, MAX(o_totalprice) AS high, COUNT(*) AS n_rows FROM orders GROUP BY ALL""")
def _(t):
    total = F.sum(C.money("o_totalprice"))
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        total.alias("total"), C.safe_ratio(total, F.count(F.lit(1))).alias("mean"),
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), count_rows())


@query("a02_distinct_count", """
    SELECT event_type, COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT json_extract_string(props, '$.k')) AS n_keys FROM events GROUP BY event_type""")
def _(t):
    return t.events.groupBy("event_type").agg(
        S.distinct_count("user_id").alias("n_users"), S.distinct_count(C.json_field("props", "$.k")).alias("n_keys"))


@query("a03_conditional_count", f"""
    SELECT o_custkey, COUNT(*) FILTER (o_orderstatus = 'F') AS n_finished,
           CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN {PRICE} ELSE 0 END) AS DOUBLE) AS urgent_value FROM orders GROUP BY o_custkey""")
def _(t):
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", C.money("o_totalprice")).otherwise(0)
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_finished"), F.sum(urgent).alias("urgent_value"))


@query("a04_safe_ratio", """
    SELECT user_id, CAST(COUNT(*) FILTER (event_type = 'purchase') AS DOUBLE) / NULLIF(COUNT(*) FILTER (event_type = 'click'), 0) AS purchase_rate
    FROM events GROUP BY user_id""")
def _(t):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    return t.events.groupBy("user_id").agg(C.safe_ratio(n("purchase"), n("click")).alias("purchase_rate"))


@query("a05_having_alias", """
    SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey HAVING COUNT(*) > 12""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(count_rows("n_orders")).filter("n_orders > 12")


@query("a06_labelled_extremes", """
    WITH k AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT 'min' AS measure, CAST(MIN(k) AS DOUBLE) AS value FROM k UNION ALL SELECT 'max', MAX(k) FROM k
    UNION ALL SELECT 'avg', CAST(SUM(k) AS DOUBLE) / COUNT(k) FROM k""")
def _(t):
    return S.labelled_extremes(t.events, C.json_field("props", "$.k", "bigint"))


@query("a07_population_stddev", """
    SELECT c_mktsegment, ROUND(STDDEV_POP(c_acctbal), 4) AS spread FROM customer GROUP BY c_mktsegment""")
def _(t):
    return t.customer.groupBy("c_mktsegment").agg(F.round(F.stddev_pop("c_acctbal"), 4).alias("spread"))


@query("a08_line_fit", """
    WITH f AS (SELECT COUNT(*) AS n, regr_slope(l_extendedprice, l_quantity) AS m, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
    SELECT n, ROUND(m, 4) AS slope, ROUND(b, 4) AS intercept, concat('y = ', printf('%.2f', m), ' X + ', printf('%.2f', b)) AS equation FROM f""")
def _(t):
    fit = S.line_fit(t.lineitem, "l_quantity", "l_extendedprice")
    return fit.select("n", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                      S.equation_text(F.col("slope"), F.col("intercept")).alias("equation"))


@query("a09_grouped_r_squared", """
    WITH p AS (SELECT l_suppkey, SUM(CAST(l_quantity AS BIGINT)) AS x, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS y FROM lineitem GROUP BY l_suppkey)
    SELECT COUNT(*) AS n, ROUND(CORR(x, y) * CORR(x, y), 6) AS r_squared FROM p""")
def _(t):
    return S.grouped_r_squared(
        t.lineitem, "l_suppkey", F.sum(F.col("l_quantity").cast("bigint")), F.sum(C.money("l_extendedprice"))
    ).withColumn("r_squared", F.round("r_squared", 6))


@query("a10_grouped_r_squared_counts", """
    WITH p AS (SELECT l_suppkey, COUNT(l_quantity) AS x, COUNT(DISTINCT l_partkey) AS y FROM lineitem GROUP BY l_suppkey)
    SELECT COUNT(*) AS n, ROUND(CORR(x, y) * CORR(x, y), 6) AS r_squared FROM p""")
def _(t):
    return S.grouped_r_squared(t.lineitem, "l_suppkey", F.count("l_quantity"), F.count_distinct("l_partkey")).withColumn(
        "r_squared", F.round("r_squared", 6))


@query("a11_regression_input", f"""
    WITH y AS (SELECT o_custkey, CAST(SUM({PRICE}) AS DOUBLE) / COUNT(*) AS y FROM orders GROUP BY o_custkey)
    SELECT c_custkey, y, c_acctbal AS x, y * y AS y2, c_acctbal * c_acctbal AS x2, c_acctbal * y AS xy FROM y JOIN customer ON c_custkey = o_custkey""")
def _(t):
    means = t.orders.groupBy("o_custkey").agg(C.safe_ratio(F.sum(C.money("o_totalprice")), F.count(F.lit(1))).alias("y"))
    points = means.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "y", F.col("c_acctbal").alias("x"))
    return points.select("*", (F.col("y") * F.col("y")).alias("y2"), (F.col("x") * F.col("x")).alias("x2"),
                         (F.col("x") * F.col("y")).alias("xy"))


@query("a12_histogram", """
    WITH l AS (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi, CAST(ceil(sqrt(COUNT(*))) AS BIGINT) AS bins FROM orders),
    b AS (SELECT LEAST(CAST(floor((o_totalprice - lo) / ((hi - lo) / bins)) AS BIGINT) + 1, bins) AS bin, lo, (hi - lo) / bins AS width FROM orders, l)
    SELECT bin, lo + (bin - 1) * width AS bin_start, width AS bin_width, COUNT(*) AS n FROM b GROUP BY ALL""")
def _(t):
    return S.histogram(t.orders, "o_totalprice", S.square_root_bins(t.orders))


@query("a13_share_of_total", f"""
    SELECT o_orderpriority, CAST(SUM({PRICE}) AS DOUBLE) AS amount,
           CAST(SUM({PRICE}) AS DOUBLE) / (SELECT CAST(SUM({PRICE}) AS DOUBLE) FROM orders) AS share FROM orders GROUP BY o_orderpriority""")
def _(t):
    return S.share_of_total(t.orders, ["o_orderpriority"], C.money("o_totalprice"))


@query("a14_ratio_of_sums", f"""
    SELECT l_shipdate IS NULL AS no_date, l_linestatus, CAST(SUM({NET}) AS DOUBLE) / CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS per_unit FROM lineitem GROUP BY ALL""")
def _(t):
    return t.lineitem.groupBy(F.col("l_shipdate").isNull().alias("no_date"), "l_linestatus").agg(
        C.safe_ratio(F.sum(net()), F.sum(F.col("l_quantity").cast("bigint"))).alias("per_unit"))


@query("a15_margin_set", f"""
    WITH s AS (SELECT p_brand, CAST(SUM({NET}) AS DOUBLE) AS sales,
                      CAST(SUM(CAST(l_quantity AS DECIMAL(6,0)) * CAST(p_retailprice AS DECIMAL(10,2))) AS DOUBLE) AS cost
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
    SELECT p_brand, sales, cost, sales - cost AS margin, (sales - cost) / sales AS margin_share FROM s""")
def _(t):
    # Lines are summed per part before the join: the shuffle carries one row per part.
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.sum(net()).alias("sales"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
    priced = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    cost = F.col("qty").cast("decimal(18,0)") * F.col("p_retailprice").cast("decimal(10,2)")
    sums = priced.groupBy("p_brand").agg(F.sum("sales").cast("double").alias("sales"), F.sum(cost).cast("double").alias("cost"))
    margin = F.col("sales") - F.col("cost")
    return sums.select("p_brand", "sales", "cost", margin.alias("margin"), C.safe_ratio(margin, F.col("sales")).alias("margin_share"))


@query("a16_currency_conversion", f"""
    WITH fx AS (SELECT CAST(o_orderdate AS DATE) AS d, n_name AS cur, CAST(1 + AVG(n_nationkey) / 100 AS DECIMAL(6,2)) AS rate
                FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT n_name AS currency, CAST(SUM({PRICE} * rate) AS DOUBLE) AS converted
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN fx ON concat(strftime(d, '%Y-%m-%d'), cur) = concat(strftime(o_orderdate, '%Y-%m-%d'), n_name) GROUP BY n_name""")
def _(t):
    sales = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.to_date("o_orderdate").alias("day"), F.col("n_name").alias("currency"), "n_nationkey",
                C.money("o_totalprice").alias("amount"))
    )
    rates = sales.groupBy("day", "currency").agg((F.lit(1) + F.avg("n_nationkey") / 100).cast("decimal(6,2)").alias("rate"))
    keyed = lambda df: df.withColumn("currency_id", F.concat(F.col("day").cast("string"), F.col("currency")))
    daily = sales.groupBy("day", "currency").agg(F.sum("amount").alias("amount"))
    return converted_total(keyed(daily), keyed(rates), ["currency_id"], F.col("amount").cast("decimal(22,2)"), "rate", ["currency"])


@query("a17_time_bucket_throughput", """
    SELECT CAST(date_trunc('minute', ts) AS VARCHAR) AS minute, COUNT(*) AS n_rows, CAST(SUM(strlen(props)) AS BIGINT) AS n_bytes FROM events GROUP BY 1""")
def _(t):
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return t.events.groupBy(minute.alias("minute")).agg(count_rows(), F.sum(F.octet_length("props")).alias("n_bytes"))


@query("a18_weekly_daily_average", """
    WITH d AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1)
    SELECT CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS week, CAST(SUM(n) AS DOUBLE) / COUNT(*) AS mean_per_day FROM d GROUP BY 1""")
def _(t):
    daily = t.events.groupBy(F.to_date("ts").alias("day")).agg(count_rows("n"))
    return daily.groupBy(F.trunc("day", "week").alias("week")).agg(C.safe_ratio(F.sum("n"), F.count("n")).alias("mean_per_day"))


@query("a19_month_comparison", f"""
    WITH a AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders),
    s AS (SELECT c_nationkey, CAST(SUM(CASE WHEN o_orderdate >= date_trunc('month', d) THEN {PRICE} END) AS DOUBLE) * 0.25 AS current_cost,
                 CAST(SUM(CASE WHEN o_orderdate < date_trunc('month', d) AND o_orderdate >= date_trunc('month', d) - INTERVAL 1 MONTH THEN {PRICE} END) AS DOUBLE) * 0.25 AS last_cost,
                 date_diff('day', MAX(CAST(o_orderdate AS DATE)), MAX(d)) AS days_idle
          FROM orders JOIN customer ON o_custkey = c_custkey, a GROUP BY c_nationkey)
    SELECT n_name, current_cost, last_cost, days_idle FROM nation LEFT JOIN s ON n_nationkey = c_nationkey""")
def _(t):
    asof = latest_day(t.orders, "o_orderdate")
    month = F.trunc(asof, "month")
    d, value = F.col("o_orderdate"), C.money("o_totalprice")
    spent = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(
        F.sum(F.when(d >= month, value)).alias("cur"),
        F.sum(F.when((d < month) & (d >= F.add_months(month, -1)), value)).alias("prev"),
        F.max(d).cast("date").alias("last_use"),
    )
    rate = F.lit(0.25)
    return t.nation.join(spent, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "n_name", (F.col("cur").cast("double") * rate).alias("current_cost"), (F.col("prev").cast("double") * rate).alias("last_cost"),
        F.date_diff(asof, F.col("last_use")).alias("days_idle"))


@query("a20_presence_flag", """
    SELECT d.source, CAST(MAX(CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS has_labels FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source""")
def _(t):
    docs = t.documents.select("doc_id", "source")
    present = docs.join(t.labels, "doc_id", "left_semi").select("source").distinct().withColumn("flag", F.lit(1))
    zero = docs.select("source").distinct().withColumn("flag", F.lit(0))
    return present.unionByName(zero).groupBy("source").agg(F.max("flag").alias("has_labels"))


QUARTERS = [1, 2, 3, 4]


@query("a21_matrix", "WITH b AS (SELECT r_name, n_name, quarter(o_orderdate) AS q, " + PRICE + """ AS price FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT COALESCE(r_name, 'Total') AS region, COALESCE(n_name, 'Total') AS nation, """
       + ", ".join(f"CAST(SUM(price) FILTER (q = {q}) AS DOUBLE) AS q{q}_sales, COUNT(*) FILTER (q = {q}) AS q{q}_orders" for q in QUARTERS)
       + ", CAST(SUM(price) AS DOUBLE) AS total_sales, COUNT(*) AS total_orders FROM b GROUP BY ROLLUP (r_name, n_name)")
def _(t):
    # One reduction to (nation, quarter), then the small joins, then the rollup of few rows.
    base = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.quarter("o_orderdate").alias("q"))
        .agg(F.sum(C.money("o_totalprice")).alias("sales"), count_rows("orders"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    cells = []
    for q in QUARTERS:
        cells += [F.sum(F.when(F.col("q") == q, F.col("sales"))).alias(f"q{q}_sales"),
                  F.sum(F.when(F.col("q") == q, F.col("orders")).otherwise(0)).alias(f"q{q}_orders")]
    matrix = base.rollup("r_name", "n_name").agg(*cells, F.sum("sales").alias("total_sales"), F.sum("orders").alias("total_orders"))
    return matrix.select(F.coalesce("r_name", F.lit("Total")).alias("region"), F.coalesce("n_name", F.lit("Total")).alias("nation"),
                         *[c for c in matrix.columns if c not in ("r_name", "n_name")])


@query("a22_group_series", """
    SELECT event_type, user_id % 7 AS series, COUNT(*) AS n_rows FROM events GROUP BY ALL""")
def _(t):
    return t.events.groupBy("event_type", (F.col("user_id") % 7).alias("series")).agg(count_rows())


@query("a23_average_of_last_member", """
    SELECT CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DOUBLE) / COUNT(*) AS mean_value FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)""")
def _(t):
    day = t.events.filter(F.col("ts") >= latest_day(t.events, "ts"))
    return day.agg(C.safe_ratio(F.sum(F.col("value").cast("decimal(10,2)")), F.count("value")).alias("mean_value"))


@query("a24_counts_from_text_time", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS n_rows FROM events WHERE event_type <> 'error' GROUP BY 1""")
def _(t):
    shown = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", "MMM d, yyyy h:mm:ss a"))
    rows = t.events.select(C.to_date_or_null(shown, "MMM d, yyyy h:mm:ss a").alias("day"))
    return rows.filter(F.col("day").isNotNull()).groupBy("day").agg(count_rows())


@query("a25_spread_over_days", """
    WITH s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d1, GREATEST(CAST(o_orderdate AS DATE), MAX(CAST(l_shipdate AS DATE))) AS d2, MAX(o_totalprice) AS amount
               FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
    e AS (SELECT unnest(generate_series(d1, d2, INTERVAL 1 DAY)) AS d, amount / (date_diff('day', d1, d2) + 1) AS part FROM s)
    SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day, ROUND(SUM(part), 2) AS amount, COUNT(*) AS n_active FROM e GROUP BY 1""")
def _(t):
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    spans = t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderdate", "last_ship", "o_totalprice")
    spread = S.spread_over_days(spans, "o_orderdate", "last_ship", F.col("o_totalprice"))
    return spread.withColumn("amount", F.round(F.col("amount").cast("double"), 2))


@query("a26_hierarchy_closure", """
    WITH RECURSIVE edges AS (
        SELECT concat('c', CAST(c_custkey AS VARCHAR)) AS child, concat('n', CAST(c_nationkey AS VARCHAR)) AS parent FROM customer
        UNION ALL SELECT concat('o', CAST(o_orderkey AS VARCHAR)), concat('c', CAST(o_custkey AS VARCHAR)) FROM orders
        UNION ALL SELECT concat('n', CAST(n_nationkey AS VARCHAR)), concat('r', CAST(n_regionkey AS VARCHAR)) FROM nation),
    up AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM edges
           UNION ALL SELECT up.node, e.parent, up.depth + 1 FROM up JOIN edges e ON up.ancestor = e.child)
    SELECT node, ancestor, depth FROM up""")
def _(t):
    def name(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    edges = (
        t.customer.select(name("c", "c_custkey").alias("child"), name("n", "c_nationkey").alias("parent"))
        .unionByName(t.orders.select(name("o", "o_orderkey").alias("child"), name("c", "o_custkey").alias("parent")))
        .unionByName(t.nation.select(name("n", "n_nationkey").alias("child"), name("r", "n_regionkey").alias("parent")))
    )
    return S.hierarchy_closure(edges)


@query("a27_failure_rate", """
    SELECT user_id, COUNT(*) FILTER (event_type = 'error') AS n_failed, COUNT(*) AS n_total,
           CAST(COUNT(*) FILTER (event_type = 'error') AS DOUBLE) / COUNT(*) AS failure_rate
    FROM events WHERE ts >= date_trunc('month', (SELECT MAX(ts) FROM events)) GROUP BY user_id""")
def _(t):
    failed, total = F.count_if(F.col("event_type") == "error"), F.count(F.lit(1))
    rows = t.events.filter(F.col("ts") >= F.trunc(latest_day(t.events, "ts"), "month"))
    return rows.groupBy("user_id").agg(failed.alias("n_failed"), total.alias("n_total"), C.safe_ratio(failed, total).alias("failure_rate"))


@query("a28_members_per_object", "SELECT c_mktsegment AS role, c_nationkey, COUNT(*) AS n_users FROM customer GROUP BY ALL")
def _(t):
    return t.customer.groupBy(F.col("c_mktsegment").alias("role"), "c_nationkey").agg(count_rows("n_users"))


@query("a29_rating_share", """
    SELECT source, CAST(SUM(quality) AS DOUBLE) / COUNT(quality) AS mean_rating, COUNT(quality) AS n_answers,
           CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS share FROM documents JOIN labels USING (doc_id) GROUP BY source""")
def _(t):
    rated = t.documents.select("doc_id", "source").join(t.labels, "doc_id")
    groups = rated.groupBy("source").agg(
        C.safe_ratio(F.sum("quality"), F.count("quality")).alias("mean_rating"), F.count("quality").alias("n_answers"),
        F.count(F.lit(1)).alias("n"))
    # The grand total adds up the groups of a source, so the join runs once: the window sees one row per source.
    return groups.withColumn("share", C.safe_ratio("n", F.sum("n").over(Window.partitionBy()))).drop("n")


@query("a30_reconciliation", f"""
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, SUM({PRICE}) AS v FROM orders GROUP BY 1),
    l AS (SELECT CAST(o_orderdate AS DATE) AS d, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT CAST(o.d AS VARCHAR) AS day, CAST(o.v AS DOUBLE) AS left_value, CAST(l.v AS DOUBLE) AS right_value, CAST(o.v - COALESCE(l.v, 0) AS DOUBLE) AS variance
    FROM o LEFT JOIN l ON o.d = l.d""")
def _(t):
    header = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), C.money("o_totalprice").alias("value"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(C.money("l_extendedprice")).alias("value"))
    detail = per_order.join(header.select("o_orderkey", "day"), F.col("l_orderkey") == F.col("o_orderkey"))
    return S.reconcile(header, detail, ["day"], "value")
