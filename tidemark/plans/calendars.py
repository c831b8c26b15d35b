"""Calendar and time-intelligence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import dates as D
from tidemark.operators import measures as M
from tidemark.plans.joins import NET, net
from tidemark.plans.registry import query

PRICE = "CAST(o_totalprice AS DECIMAL(12,2))"
CALENDAR_SQL = """bounds AS (SELECT date_trunc('year', MIN(o_orderdate)) AS lo, date_trunc('year', MAX(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS hi FROM orders),
    cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)"""
ASOF_SQL = "a AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders)"


def nation_periods(t, periods):
    """Period sums per nation: summed per customer first, so the join carries one row per buyer."""
    per_buyer = M.period_totals(
        t.orders, "o_orderdate", {"nsv": C.money("o_totalprice")}, M.latest_day(t.orders, "o_orderdate"), ["o_custkey"], periods)
    sums = [F.sum(f"nsv_{p}").alias(f"nsv_{p}") for p in periods]
    return per_buyer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(*sums)


@query("t01_calendar", f"WITH {CALENDAR_SQL} SELECT CAST(d AS VARCHAR) AS date FROM cal")
def _(t):
    return D.calendar_for(t.orders, "o_orderdate")


@query("t02_calendar_attributes", f"""
    WITH {CALENDAR_SQL}
    SELECT CAST(d AS VARCHAR) AS date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, day(d) AS day_of_month,
      CASE WHEN day(d) IN (1, 21, 31) THEN 'st' WHEN day(d) IN (2, 22) THEN 'nd' WHEN day(d) IN (3, 23) THEN 'rd' ELSE 'th' END AS day_suffix,
      isodow(d) AS iso_weekday, dayname(d) AS weekday_name, CASE WHEN isodow(d) >= 6 THEN 'Yes' ELSE 'No' END AS is_weekend,
      (day(d) - 1) // 7 + 1 AS weekday_in_month, dayofyear(d) AS day_of_year, week(d) AS iso_week, (dayofyear(d) - 1) // 7 + 1 AS week_of_year,
      (day(d) - 1 + isodow(CAST(date_trunc('month', d) AS DATE)) - 1) // 7 + 1 AS week_of_month, month(d) AS month, monthname(d) AS month_name,
      strftime(d, '%b-%Y') AS month_year, strftime(d, '%m%Y') AS mmyyyy, year(d) * 100 + month(d) AS yyyymm, quarter(d) AS quarter,
      list_extract(['First', 'Second', 'Third', 'Fourth'], quarter(d)) AS quarter_name, concat(CAST(year(d) AS VARCHAR), '-Q', CAST(quarter(d) AS VARCHAR)) AS quarter_code,
      year(d) * 10 + quarter(d) AS quarter_sort, year(d) AS year, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS first_of_month, CAST(last_day(d) AS VARCHAR) AS last_of_month,
      CAST(CAST(date_trunc('quarter', d) AS DATE) AS VARCHAR) AS first_of_quarter, CAST(CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS last_of_quarter,
      CAST(CAST(date_trunc('year', d) AS DATE) AS VARCHAR) AS first_of_year, CAST(CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS last_of_year,
      CAST(CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS first_of_next_month, CAST(CAST(date_trunc('year', d) + INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS first_of_next_year,
      day(last_day(d)) AS days_in_month, CASE WHEN day(d) = 1 THEN 'Yes' ELSE 'No' END AS is_first_day, CASE WHEN d = last_day(d) THEN 'Yes' ELSE 'No' END AS is_last_day FROM cal""")
def _(t):
    return D.with_calendar_attributes(D.calendar_for(t.orders, "o_orderdate"))


@query("t03_fiscal_attributes", f"""
    WITH {CALENDAR_SQL}, f AS (SELECT d, CASE WHEN month(d) >= 7 THEN year(d) ELSE year(d) - 1 END AS fy, (month(d) - 7 + 12) % 12 + 1 AS fm FROM cal)
    SELECT CAST(d AS VARCHAR) AS date, fy AS fiscal_year, fm AS fiscal_month, lpad(CAST(fm AS VARCHAR), 2, '0') AS fiscal_month_text, (fm - 1) // 3 + 1 AS fiscal_quarter,
           concat('FY', CAST(fy AS VARCHAR), '-Q', CAST((fm - 1) // 3 + 1 AS VARCHAR)) AS fiscal_quarter_code, fy * 100 + fm AS fiscal_yyyymm,
           date_diff('day', make_date(fy, 7, 1), d) // 7 + 1 AS fiscal_week FROM f""")
def _(t):
    return D.with_fiscal_attributes(D.calendar_for(t.orders, "o_orderdate"), start_month=7)


@query("t04_data_flags", f"""
    WITH {CALENDAR_SQL}, {ASOF_SQL}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS x FROM orders)
    SELECT CAST(cal.d AS VARCHAR) AS date, CASE WHEN x IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_data, CASE WHEN cal.d = a.d THEN 'Yes' ELSE 'No' END AS is_latest_date,
           CASE WHEN date_trunc('month', cal.d) = date_trunc('month', a.d) THEN 'Yes' ELSE 'No' END AS is_latest_month, CASE WHEN cal.d > a.d THEN 'Yes' ELSE 'No' END AS in_future
    FROM cal LEFT JOIN days ON cal.d = x, a""")
def _(t):
    return D.with_data_flags(D.calendar_for(t.orders, "o_orderdate"), t.orders, "o_orderdate")


def period_query(name: str, periods: dict[str, str]):
    sums = ", ".join(f"CAST(SUM({PRICE}) FILTER ({cond}) AS DOUBLE) AS nsv_{p}" for p, cond in periods.items())
    any_of = " OR ".join(f"({c})" for c in ["o_orderdate >= date_trunc('year', d - INTERVAL 12 MONTH)"])

    @query(name, f"""
        WITH {ASOF_SQL} SELECT c_nationkey, {sums} FROM orders JOIN customer ON o_custkey = c_custkey, a WHERE {any_of} GROUP BY c_nationkey""")
    def _(t):
        return nation_periods(t, list(periods))


period_query("t05_month_to_date", {"mtd": "o_orderdate >= date_trunc('month', d)"})
period_query("t06_month_to_date_last_year", {
    "mtd_ly": "o_orderdate >= date_trunc('month', d - INTERVAL 12 MONTH) AND o_orderdate <= d - INTERVAL 12 MONTH"})
period_query("t07_year_to_date", {"ytd": "o_orderdate >= date_trunc('year', d)"})
period_query("t08_year_to_date_last_year", {
    "ytd_ly": "o_orderdate >= date_trunc('year', d - INTERVAL 12 MONTH) AND o_orderdate <= d - INTERVAL 12 MONTH"})


@query("t09_same_period_last_year", f"""
    WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS d, SUM({PRICE}) AS v FROM orders GROUP BY 1)
    SELECT CAST(x.d AS VARCHAR) AS day, CAST(x.v AS DOUBLE) AS nsv, CAST(y.v AS DOUBLE) AS nsv_ly FROM daily x LEFT JOIN daily y ON y.d = CAST(x.d - INTERVAL 12 MONTH AS DATE)""")
def _(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(C.money("o_totalprice")).alias("nsv"))
    return M.same_period_last_year(daily, "day", "nsv")


KPI_SQL = f"""WITH {ASOF_SQL}, s AS (SELECT c_nationkey,
      CAST(SUM({PRICE}) FILTER (o_orderdate >= date_trunc('month', d)) AS DOUBLE) AS nsv_mtd,
      CAST(SUM({PRICE}) FILTER (o_orderdate >= date_trunc('month', d - INTERVAL 12 MONTH) AND o_orderdate <= d - INTERVAL 12 MONTH) AS DOUBLE) AS nsv_mtd_ly,
      CAST(SUM({PRICE}) FILTER (o_orderdate >= date_trunc('year', d)) AS DOUBLE) AS nsv_ytd,
      CAST(SUM({PRICE}) FILTER (o_orderdate >= date_trunc('year', d - INTERVAL 12 MONTH) AND o_orderdate <= d - INTERVAL 12 MONTH) AS DOUBLE) AS nsv_ytd_ly
    FROM orders JOIN customer ON o_custkey = c_custkey, a WHERE o_orderdate >= date_trunc('year', d - INTERVAL 12 MONTH) GROUP BY c_nationkey)"""


def kpi(t):
    return nation_periods(t, M.PERIODS[1:])


@query("t10_growth", KPI_SQL + """ SELECT c_nationkey, nsv_mtd - nsv_mtd_ly AS mtd_change,
    CASE WHEN nsv_mtd IS NOT NULL THEN nsv_mtd / NULLIF(nsv_mtd_ly, 0) - 1 END AS mtd_growth,
    NULLIF((nsv_ytd - nsv_ytd_ly) / NULLIF(nsv_ytd_ly, 0), 0) AS ytd_growth FROM s""")
def _(t):
    wide = kpi(t)
    c = {n: F.col(n).cast("double") for n in wide.columns}
    return wide.select("c_nationkey", (c["nsv_mtd"] - c["nsv_mtd_ly"]).alias("mtd_change"),
                       M.growth(c["nsv_mtd"], c["nsv_mtd_ly"]).alias("mtd_growth"),
                       M.growth_blank_zero(c["nsv_ytd"], c["nsv_ytd_ly"]).alias("ytd_growth"))


@query("t11_month_progress", """
    WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT CAST(d AS VARCHAR) AS day, concat(CAST(day(d) AS VARCHAR), ' of ', CAST(day(last_day(d)) AS VARCHAR), ' days') AS progress,
           CAST(day(d) AS DOUBLE) / day(last_day(d)) AS share FROM d""")
def _(t):
    d = F.col("day")
    number, total = F.dayofmonth(d), F.dayofmonth(F.last_day(d))
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", F.concat(number.cast("string"), F.lit(" of "), total.cast("string"), F.lit(" days")).alias("progress"),
                       C.safe_ratio(number, total).alias("share"))


# The metric list of the executive summary.
METRICS = ["Sales Qty", "NSV", "NSV per Unit"]
CALCULATIONS = ["Daily Last Trading Day", "MTD", "MTD YoY Growth %", "YTD", "YTD YoY Growth %"]


def _metric_sql() -> str:
    parts = []
    for m, metric in enumerate(METRICS):
        value = lambda p: [f"qty_{p}", f"nsv_{p}", f"nsv_{p} / NULLIF(qty_{p}, 0)"][m]  # noqa: B023, E731
        exprs = [value("day"), value("mtd"), f"({value('mtd')}) / NULLIF({value('mtd_ly')}, 0) - 1", value("ytd"),
                 f"({value('ytd')}) / NULLIF({value('ytd_ly')}, 0) - 1"]
        parts += [f"SELECT {m * 5 + c} AS metric_index, '{metric}' AS metric, '{calc}' AS calculation, {exprs[c]} AS value FROM w"
                  for c, calc in enumerate(CALCULATIONS)]
    return " UNION ALL ".join(parts)


LINE_PERIODS = {
    "day": "CAST(l_shipdate AS DATE) = d",
    "mtd": "l_shipdate >= date_trunc('month', d)",
    "mtd_ly": "l_shipdate >= date_trunc('month', d - INTERVAL 12 MONTH) AND l_shipdate <= d - INTERVAL 12 MONTH",
    "ytd": "l_shipdate >= date_trunc('year', d)",
    "ytd_ly": "l_shipdate >= date_trunc('year', d - INTERVAL 12 MONTH) AND l_shipdate <= d - INTERVAL 12 MONTH",
}


@query("t12_metric_table", "WITH a AS (SELECT MAX(CAST(l_shipdate AS DATE)) AS d FROM lineitem), w AS (SELECT "
       + ", ".join(f"CAST(SUM(CAST(l_quantity AS BIGINT)) FILTER ({c}) AS DOUBLE) AS qty_{p}, CAST(SUM({NET}) FILTER ({c}) AS DOUBLE) AS nsv_{p}"
                   for p, c in LINE_PERIODS.items()) + " FROM lineitem, a) " + _metric_sql())
def _(t):
    asof = M.latest_day(t.lineitem, "l_shipdate")
    wide = M.period_totals(t.lineitem, "l_shipdate", {"qty": F.col("l_quantity").cast("bigint"), "nsv": net()}, asof)
    cells = []
    for m, metric in enumerate(METRICS):
        def value(p, m=m):
            qty, nsv = F.col(f"qty_{p}").cast("double"), F.col(f"nsv_{p}").cast("double")
            return (qty, nsv, C.safe_ratio(nsv, qty))[m]

        numbers = [value("day"), value("mtd"), M.growth(value("mtd"), value("mtd_ly")), value("ytd"), M.growth(value("ytd"), value("ytd_ly"))]
        cells += [(metric, calc, number) for calc, number in zip(CALCULATIONS, numbers)]
    return M.metric_table(wide, cells)


@query("t13_date_drill", f"""
    SELECT year(o_orderdate) AS yr, quarter(o_orderdate) AS qtr, month(o_orderdate) AS mon, day(o_orderdate) AS dom,
           GROUPING(year(o_orderdate), quarter(o_orderdate), month(o_orderdate), day(o_orderdate)) AS level, CAST(SUM({PRICE}) AS DOUBLE) AS nsv
    FROM orders GROUP BY ROLLUP (year(o_orderdate), quarter(o_orderdate), month(o_orderdate), day(o_orderdate))""")
def _(t):
    # Days first: the rollup then expands one row per day, not one per order.
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.sum(C.money("o_totalprice")).alias("nsv"))
    parts = daily.select(F.year("d").alias("yr"), F.quarter("d").alias("qtr"), F.month("d").alias("mon"), F.dayofmonth("d").alias("dom"), "nsv")
    return parts.rollup("yr", "qtr", "mon", "dom").agg(F.grouping_id().alias("level"), F.sum("nsv").alias("nsv"))


@query("executive_kpi", KPI_SQL + """, top AS (SELECT c_nationkey FROM s ORDER BY nsv_ytd DESC NULLS LAST, c_nationkey LIMIT 5)
    SELECT n_name, nsv_mtd, nsv_mtd_ly, nsv_ytd, nsv_ytd_ly, nsv_mtd / NULLIF(nsv_mtd_ly, 0) - 1 AS mtd_growth, nsv_ytd / NULLIF(nsv_ytd_ly, 0) - 1 AS ytd_growth
    FROM s JOIN top USING (c_nationkey) JOIN nation ON c_nationkey = n_nationkey""")
def executive_kpi(t):
    """Top five nations by year-to-date sales with growth on last year."""
    wide = kpi(t)
    best = wide.orderBy(F.col("nsv_ytd").desc_nulls_last(), "c_nationkey").limit(5)
    d = {n: F.col(n).cast("double") for n in wide.columns}
    return best.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_name", *[d[f"nsv_{p}"].alias(f"nsv_{p}") for p in M.PERIODS[1:]],
        M.growth(d["nsv_mtd"], d["nsv_mtd_ly"]).alias("mtd_growth"), M.growth(d["nsv_ytd"], d["nsv_ytd_ly"]).alias("ytd_growth"))
