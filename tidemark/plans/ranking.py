"""Sort, limit, top-N, sampling, sequence, set and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import topn as N
from tidemark.operators.ordered import first_n_by_key
from tidemark.plans.columns import BAND_EDGES, BAND_LABELS
from tidemark.plans.registry import query
from tidemark.session import file_count, scratch_dir

PRICE = "CAST(o_totalprice AS DECIMAL(12,2))"


def hash_sql(text: str) -> str:
    return f"CAST(concat('0x', substr(md5({text}), 1, 8)) AS BIGINT)"


@query("k01_order_by", """
    SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n_orders FROM orders GROUP BY ALL ORDER BY o_orderpriority, n_orders DESC, 2""")
def _(t):
    counts = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.orderBy(F.col("o_orderpriority").asc(), F.col("n_orders").desc(), "o_orderstatus")


@query("k02_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("k03_top_members", f"""
    WITH s AS (SELECT o_custkey, SUM({PRICE}) AS v FROM orders GROUP BY 1), top AS (SELECT o_custkey FROM s QUALIFY rank() OVER (ORDER BY v DESC) <= 3)
    SELECT o_custkey, o_orderstatus, COUNT(*) AS n_orders, CAST(SUM({PRICE}) AS DOUBLE) AS total FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top) GROUP BY ALL""")
def _(t):
    rows = N.rows_of_top_members(t.orders, "o_custkey", F.sum(C.money("o_totalprice")), 3)
    return rows.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"), F.sum(C.money("o_totalprice")).alias("total"))


@query("k04_top_one", f"""
    SELECT o_custkey, CAST(SUM({PRICE}) AS DOUBLE) AS total FROM orders GROUP BY 1 ORDER BY SUM({PRICE}) DESC, o_custkey LIMIT 1""")
def _(t):
    return N.top_one(t.orders, "o_custkey", F.sum(C.money("o_totalprice")))


@query("k05_sort_label", "SELECT DISTINCT CASE "
       + " ".join(f"WHEN o_totalprice < {e} THEN '{n}'" for e, n in zip(BAND_EDGES, BAND_LABELS)) + f" ELSE '{BAND_LABELS[-1]}' END AS band, CASE "
       + " ".join(f"WHEN o_totalprice < {e} THEN {i + 1}" for i, e in enumerate(BAND_EDGES)) + f" ELSE {len(BAND_LABELS)} END AS sort_key FROM orders ORDER BY 2")
def _(t):
    label, position = C.band("o_totalprice", BAND_EDGES, BAND_LABELS)
    return t.orders.select(label.alias("band"), position.alias("sort_key")).distinct().orderBy("sort_key")


@query("k06_row_sample", f"SELECT o_orderkey FROM orders WHERE {hash_sql('concat(' + chr(39) + 's1|' + chr(39) + ', CAST(o_orderkey AS VARCHAR))')} < {int(0.1 * 2**32)}")
def _(t):
    return N.sample_percent(t.orders, 10, ["o_orderkey"], salt="s1").select("o_orderkey")


@query("k07_block_sample")
def _(t):
    # Several files, so that there are blocks to choose from.
    path = scratch_dir(t.spark, "blocks")
    t.lineitem.repartition(file_count(t.spark, 16), F.xxhash64(*t.lineitem.columns)).write.parquet(path)
    # Written part files carry a random id; their part number repeats.
    part = F.regexp_extract(F.col("_metadata.file_path"), "part-([0-9]+)", 1)
    sample = N.sample_blocks(t.spark.read.parquet(path), 25, F.concat(part, F.lit(":"), F.col("_metadata.file_block_start").cast("string")))
    return sample.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


@query("k07_partition_sample", f"""
    SELECT l_returnflag, COUNT(*) AS n_rows FROM lineitem WHERE {hash_sql("concat('s2|', CAST(l_partkey % 64 AS VARCHAR))")} < {int(0.25 * 2**32)} GROUP BY l_returnflag""")
def _(t):
    path = scratch_dir(t.spark, "partitions")
    rows = t.lineitem.select("l_returnflag", (F.col("l_partkey") % 64).alias("block"))
    rows.repartition("block").write.partitionBy("block").parquet(path)
    sample = N.sample_partitions(t.spark.read.parquet(path), "block", 25, salt="s2")
    return sample.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


@query("k08_sample_per_group", """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem)
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY md5(concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR), '-', CAST(l_partkey AS VARCHAR)))) <= 5""")
def _(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey").distinct()
    order = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")]))
    return first_n_by_key(rows, ["l_suppkey"], [order], 5)


@query("k09_sequence_ids", "SELECT o_orderkey, 1000 + (row_number() OVER (ORDER BY o_orderkey) - 1) * 10 AS seq_id FROM orders")
def _(t):
    return N.sequence_ids(t.orders.select("o_orderkey"), ["o_orderkey"], start=1000, increment=10, name="seq_id")


@query("u01_union_all", """
    SELECT c_custkey AS member_id, c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""")
def _(t):
    buyers = t.customer.select(F.col("c_custkey").alias("member_id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    sellers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("member_id"))
    return buyers.unionByName(sellers)


@query("u02_union_distinct", """
    SELECT l_orderkey AS orderkey FROM lineitem UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey")).distinct()
    done = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("orderkey"))
    return lines.union(done).distinct()


@query("u03_set_difference", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem ORDER BY 1")
def _(t):
    return t.orders.select("o_orderkey").subtract(t.lineitem.select("l_orderkey").distinct()).orderBy("o_orderkey")


@query("u04_distinct_dimension", "SELECT DISTINCT l_returnflag, l_linestatus, year(l_shipdate) AS yr FROM lineitem")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("yr")).distinct()


@query("u05_unpivot", """
    WITH w AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price, NULLIF(p_retailprice - 900, 0) AS over_base FROM part)
    SELECT p_partkey, attribute, value FROM w UNPIVOT (value FOR attribute IN (size, price, over_base))""")
def _(t):
    wide = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"),
                         F.nullif(F.col("p_retailprice") - 900, F.lit(0.0)).alias("over_base"))
    return wide.unpivot("p_partkey", ["size", "price", "over_base"], "attribute", "value").filter(F.col("value").isNotNull())


@query("u06_pivot", "SELECT o_orderpriority, " + ", ".join(
    f"CAST(SUM({PRICE}) FILTER (year(o_orderdate) = {y}) AS DOUBLE) AS \"{y}\"" for y in range(1995, 2002)) + " FROM orders GROUP BY o_orderpriority")
def _(t):
    rows = t.orders.select("o_orderpriority", F.year("o_orderdate").alias("yr"), C.money("o_totalprice").alias("price"))
    return rows.groupBy("o_orderpriority").pivot("yr", list(range(1995, 2002))).agg(F.sum("price"))


@query("u07_inverse_rate_unpivot", """
    WITH fx AS (SELECT CAST(o_orderdate AS DATE) AS d, CAST(COUNT(*) AS DOUBLE) AS usd, 1 / CAST(COUNT(*) AS DOUBLE) AS cad FROM orders GROUP BY 1),
    l AS (SELECT d, 'USD' AS currency, usd AS fx FROM fx UNION ALL SELECT d, 'CAD', cad FROM fx)
    SELECT CAST(d AS VARCHAR) AS day, currency, fx, concat(strftime(d, '%Y-%m-%d'), currency) AS currency_id FROM l""")
def _(t):
    rates = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("USD"))
    wide = rates.withColumn("CAD", F.lit(1.0) / F.col("USD"))
    return wide.unpivot("day", ["USD", "CAD"], "currency", "fx").withColumn(
        "currency_id", F.concat(F.col("day").cast("string"), F.col("currency")))
