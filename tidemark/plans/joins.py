"""Join queries (J01-J20). Catalyst and AQE choose broadcast or shuffle by measured size."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.lookups import default_key, filter_along, unique_lookup
from tidemark.operators.ordered import latest_by_key
from tidemark.operators.skew import split_join
from tidemark.plans.registry import query
from tidemark.sources.files import inline_table

NET = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def net():
    """Price less discount, exact: whole cents times whole percent."""
    units = C.cents("l_extendedprice") * (100 - C.cents("l_discount"))
    return units.cast("decimal(13,0)") * F.expr("0.0001bd")


@query("j01_star_join", f"""
    SELECT r_name, c_mktsegment, p_type, COUNT(*) AS n_lines, CAST(SUM({NET}) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def _(t):
    joined = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    return joined.groupBy("r_name", "c_mktsegment", "p_type").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(net()).alias("revenue"))


@query("j02_same_dimension_twice", f"""
    SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, CAST(SUM({NET}) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY ALL""")
def _(t):
    # Reduced to the two nation keys first, so the two role joins see few rows.
    flows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.sum(net()).alias("revenue"))
    )
    buyer = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"))
    seller = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    return flows.join(buyer, "c_nationkey").join(seller, "s_nationkey").select("customer_nation", "supplier_nation", "revenue")


@query("j03_computed_keys", """
    SELECT s.s_suppkey, COUNT(*) AS n_customers FROM supplier s
    JOIN customer c ON lower(split_part(c.c_name, '#', 2)) = lower(split_part(s.s_name, '#', 2))
      AND COALESCE(NULLIF(concat('k', CAST(c.c_custkey AS VARCHAR)), ''), '-1') = concat('k', CAST(s.s_suppkey AS VARCHAR)) GROUP BY s.s_suppkey""")
def _(t):
    def suffix(name):
        return F.lower(F.split_part(name, F.lit("#"), F.lit(2)))

    buyer_key = C.first_present(F.nullif(F.concat(F.lit("k"), F.col("c_custkey").cast("string")), F.lit("")), F.lit("-1"))
    seller_key = F.concat(F.lit("k"), F.col("s_suppkey").cast("string"))
    joined = t.supplier.join(t.customer, (suffix("c_name") == suffix("s_name")) & (buyer_key == seller_key))
    return joined.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n_customers"))


@query("j04_date_offset_join", """
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n_orders FROM orders GROUP BY 1),
    s AS (SELECT CAST(l_shipdate AS DATE) AS d, COUNT(*) AS n_lines FROM lineitem GROUP BY 1)
    SELECT CAST(o.d AS VARCHAR) AS order_day, n_orders, n_lines AS shipped_next_day FROM o LEFT JOIN s ON s.d = o.d + 1""")
def _(t):
    ordered = t.orders.groupBy(F.to_date("o_orderdate").alias("order_day")).agg(F.count(F.lit(1)).alias("n_orders"))
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("ship_day")).agg(F.count(F.lit(1)).alias("shipped_next_day"))
    return ordered.join(shipped, F.col("ship_day") == F.date_add("order_day", 1), "left").drop("ship_day")


@query("j05_outer_join_condition", """
    SELECT c_custkey, COUNT(o_orderkey) AS n_late FROM customer
    LEFT JOIN orders ON c_custkey = o_custkey AND o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'O' GROUP BY c_custkey""")
def _(t):
    # Orders are counted per buyer first: an outer join cannot split a hot key of its right side.
    recent = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    counts = t.orders.groupBy("o_custkey", "o_orderstatus", recent.alias("recent")).agg(F.count("o_orderkey").alias("n"))
    on = (F.col("c_custkey") == F.col("o_custkey")) & F.col("recent") & (F.col("o_orderstatus") == "O")
    return t.customer.join(counts, on, "left").groupBy("c_custkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_late"))


@query("j06_null_as_default_join", """
    WITH d AS (SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    r AS (SELECT 0 AS q, 'low or unknown' AS grade UNION ALL SELECT 1, 'high')
    SELECT d.doc_id, r.grade FROM d JOIN r ON COALESCE(d.quality, 0) = COALESCE(r.q, 0)""")
def _(t):
    docs = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    grades = inline_table(t.spark, [(None, "low or unknown"), (1, "high")], "q int, grade string")
    return docs.join(grades, default_key("quality", 0) == default_key("q", 0)).select("doc_id", "grade")


@query("j07_one_row_relation", """
    SELECT o_orderkey, o_totalprice - (SELECT CAST(AVG(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) FROM orders) > 0 AS above_mean FROM orders""")
def _(t):
    # A one-row relation is a scalar sub-query: no cross join is planned.
    mean = t.orders.agg(C.safe_ratio(F.sum(C.money("o_totalprice")), F.count("o_totalprice"))).scalar()
    return t.orders.select("o_orderkey", (F.col("o_totalprice") - mean > 0).alias("above_mean"))


@query("j08_right_outer", """
    SELECT n_name, COALESCE(s_name, 'No members') AS member FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey""")
def _(t):
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right")
    return joined.select("n_name", F.coalesce("s_name", F.lit("No members")).alias("member"))


@query("j09_semi_join", """
    SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(t):
    large = t.orders.filter("o_totalprice > 400000")
    return filter_along(t.customer, large, [("c_custkey", "o_custkey")], unique=False).select("c_custkey")


@query("j10_anti_join", """
    SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""")
def _(t):
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")


@query("j11_newest_header_self_join", """
    WITH ranked AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus FROM orders o JOIN ranked r ON o.o_orderkey = r.o_orderkey AND r.rn = 1""")
def _(t):
    newest = latest_by_key(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"],
                           [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return t.orders.join(newest.select("o_orderkey"), "o_orderkey", "left_semi").select("o_custkey", "o_orderkey", "o_orderstatus")


@query("j12_residual_or_null", """
    SELECT d.doc_id, l.quality, e.label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    LEFT JOIN embeddings e ON d.doc_id = e.vec_id WHERE l.quality = e.label OR l.quality IS NULL OR e.label IS NULL""")
def _(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left").join(
        t.embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "left")
    agree = (F.col("quality") == F.col("label")) | F.col("quality").isNull() | F.col("label").isNull()
    return joined.filter(agree).select("doc_id", "quality", "label")


@query("j13_unique_lookup", """
    WITH one AS (SELECT p_name, CASE WHEN COUNT(DISTINCT p_brand) = 1 THEN MIN(p_brand) END AS brand, COUNT(DISTINCT p_brand) AS n FROM part GROUP BY p_name)
    SELECT p.p_partkey, o.brand, o.n > 1 AS ambiguous FROM part p LEFT JOIN one o ON p.p_name = o.p_name""")
def _(t):
    lookup = unique_lookup(t.part, "p_name", "p_brand").withColumnRenamed("p_brand", "brand")
    return split_join(t.part.select("p_partkey", "p_name"), lookup, ["p_name"], "left").select("p_partkey", "brand", "ambiguous")


@query("j14_related_value", """
    SELECT l_returnflag, CAST(SUM(CAST(l_quantity AS DECIMAL(6,0)) * CAST(p_retailprice AS DECIMAL(10,2))) AS DOUBLE) AS cost
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag""")
def _(t):
    sold = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
    joined = sold.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    cost = F.col("qty").cast("decimal(18,0)") * F.col("p_retailprice").cast("decimal(10,2)")
    return joined.groupBy("l_returnflag").agg(F.sum(cost).alias("cost"))


@query("j15_nested_merge_expand", """
    SELECT c_custkey, c_name, n_name AS "nation.name", n_regionkey AS "nation.region" FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    nested = t.nation.select("n_nationkey", F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("nation"))
    merged = t.customer.join(nested, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return merged.select("c_custkey", "c_name", *[F.col(f"nation.{c}").alias(f"nation.{c}") for c in ("name", "region")])


@query("j16_using_join", "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels, on="doc_id")


@query("j17_filter_propagation", """
    WITH asia AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
    facts AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM asia)))
    SELECT c_mktsegment, COUNT(*) AS customers_seen, (SELECT COUNT(*) FROM facts) AS orders_seen FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM facts) GROUP BY c_mktsegment""")
def _(t):
    asia = filter_along(t.nation, t.region.filter("r_name = 'ASIA'"), [("n_regionkey", "r_regionkey")])
    buyers = filter_along(t.customer, asia, [("c_nationkey", "n_nationkey")])
    facts = filter_along(t.orders, buyers, [("o_custkey", "c_custkey")])
    seen = filter_along(t.customer, facts, [("c_custkey", "o_custkey")], unique=False)  # the edge back to the dimension
    total = facts.agg(F.count(F.lit(1))).scalar()
    return seen.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers_seen")).withColumn("orders_seen", total)


@query("j18_three_log_chain", """
    SELECT c_nationkey, COUNT(*) AS n_lines, COUNT(DISTINCT o_orderkey) AS n_orders
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_nationkey""")
def _(t):
    # Lines are counted per order before the chain, so only one row per order travels further.
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    chain = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return chain.groupBy("c_nationkey").agg(F.sum("n").alias("n_lines"), F.count("o_orderkey").alias("n_orders"))


@query("j19_role_privileges", """
    WITH grants AS (SELECT c_custkey, c_mktsegment AS role, c_nationkey, CASE WHEN c_acctbal < 0 THEN 'gone' END AS deleted_on FROM customer)
    SELECT n.n_name AS parent_role, g.role, COUNT(g.c_custkey) AS n_grants FROM nation n
    LEFT JOIN grants g ON g.c_nationkey = n.n_nationkey AND g.deleted_on IS NULL GROUP BY ALL""")
def _(t):
    grants = t.customer.select("c_custkey", F.col("c_mktsegment").alias("role"), "c_nationkey",
                               F.when(F.col("c_acctbal") < 0, F.lit("gone")).alias("deleted_on"))
    active = grants.filter("deleted_on IS NULL").groupBy("c_nationkey", "role").agg(F.count(F.lit(1)).alias("n"))
    joined = t.nation.join(active, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return joined.select(F.col("n_name").alias("parent_role"), "role", F.coalesce("n", F.lit(0)).alias("n_grants"))


@query("j20_dependency_listing", """
    SELECT DISTINCT concat('view_', CAST(c_nationkey AS VARCHAR)) AS view_name, concat('object_', CAST(l_suppkey AS VARCHAR)) AS object_name
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey""")
def _(t):
    uses = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    owners = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    pairs = owners.join(uses, F.col("o_orderkey") == F.col("l_orderkey")).select("c_nationkey", "l_suppkey").distinct()
    return pairs.select(F.concat(F.lit("view_"), F.col("c_nationkey").cast("string")).alias("view_name"),
                        F.concat(F.lit("object_"), F.col("l_suppkey").cast("string")).alias("object_name"))
