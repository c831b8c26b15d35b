"""Governance, sharing and layout queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import governance as G
from tidemark.plans.registry import query
from tidemark.session import file_count, scratch_dir

# Control rows of the shared customer views (view, columns, tenants, extra filter).
CONTROL = [
    ("partner_a", ["c_custkey", "c_mktsegment"], [1, 2, 3], "c_acctbal > 0"),
    ("partner_b", ["c_custkey"], None, "c_mktsegment <> 'MACHINERY'"),
    ("auditor", None, [7], None),
]


@query("g01_entitlement_views", """
    SELECT 'partner_a' AS view_name, c_custkey, c_mktsegment FROM customer WHERE (c_nationkey IN (1, 2, 3) OR c_nationkey IS NULL) AND c_acctbal > 0
    UNION ALL SELECT 'partner_b', c_custkey, NULL FROM customer WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL SELECT 'auditor', c_custkey, c_mktsegment FROM customer WHERE c_nationkey IN (7) OR c_nationkey IS NULL""")
def _(t):
    views = []
    for name, columns, tenants, extra in CONTROL:
        shared = G.entitled_view(t.customer, columns, "c_nationkey", tenants, extra)
        if "c_mktsegment" not in shared.columns:
            shared = shared.withColumn("c_mktsegment", F.lit(None).cast("string"))
        views.append(shared.select(F.lit(name).alias("view_name"), "c_custkey", "c_mktsegment"))
    return G.union_all(views)


@query("g02_scope_resolution", """
    SELECT DISTINCT c_mktsegment AS user_name, concat('db_', CAST(c_nationkey AS VARCHAR)) AS source_database, c_name AS source_table FROM customer
    WHERE upper(concat('db_', CAST(c_nationkey AS VARCHAR))) IN ('DB_1', 'DB_5')""")
def _(t):
    control = t.customer.select(F.col("c_mktsegment").alias("user_name"), F.concat(F.lit("db_"), F.col("c_nationkey").cast("string")).alias("source_database"),
                                F.col("c_name").alias("source_table"))
    return G.resolve_scope(control, {"user_name": "*", "source_database": ["db_1", "DB_5"], "source_table": "*"})


@query("g03_role_masking", """
    SELECT c_custkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN c_name ELSE concat(repeat('X', length(c_name) - 4), right(c_name, 4)) END AS account,
           repeat('X', length(CAST(c_nationkey AS VARCHAR))) AS short_value FROM customer""")
def _(t):
    return t.customer.select("c_custkey", C.role_mask("c_name", F.col("c_mktsegment"), ["MACHINERY", "HOUSEHOLD"]).alias("account"),
                             C.mask_keep_last(F.col("c_nationkey").cast("string")).alias("short_value"))


@query("g04_usage_report", """
    SELECT user_id, event_type, COUNT(*) AS n_queries, CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DOUBLE) AS total, CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DOUBLE) / COUNT(*) AS mean,
           COUNT(*) FILTER (value > 100) AS n_spilled FROM events GROUP BY ALL HAVING COUNT(*) FILTER (value > 100) > 2""")
def _(t):
    value = F.col("value").cast("decimal(10,2)")
    usage = t.events.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n_queries"), F.sum(value).alias("total"), C.safe_ratio(F.sum(value), F.count(F.lit(1))).alias("mean"),
        F.count_if(F.col("value") > 100).alias("n_spilled"))
    return usage.filter("n_spilled > 2")


@query("g05_active_object_storage", """
    SELECT source, lang, COUNT(*) AS n_rows, CAST(SUM(strlen(text)) AS DOUBLE) / 1073741824 AS gigabytes FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY ALL""")
def _(t):
    active = t.documents.join(t.labels.filter("toxic = 1"), "doc_id", "left_anti")
    return active.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_rows"),
                                                (F.sum(F.octet_length("text")).cast("double") / 1073741824).alias("gigabytes"))


@query("g06_layout_overlap", """
    WITH r AS (SELECT concat(CAST(l_suppkey AS VARCHAR), '-', CAST(year(l_shipdate) AS VARCHAR)) AS file, MIN(l_shipdate) AS low, MAX(l_shipdate) AS high FROM lineitem GROUP BY 1)
    SELECT a.file, COUNT(*) - 1 AS overlaps, COUNT(*) FILTER (b.low <= a.low AND b.high >= a.low) AS depth, MAX(a.low) = MAX(a.high) AS is_constant
    FROM r a JOIN r b ON a.low <= b.high AND b.low <= a.high GROUP BY a.file""")
def _(t):
    name = F.concat_ws("-", F.col("l_suppkey").cast("string"), F.year("l_shipdate").cast("string"))
    ranges = t.lineitem.groupBy(name.alias("file")).agg(F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high"))
    return G.range_overlap(ranges).select("file", "overlaps", "depth", "is_constant")


@query("g07_clustered_rewrite", "SELECT COUNT(*) AS n_rows, true AS depth_falls FROM lineitem")
def _(t):
    plain, clustered = scratch_dir(t.spark, "plain"), scratch_dir(t.spark, "clustered")
    files = file_count(t.spark, 12)
    t.lineitem.repartition(files).write.parquet(plain)
    G.write_clustered(t.lineitem, clustered, [F.to_date("l_shipdate"), F.col("l_orderkey")], files=files)

    def layout(path, name):
        ranges = G.file_ranges(t.spark.read.parquet(path), "l_shipdate")
        return G.range_overlap(ranges).select(F.lit(name).alias("layout"), "overlaps", "depth", "n_rows")

    both = layout(plain, "plain").unionByName(layout(clustered, "clustered"))
    at = lambda name, c: F.when(F.col("layout") == name, F.col(c))
    falls = (F.max(at("clustered", "depth")) <= F.max(at("plain", "depth"))) & (F.sum(at("clustered", "overlaps")) < F.sum(at("plain", "overlaps")))
    return both.agg(F.sum(at("clustered", "n_rows")).alias("n_rows"), falls.alias("depth_falls"))


@query("g08_privilege_audit", """
    WITH tags AS (SELECT DISTINCT c_nationkey AS object_id, c_mktsegment AS tag FROM customer WHERE c_acctbal > 9000)
    SELECT n_name AS object_name, COALESCE(tag, 'UNTAGGED') AS tag, COUNT(s_suppkey) AS n_holders FROM nation LEFT JOIN tags ON n_nationkey = object_id
    LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL""")
def _(t):
    tags = t.customer.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("object_id"), F.col("c_mktsegment").alias("tag")).distinct()
    holders = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    joined = t.nation.join(tags, F.col("n_nationkey") == F.col("object_id"), "left").join(
        holders, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return joined.select(F.col("n_name").alias("object_name"), F.coalesce("tag", F.lit("UNTAGGED")).alias("tag"),
                         F.coalesce("n", F.lit(0)).alias("n_holders"))
