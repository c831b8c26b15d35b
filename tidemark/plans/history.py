"""Incremental load, change data and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import changes as X
from tidemark.operators import incremental as I
from tidemark.operators import snapshots as H
from tidemark.operators.buckets import BucketedFolder
from tidemark.operators.governance import access_defaults, registry_upsert
from tidemark.operators.measures import latest_day
from tidemark.operators.skew import split_join
from tidemark.plans.columns import DATA_DDL, OPERATION_SQL, operation
from tidemark.plans.registry import query
from tidemark.session import file_count, scratch_dir

DELTA = "2001-01-01"


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def change_feed(t):
    """Events as a change feed that went through JSON envelopes."""
    meta = F.struct(F.lit("shop").alias("schema-name"), F.lit("account").alias("table-name"), operation().alias("operation"))
    data = F.struct(F.col("user_id").cast("string").alias("ID"), F.col("event_type").alias("NAME"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("CREATED_ON"), F.col("value").alias("AMOUNT"))
    wrapped = t.events.select("event_id", F.to_json(F.struct(meta.alias("metadata"), data.alias("data"))).alias("data_str"))
    accepted, _ = X.split_null_payload(X.route(wrapped, "shop", "account", DATA_DDL))
    return accepted.select(
        C.try_cast("data.ID", "bigint").alias("user_id"), F.col("data.NAME").alias("name"), F.col("data.AMOUNT").alias("amount"),
        C.to_timestamp_or_null("data.CREATED_ON").alias("created_on"), "event_id", "operation")


@query("m01_apply_changes", f"""
    WITH l AS (SELECT user_id, event_type AS name, value AS amount, ts AS created_on, event_id, {OPERATION_SQL} AS op FROM events
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, name, amount, CAST(created_on AS VARCHAR) AS created_on FROM l WHERE op <> 'delete'""")
def _(t):
    return X.apply_changes(change_feed(t), ["user_id"], ["created_on", "event_id"], F.col("operation") == "delete",
                           except_cols=["operation", "event_id"])


@query("m02_merge_upsert", """
    WITH target AS (SELECT o_custkey AS k, MIN(o_orderkey) AS v, 'old' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
    batch AS (SELECT o_custkey AS k, o_orderkey AS v, 'new' AS origin FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'
              QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT k, v, origin FROM batch UNION ALL SELECT k, v, origin FROM target WHERE k NOT IN (SELECT k FROM batch)""")
def _(t):
    old = t.orders.filter(F.col("o_orderdate") < ts("1998-01-01")).groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderkey").alias("v"))
    rows = t.orders.filter(F.col("o_orderdate") >= ts("2001-06-01"))
    batch = rows.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.lit("new").alias("origin"), "o_orderdate")
    target = old.select("k", "v", F.lit("old").alias("origin"), F.lit(None).cast("timestamp_ntz").alias("o_orderdate"))
    return X.merge_upsert(target, batch, ["k"], [F.col("o_orderdate").desc(), F.col("v").desc()]).drop("o_orderdate")


@query("m03_append_newer", f"""
    WITH target AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F')
    SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT MAX(o_orderdate) FROM target WHERE o_orderdate < TIMESTAMP '{DELTA}')""")
def _(t):
    target = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < ts(DELTA)))
    return X.append_newer(target, t.orders, "o_orderdate").select("o_orderkey")


def order_report(t, keys=None):
    """Per order: totals, first and last ship date, line count, customer balance flag."""
    orders, lines = t.orders, t.lineitem
    if keys is not None:
        orders = orders.join(keys, "o_orderkey", "left_semi")
        lines = split_join(lines, keys.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"], "left_semi")
    sums = lines.groupBy("l_orderkey").agg(
        F.sum(C.money("l_extendedprice")).cast("double").alias("line_total"), F.count(F.lit(1)).alias("n_lines"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    joined = orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("o_orderkey", "o_orderstatus", "c_mktsegment", "line_total", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                         "first_ship", "last_ship")


@query("m04_affected_key_recompute", f"""
    WITH s AS (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS line_total, COUNT(*) AS n_lines, MIN(l_shipdate) AS a, MAX(l_shipdate) AS b FROM lineitem GROUP BY 1)
    SELECT o_orderkey, o_orderstatus, c_mktsegment, line_total, COALESCE(n_lines, 0) AS n_lines, CAST(a AS VARCHAR) AS first_ship, CAST(b AS VARCHAR) AS last_ship
    FROM orders LEFT JOIN s ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey""")
def _(t):
    # The stored result misses all changes since the delta time; recomputing only the touched
    # orders must give the full result.
    touched = I.affected_keys(
        [(t.orders, F.col("o_orderkey"), F.col("o_orderdate") >= ts(DELTA)),
         (t.lineitem, F.col("l_orderkey"), F.col("l_shipdate") >= ts(DELTA)),
         (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), F.col("o_orderkey"), F.col("c_acctbal") < 0)],
        "o_orderkey")
    full = order_report(t)
    late = F.col("last_ship") >= ts(DELTA)
    stale = full.withColumn("line_total", F.when(late, F.lit(None)).otherwise(F.col("line_total")))
    return I.recompute_affected(stale, touched, "o_orderkey", lambda keys: order_report(t, keys))


@query("m05_retention_delete", f"""
    WITH a AS (SELECT MAX(o_orderdate) AS d FROM orders) SELECT o_orderkey FROM orders, a
    WHERE NOT (o_orderstatus = 'F' AND o_orderdate < d - INTERVAL 90 DAY)""")
def _(t):
    expired = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.date_sub(latest_day(t.orders, "o_orderdate"), 90))
    return I.retain(t.orders, expired).select("o_orderkey")


@query("m06_schema_policy", """
    SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def _(t):
    target = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    incoming = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return I.align_schema(target, incoming, "append_new_columns")


# Two versions of the customer table: the second drops negative balances, moves large ones and adds suppliers.
def first_version(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                             ts("2024-01-01").alias("changed_on"))


def second_version(t):
    moved = F.col("c_acctbal") > 8000
    kept = t.customer.filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(moved, F.lit("PREMIUM")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(moved, ts("2024-02-01")).otherwise(ts("2024-01-01")).alias("changed_on"))
    added = t.supplier.select((F.col("s_suppkey") + 1_000_000_000_000).alias("id"), F.col("s_name").alias("name"),
                              F.lit("SUPPLIER").alias("segment"), ts("2024-02-01").alias("changed_on"))
    return kept.unionByName(added)


V2_SQL = """v1 AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS bal FROM customer),
    v2 AS (SELECT id, name, CASE WHEN bal > 8000 THEN 'PREMIUM' ELSE segment END AS segment FROM v1 WHERE bal >= 0
           UNION ALL SELECT s_suppkey + 1000000000000, s_name, 'SUPPLIER' FROM supplier)"""
SNAPSHOT_SQL = f"""WITH {V2_SQL}, h AS (
    SELECT id, name, segment, '2024-01-01 00:00:00' AS valid_from, CASE WHEN bal < 0 THEN '2024-03-01 00:00:00' WHEN bal > 8000 THEN '2024-0{{n}}-01 00:00:00' END AS valid_to FROM v1
    UNION ALL SELECT id, name, segment, '2024-0{{n}}-01 00:00:00', NULL FROM v2 WHERE segment IN ('PREMIUM', 'SUPPLIER'))
    SELECT id, name, segment, valid_from, valid_to, md5(concat(CAST(id AS VARCHAR), '|', valid_from)) AS scd_id FROM h"""


def timestamp_history(t):
    start = H.initial_snapshot(first_version(t), ["id"], F.col("changed_on"))
    return H.snapshot_by_timestamp(start, second_version(t), ["id"], "changed_on", ts("2024-03-01"))


def stored_history(t, label, states, **by):
    """A history on disk after one run for each (state of the source, time of the run)."""
    table = H.HistoryTable(t.spark, scratch_dir(t.spark, label), states[0][0].schema, ["id"], **by)
    for state, at in states:
        table.run(state, ts(at))
    return table.rows().select("id", "name", "segment", "valid_from", "valid_to", "scd_id")


@query("m07_snapshot_timestamp", SNAPSHOT_SQL.replace("{n}", "2"))
def _(t):
    return stored_history(t, "m07", [(first_version(t), "2024-01-01"), (second_version(t), "2024-03-01")], at="changed_on")


# The third version is the first again: suppliers go, dropped customers return, moved ones move back.
def third_version(t):
    again = (F.col("c_acctbal") < 0) | (F.col("c_acctbal") > 8000)
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                             F.when(again, ts("2024-04-01")).otherwise(ts("2024-01-01")).alias("changed_on"))


@query("m07_snapshot_three_runs", f"""WITH {V2_SQL}, h AS (
    SELECT id, name, segment, '2024-01-01 00:00:00' AS valid_from, CASE WHEN bal < 0 THEN '2024-03-01 00:00:00' WHEN bal > 8000 THEN '2024-02-01 00:00:00' END AS valid_to FROM v1
    UNION ALL SELECT id, name, segment, '2024-02-01 00:00:00', CASE segment WHEN 'PREMIUM' THEN '2024-04-01 00:00:00' ELSE '2024-05-01 00:00:00' END FROM v2 WHERE segment IN ('PREMIUM', 'SUPPLIER')
    UNION ALL SELECT id, name, segment, '2024-04-01 00:00:00', NULL FROM v1 WHERE bal < 0 OR bal > 8000)
    SELECT id, name, segment, valid_from, valid_to, md5(concat(CAST(id AS VARCHAR), '|', valid_from)) AS scd_id FROM h""")
def _(t):
    states = [(first_version(t), "2024-01-01"), (second_version(t), "2024-03-01"), (third_version(t), "2024-05-01")]
    return stored_history(t, "m07-three", states, at="changed_on")


@query("m08_snapshot_check", SNAPSHOT_SQL.replace("{n}", "3"))
def _(t):
    states = [(first_version(t).drop("changed_on"), "2024-01-01"), (second_version(t).drop("changed_on"), "2024-03-01")]
    return stored_history(t, "m08", states, check=["name", "segment"])


@query("m09_load_log_purge", """
    WITH l AS (SELECT 'shop' AS project, 'prod' AS environment, o_orderpriority AS table_name, MAX(o_orderdate) AS updated_at FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)),
    all_rows AS (SELECT * FROM l UNION ALL SELECT 'shop', 'prod', event_type, MAX(ts) FROM events GROUP BY event_type)
    SELECT project, environment, table_name, CAST(updated_at AS VARCHAR) AS updated_at FROM all_rows WHERE date_trunc('month', updated_at) = DATE '2001-07-01'""")
def _(t):
    log = t.orders.groupBy(F.col("o_orderpriority").alias("table_name"), F.to_date("o_orderdate").alias("d")).agg(
        F.max("o_orderdate").alias("updated_at")).select(F.lit("shop").alias("project"), F.lit("prod").alias("environment"), "table_name", "updated_at")
    run = t.events.groupBy(F.col("event_type").alias("table_name")).agg(F.max("ts").alias("updated_at")).select(
        F.lit("shop").alias("project"), F.lit("prod").alias("environment"), "table_name", "updated_at")
    return I.purge_log(I.log_run(log, run), F.lit("2001-07-03").cast("date"))


@query("m10_change_stream", f"""
    WITH {V2_SQL}, j AS (SELECT v1.id AS i1, v1.name AS n1, v1.segment AS s1, v2.id AS i2, v2.name AS n2, v2.segment AS s2 FROM v1 FULL JOIN v2 ON v1.id = v2.id
        WHERE v1.id IS NULL OR v2.id IS NULL OR v1.segment <> v2.segment)
    SELECT i1 AS id, n1 AS name, s1 AS segment, 'DELETE' AS action, i2 IS NOT NULL AS is_update FROM j WHERE i1 IS NOT NULL
    UNION ALL SELECT i2, n2, s2, 'INSERT', i1 IS NOT NULL FROM j WHERE i2 IS NOT NULL""")
def _(t):
    return X.change_stream(first_version(t).drop("changed_on"), second_version(t).drop("changed_on"), ["id"])


@query("m11_high_water_mark", """
    SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'run 1' ELSE 'run 2' END AS run FROM events""")
def _(t):
    # Two runs share the stored mark; together they extract every event once.
    mark = I.HighWaterMark(t.spark, scratch_dir(t.spark, "mark"))
    parts = []
    for run, end in (("run 1", "2024-01-15 00:00:00"), ("run 2", "2100-01-01 00:00:00")):
        start = mark.current("1970-01-01 00:00:00")
        window = I.window_extract(t.events, "ts", ts(start), ts(end)).select("event_id", F.lit(run).alias("run"))
        path = scratch_dir(t.spark, "window")
        # The mark moves only when the window is safely written; a failed write leaves it for the next run.
        window.write.parquet(path)
        mark.publish(end)
        parts.append(t.spark.read.schema(window.schema).parquet(path))
    return parts[0].unionByName(parts[1])


@query("m12_as_of_read", f"""
    WITH {V2_SQL}
    SELECT 'february' AS moment, id, name, segment FROM v1 WHERE bal <= 8000 OR bal IS NULL
    UNION ALL SELECT 'february', id, name, segment FROM v2 WHERE segment IN ('PREMIUM', 'SUPPLIER')
    UNION ALL SELECT 'march', id, name, segment FROM v2 UNION ALL SELECT 'january', id, name, segment FROM v1""")
def _(t):
    path = scratch_dir(t.spark, "history")
    timestamp_history(t).write.parquet(path)
    history = t.spark.read.parquet(path)
    parts = [H.as_of(history, ts(at)).select(F.lit(name).alias("moment"), "id", "name", "segment")
             for name, at in (("january", "2024-01-15"), ("february", "2024-02-15"), ("march", "2024-03-15"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("m13_clone_as_of", f"WITH {V2_SQL} SELECT id, name, segment FROM v1")
def _(t):
    path = scratch_dir(t.spark, "clone")
    H.as_of(timestamp_history(t), ts("2024-01-15")).select("id", "name", "segment").write.parquet(path)
    return t.spark.read.parquet(path)


@query("m14_first_wins_insert", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return X.insert_first_wins(None, rows, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey")]).drop("l_shipdate")


@query("m15_mass_update", """
    SELECT s_suppkey, 'moved' AS s_name, CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END AS s_acctbal FROM supplier""")
def _(t):
    updated = t.supplier.withColumn("s_name", F.lit("moved")).withColumn(
        "s_acctbal", F.when(F.col("s_acctbal") < 0, F.lit(0.0)).otherwise(F.col("s_acctbal")))
    return updated.select("s_suppkey", "s_name", "s_acctbal")


@query("m16_registry_upsert", """
    WITH cat AS (SELECT DISTINCT source AS s, lang AS t FROM documents),
    reg AS (SELECT DISTINCT concat('e', CAST(doc_id % 5 AS VARCHAR)) AS e, source AS s, lang AS t FROM documents WHERE lang = 'de'),
    req AS (SELECT DISTINCT concat('e', CAST(doc_id % 7 AS VARCHAR)) AS e, CASE WHEN doc_id % 11 = 0 THEN 'nowhere' ELSE source END AS s,
                   CASE WHEN doc_id % 13 = 0 THEN 'xx' ELSE lang END AS t, CASE WHEN doc_id % 7 >= 5 THEN 'SCHEMA' ELSE 'TABLE' END AS a FROM documents),
    judged AS (SELECT req.*, CASE WHEN s NOT IN (SELECT s FROM cat) THEN 'INVALID SCHEMA' WHEN a = 'TABLE' AND (s, t) NOT IN (SELECT (s, t) FROM cat) THEN 'INVALID TABLE'
               WHEN a = 'SCHEMA' AND (e, s) IN (SELECT (e, s) FROM reg) THEN 'TABLE ACCESS EXISTS' ELSE 'ACCEPTED' END AS status FROM req),
    fresh AS (SELECT e, s, t, a FROM judged WHERE status = 'ACCEPTED' AND a = 'TABLE'
              UNION SELECT j.e, j.s, cat.t, j.a FROM judged j JOIN cat ON j.s = cat.s WHERE j.status = 'ACCEPTED' AND j.a = 'SCHEMA')
    SELECT 'registry' AS part, e AS entity, s AS schema_name, t AS table_name, a AS access_type, NULL AS status FROM fresh
    UNION ALL SELECT 'registry', e, s, t, 'TABLE', NULL FROM reg WHERE (e, s, t) NOT IN (SELECT (e, s, t) FROM fresh)
    UNION ALL SELECT 'request', e, s, t, a, status FROM judged""")
def _(t):
    docs = t.documents.select("doc_id", "source", "lang")
    number = F.col("doc_id")
    catalog = docs.select(F.col("source").alias("schema_name"), F.col("lang").alias("table_name")).distinct()
    registry = docs.filter("lang = 'de'").select(
        F.concat(F.lit("e"), (number % 5).cast("string")).alias("entity"), F.col("source").alias("schema_name"),
        F.col("lang").alias("table_name"), F.lit("TABLE").alias("access_type")).distinct()
    requests = docs.select(
        F.concat(F.lit("e"), (number % 7).cast("string")).alias("entity"),
        F.when(number % 11 == 0, F.lit("nowhere")).otherwise(F.col("source")).alias("schema_name"),
        F.when(number % 13 == 0, F.lit("xx")).otherwise(F.col("lang")).alias("table_name"),
        F.when(number % 7 >= 5, F.lit("SCHEMA")).otherwise(F.lit("TABLE")).alias("access_type")).distinct()
    updated, judged = registry_upsert(registry, requests, catalog)
    return updated.select(F.lit("registry").alias("part"), "*", F.lit(None).cast("string").alias("status")).unionByName(
        judged.select(F.lit("request").alias("part"), "*"))


@query("m12_as_of_offset", f"""
    WITH {V2_SQL} SELECT 'hours back' AS moment, id, name, segment FROM v1
    UNION ALL SELECT 'minutes back', id, name, segment FROM v1 WHERE bal <= 8000 OR bal IS NULL
    UNION ALL SELECT 'minutes back', id, name, segment FROM v2 WHERE segment IN ('PREMIUM', 'SUPPLIER')""")
def _(t):
    path = scratch_dir(t.spark, "history")
    timestamp_history(t).write.parquet(path)
    history = t.spark.read.parquet(path)
    now = ts("2024-03-01 00:30:00")
    parts = [H.as_of_offset(history, now, back).select(F.lit(name).alias("moment"), "id", "name", "segment")
             for name, back in (("hours back", 30 * 24 * 3600), ("minutes back", 45 * 60))]
    return parts[0].unionByName(parts[1])


@query("m12_before_change", f"""
    WITH {V2_SQL}, moved AS (SELECT MIN(id) AS id FROM v2 WHERE segment = 'SUPPLIER')
    SELECT v1.id, name, segment FROM v1, moved WHERE moved.id IS NOT NULL""")
def _(t):
    path = scratch_dir(t.spark, "history")
    timestamp_history(t).write.parquet(path)
    history = t.spark.read.parquet(path)
    # The change that brought the first supplier, whose id is that of its version.
    change = history.filter("segment = 'SUPPLIER'").agg(F.min_by("scd_id", "id")).scalar()
    return H.before_change(history, ["id"], change).select("id", "name", "segment")


@query("m02_bucket_merge", """
    WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice + 1 AS price FROM orders WHERE o_orderkey % 5 = 0
               UNION ALL SELECT o_orderkey + 1000000000, 'N', 0 FROM orders WHERE o_orderkey % 50 = 0)
    SELECT o_orderkey, o_orderstatus, price FROM b
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    table = BucketedFolder(t.spark, scratch_dir(t.spark, "buckets"), ["o_orderkey"], file_count(t.spark))
    table.merge(rows, [F.col("price")])
    changed = rows.filter("o_orderkey % 5 = 0").withColumn("price", F.col("price") + 1)
    added = rows.filter("o_orderkey % 50 = 0").select((F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.lit(0.0).alias("price"))
    table.merge(changed.unionByName(added), [F.col("price")])
    return table.read()


@query("m16_access_defaults", """
    WITH r AS (SELECT doc_id, concat('e', CAST(doc_id % 7 AS VARCHAR)) AS entity, concat('raw_', lang, '_', source) AS source_database, lang AS source_schema, source AS source_table,
        CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'own' END AS db, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'public' END AS sch,
        CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'copy' END AS tbl, CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'analyst' END AS roles FROM documents)
    SELECT doc_id, CASE WHEN coalesce(db, '') = '' THEN concat(entity, '_', source_table) ELSE db END AS target_database, CASE WHEN coalesce(sch, '') = '' THEN source_schema ELSE sch END AS target_schema,
        coalesce(tbl, source_table) AS target_table, CASE WHEN coalesce(roles, '') = '' THEN 'reader' ELSE roles END AS access_roles FROM r""")
def _(t):
    def open_or(modulus, text):
        rest = F.col("doc_id") % modulus
        return F.when(rest == 1, F.lit("")).when(rest > 1, F.lit(text))

    requests = t.documents.select(
        "doc_id", F.concat(F.lit("e"), (F.col("doc_id") % 7).cast("string")).alias("entity"), F.concat(F.lit("raw_"), "lang", F.lit("_"), "source").alias("source_database"),
        F.col("lang").alias("source_schema"), F.col("source").alias("source_table"), open_or(3, "own").alias("target_database"),
        open_or(4, "public").alias("target_schema"), open_or(5, "copy").alias("target_table"), open_or(6, "analyst").alias("access_roles"))
    return access_defaults(requests, "reader").select("doc_id", "target_database", "target_schema", "target_table", "access_roles")
