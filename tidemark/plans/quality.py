"""Data check queries (Q01-Q13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import gates as G
from tidemark.operators import quality as Q
from tidemark.operators.incremental import StateFolder
from tidemark.plans.registry import query
from tidemark.session import TABLE_SCHEMAS, scratch_dir


@query("q01_unique", "SELECT text, COUNT(*) AS n_rows FROM documents GROUP BY text HAVING COUNT(*) > 1")
def _(t):
    return Q.not_unique(t.documents, "text")


@query("q02_not_null", """
    SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL""")
def _(t):
    return Q.not_null(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), "quality").select("doc_id")


@query("q03_accepted_values", """
    SELECT event_type, COUNT(*) AS n_rows FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type""")
def _(t):
    return Q.unaccepted_values(t.events, "event_type", ["view", "click", "purchase"])


@query("q04_relationships", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def _(t):
    return Q.orphans(t.documents, "doc_id", t.embeddings, "vec_id").select("doc_id")


@query("q05_positive_value", "SELECT p_partkey, p_size - 1 AS nights FROM part WHERE p_size - 1 < 1")
def _(t):
    return Q.not_positive(t.part.select("p_partkey", (F.col("p_size") - 1).alias("nights")), "nights")


@query("q06_no_nulls", """
    SELECT d.doc_id, l.quality, e.label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN embeddings e ON d.doc_id = e.vec_id
    WHERE l.quality IS NULL OR e.label IS NULL""")
def _(t):
    joined = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left").join(
        t.embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "left")
    return Q.any_null(joined)


@query("q07_freshness", """
    SELECT CAST(MAX(ts) AS VARCHAR) AS newest, CAST(date_diff('microsecond', MAX(ts), TIMESTAMP '2024-01-31 06:00:00') AS DOUBLE) / 3.6e9 AS age_hours,
           CASE WHEN date_diff('microsecond', MAX(ts), TIMESTAMP '2024-01-31 06:00:00') / 3.6e9 > 24 THEN 'error'
                WHEN date_diff('microsecond', MAX(ts), TIMESTAMP '2024-01-31 06:00:00') / 3.6e9 > 1 THEN 'warn' ELSE 'pass' END AS status FROM events""")
def _(t):
    return Q.freshness(t.events, "ts", F.lit("2024-01-31 06:00:00"), warn_hours=1, error_hours=24)


@query("q08_child_before_parent", """
    SELECT o_orderkey, COUNT(*) AS n_early FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate GROUP BY o_orderkey""")
def _(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.filter("l_shipdate < o_orderdate").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_early"))


@query("q09_value_rule_limit", "SELECT p_partkey, p_size FROM part WHERE p_size < 2 ORDER BY p_partkey LIMIT 10")
def _(t):
    return t.part.filter("p_size < 2").select("p_partkey", "p_size").orderBy("p_partkey").limit(10)


def event_rules():
    return [
        Q.RowRule("not_null", "user_id", F.col("user_id").isNull()),
        Q.RowRule("accepted_values", "event_type", ~F.col("event_type").isin("view", "click", "purchase", "signup"), "warn"),
        Q.RowRule("positive_value", "value", F.col("value") < 1, "warn"),
        Q.RowRule("json", "props", C.json_field("props", "$.k", "bigint").isNull()),
    ]


@query("q10_severity_summary", """
    WITH s AS (SELECT 'not_null' AS "check", 'user_id' AS "column", COUNT(*) FILTER (user_id IS NULL) AS failures, 'error' AS severity FROM events
    UNION ALL SELECT 'accepted_values', 'event_type', COUNT(*) FILTER (event_type = 'error'), 'warn' FROM events
    UNION ALL SELECT 'positive_value', 'value', COUNT(*) FILTER (value < 1), 'warn' FROM events
    UNION ALL SELECT 'json', 'props', COUNT(*) FILTER (json_extract_string(props, '$.k') IS NULL), 'error' FROM events)
    SELECT *, failures = 0 AS passed FROM s""")
def _(t):
    return Q.summarise(t.events, event_rules())


@query("q10_publish_gate", """
    WITH n AS (SELECT date_diff('microsecond', MAX(ts), TIMESTAMP '2024-03-01') / 3.6e9 AS hours FROM events),
    s AS (SELECT 'not_null' AS "check", 'user_id' AS "column", COUNT(*) FILTER (user_id IS NULL) AS failures, 'error' AS severity FROM events
    UNION ALL SELECT 'accepted_values', 'event_type', COUNT(*) FILTER (event_type = 'error'), 'warn' FROM events
    UNION ALL SELECT 'positive_value', 'value', COUNT(*) FILTER (value < 1), 'warn' FROM events
    UNION ALL SELECT 'json', 'props', COUNT(*) FILTER (json_extract_string(props, '$.k') IS NULL), 'error' FROM events
    UNION ALL SELECT 'unique', 'event_id', COUNT(*), 'error' FROM (SELECT event_id FROM events WHERE event_id IS NOT NULL GROUP BY event_id HAVING COUNT(*) > 1)
    UNION ALL SELECT 'unique', 'user_id', COUNT(*), 'warn' FROM (SELECT user_id FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING COUNT(*) > 1)
    UNION ALL SELECT 'relationships', 'user_id', COUNT(*), 'warn' FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
    UNION ALL SELECT 'freshness', 'ts', CASE WHEN hours IS NULL OR hours > 12 THEN 1 ELSE 0 END, CASE WHEN hours IS NULL OR hours > 10000 THEN 'error' ELSE 'warn' END FROM n)
    SELECT *, failures = 0 AS passed, NOT EXISTS (SELECT 1 FROM s WHERE failures > 0 AND severity = 'error') AS published FROM s""")
def _(t):
    checks = [G.unique("event_id"), G.unique("user_id", "warn"), G.relationship("user_id", t.customer, "c_custkey", "warn"),
              G.fresh("ts", F.lit("2024-03-01").cast("timestamp_ntz"), 12, 10_000)]
    return G.publish_checked(StateFolder(t.spark, scratch_dir(t.spark, "checked")), t.events, 1, event_rules(), checks)


@query("q11_refresh_completeness", """
    WITH loaded AS (SELECT user_id, MAX(ts) AS loaded_at FROM events WHERE event_type = 'purchase' GROUP BY user_id), u AS (SELECT DISTINCT user_id FROM events)
    SELECT COUNT(*) AS expected, COUNT(*) FILTER (loaded_at >= (SELECT MAX(ts) FROM events) - INTERVAL 24 HOUR) AS refreshed,
           COUNT(*) = COUNT(*) FILTER (loaded_at >= (SELECT MAX(ts) FROM events) - INTERVAL 24 HOUR) AS complete FROM u LEFT JOIN loaded USING (user_id)""")
def _(t):
    newest = t.events.agg(F.max("ts")).scalar()
    loaded = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("loaded_at"))
    expected = t.events.select("user_id").distinct()
    fresh = F.coalesce(F.col("loaded_at") >= newest - F.expr("interval 24 hours"), F.lit(False))
    report = expected.join(loaded, "user_id", "left").agg(F.count(F.lit(1)).alias("expected"), F.count_if(fresh).alias("refreshed"))
    return report.withColumn("complete", F.col("expected") == F.col("refreshed"))


# The detector patterns in RE2 syntax, which has no look-around.
RE2_DETECTORS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9]{1,3}[ -]?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}",
    "card": r"(?:^|[^0-9])[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}(?:[^0-9]|$)",
    "ip_address": r"(?:^|[^0-9])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?:[^0-9]|$)",
    "national_id": r"(?:^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?:[^0-9]|$)",
}
# Every text column of every given table.
SCAN_COLUMNS = {
    name: found for name, ddl in TABLE_SCHEMAS.items()
    if (found := [field.split()[0] for field in ddl.split(", ") if field.split()[1] == "string"])
}


@query("q12_personal_data_scan", " UNION ALL ".join(
    f"SELECT '{o}' AS object, '{c}' AS \"column\", '{d}' AS detector, COUNT(*) FILTER (regexp_matches({c}, '{p}')) AS hits, COUNT(*) AS n_rows FROM {o}"
    for o, columns in SCAN_COLUMNS.items() for c in columns for d, p in RE2_DETECTORS.items()))
def _(t):
    return Q.scan_personal_data({o: getattr(t, o) for o in SCAN_COLUMNS})


@query("q13_null_layout_key", """
    SELECT COUNT(*) FILTER (l.quality IS NULL) AS null_keys, COUNT(*) AS n_rows FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.agg(F.count_if(F.col("quality").isNull()).alias("null_keys"), F.count(F.lit(1)).alias("n_rows"))
