"""Parsing and projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.dates import quarter_of
from tidemark.operators.changes import parse_metadata, route, split_null_payload
from tidemark.plans.registry import query
from tidemark.sources.files import inline_table

# A change feed over events: error deletes the user, signup inserts, everything else updates.
OPERATION_SQL = "CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END"
TABLE_SQL = "CASE WHEN event_type IN ('signup', 'error') THEN 'account' ELSE 'activity' END"


def operation():
    return C.decode("event_type", {"error": "delete", "signup": "insert"}, "update")


def source_table():
    return F.when(F.col("event_type").isin("signup", "error"), F.lit("account")).otherwise(F.lit("activity"))


def envelopes(events):
    """JSON change envelopes; purchases of the account system come without a payload block."""
    meta = F.struct(
        F.lit("shop").alias("schema-name"), source_table().alias("table-name"), operation().alias("operation")
    )
    data = F.struct(
        F.col("user_id").cast("string").alias("ID"),
        F.col("event_type").alias("NAME"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("CREATED_ON"),
        F.col("value").alias("AMOUNT"),
    )
    body = F.struct(meta.alias("metadata"), F.when(F.col("event_type") != "purchase", data).alias("data"))
    return events.select("event_id", F.to_json(body).alias("data_str"))


DATA_DDL = "struct<ID:string,NAME:string,CREATED_ON:string,AMOUNT:double>"


@query("p01_parse_envelope", f"""
    SELECT event_id, 'shop' AS schema_name, {TABLE_SQL} AS table_name, {OPERATION_SQL} AS operation FROM events""")
def _(t):
    return parse_metadata(envelopes(t.events)).drop("data_str")


@query("p02_route_table", f"""
    SELECT event_id, CAST(user_id AS VARCHAR) AS id, event_type AS name, value AS amount, {OPERATION_SQL} AS operation
    FROM events WHERE {TABLE_SQL} = 'activity' AND event_type <> 'purchase'""")
def _(t):
    routed, _ = split_null_payload(route(envelopes(t.events), "shop", "activity", DATA_DDL))
    return routed.select("event_id", F.col("data.ID").alias("id"), F.col("data.NAME").alias("name"),
                         F.col("data.AMOUNT").alias("amount"), "operation")


@query("p03_reject_null_payload", f"""
    SELECT event_id, {OPERATION_SQL} AS operation FROM events WHERE event_type = 'purchase'""")
def _(t):
    _, rejected = split_null_payload(route(envelopes(t.events), "shop", "activity", DATA_DDL))
    return rejected.select("event_id", "operation")


@query("p04_json_path_cast", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           TRY_CAST(json_extract_string(props, '$.missing') AS DOUBLE) AS missing FROM events""")
def _(t):
    return t.events.select("event_id", *C.json_fields("props", {"k": ("$.k", "bigint"), "missing": ("$.missing", "double")}))


@query("p05_json_path_filter", """
    SELECT event_type, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_users FROM events
    WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50 GROUP BY event_type""")
def _(t):
    return (
        t.events.filter(C.json_field("props", "$.k", "bigint") >= 50)
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"))
    )


@query("p06_blank_to_null_date", """
    WITH raw AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS txt FROM orders)
    SELECT o_orderkey, CAST(CAST(NULLIF(TRIM(txt), '') AS DATE) AS VARCHAR) AS order_day,
           CAST(CAST(NULLIF(TRIM(txt), '') AS TIMESTAMP) AS VARCHAR) AS order_ts FROM raw""")
def _(t):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    raw = t.orders.select("o_orderkey", text.alias("txt"))
    return raw.select("o_orderkey", C.to_date_or_null("txt").alias("order_day"), C.to_timestamp_or_null("txt").alias("order_ts"))


@query("p07_audit_timestamp", """
    SELECT event_id, CAST(ts AS VARCHAR) AS created_on, CAST(NULL AS VARCHAR) AS bad FROM events""")
def _(t):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = t.events.select("event_id", text.alias("txt"), F.concat(F.lit("not a time "), text).alias("junk"))
    return raw.select("event_id", C.to_timestamp_or_null("txt").alias("created_on"), C.to_timestamp_or_null("junk").alias("bad"))


@query("p08_staging_rename", """
    SELECT s_suppkey AS host_id, s_name AS host_name, s_nationkey AS country_id FROM supplier""")
def _(t):
    return t.supplier.select(F.col("s_suppkey").alias("host_id"), F.col("s_name").alias("host_name"),
                             F.col("s_nationkey").alias("country_id"))


@query("p09_default_for_null", """
    SELECT d.doc_id, COALESCE(CAST(l.quality AS VARCHAR), 'Unknown') AS quality_text, COALESCE(l.quality, -1) AS quality_key
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.select("doc_id", C.first_present(F.col("quality").cast("string"), F.lit("Unknown")).alias("quality_text"),
                         C.first_present("quality", F.lit(-1)).alias("quality_key"))


@query("p10_priority_chain", """
    WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' END AS a,
                      CASE WHEN o_totalprice > 200000 THEN 'large' END AS b, NULLIF(o_orderpriority, '5-LOW') AS c FROM orders)
    SELECT o_orderkey, COALESCE(a, b, c, 'none') AS status, CASE WHEN c IS NOT NULL THEN 'Y' ELSE 'N' END AS has_priority FROM s""")
def _(t):
    s = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit("finished")).alias("a"),
        F.when(F.col("o_totalprice") > 200000, F.lit("large")).alias("b"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("c"),
    )
    return s.select("o_orderkey", C.first_present("a", "b", "c", F.lit("none")).alias("status"),
                    F.nvl2("c", F.lit("Y"), F.lit("N")).alias("has_priority"))


@query("p11_value_repair", """
    SELECT p_partkey, CASE WHEN p_size - 1 = 0 THEN 1 ELSE p_size - 1 END AS minimum_nights FROM part""")
def _(t):
    nights = F.col("p_size") - 1
    return t.part.select("p_partkey", F.when(nights == 0, F.lit(1)).otherwise(nights).alias("minimum_nights"))


@query("p12_money_text", """
    SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price FROM part""")
def _(t):
    shown = t.part.select("p_partkey", F.concat(F.lit("$"), F.format_number("p_retailprice", 2)).alias("price"))
    return shown.select("p_partkey", C.money_text("price").alias("price"))


@query("p13_greatest_or_null", """
    SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL AND l.toxic IS NOT NULL THEN GREATEST(l.quality, l.toxic) END AS top_flag
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        "doc_id", C.greatest_or_null("quality", "toxic").alias("top_flag"))


@query("p14_status_flags", """
    SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS returned,
           CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'R' THEN 'Y' ELSE 'N' END AS billed, COUNT(*) AS n_rows
    FROM lineitem GROUP BY ALL""")
def _(t):
    flags = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n_rows"))
    return flags.select("*", C.yes_no(F.col("l_returnflag") == "R").alias("returned"),
                        C.yes_no((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R")).alias("billed"))


@query("p15_conditional_measures", """
    SELECT l.l_suppkey, CAST(SUM(CASE WHEN p.p_name NOT LIKE '%widget%' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS valid_qty,
           CAST(SUM(CASE WHEN p.p_name LIKE '%widget%' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS invalid_qty
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_suppkey""")
def _(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    qty, bad = F.col("l_quantity").cast("bigint"), F.col("p_name").like("%widget%")
    return rows.groupBy("l_suppkey").agg(
        F.sum(F.when(~bad, qty).otherwise(0)).alias("valid_qty"), F.sum(F.when(bad, qty).otherwise(0)).alias("invalid_qty"))


@query("p16_tenant_suffix", """
    SELECT c_custkey, CASE WHEN c_nationkey <> 0 THEN concat(c_name, '_', CAST(c_nationkey AS VARCHAR)) ELSE c_name END AS code FROM customer""")
def _(t):
    other = F.concat("c_name", F.lit("_"), F.col("c_nationkey").cast("string"))
    return t.customer.select("c_custkey", F.when(F.col("c_nationkey") != 0, other).otherwise(F.col("c_name")).alias("code"))


@query("p17_description_text", """
    SELECT c.conv_id, c.turn, concat('Turn ', CAST(c.turn AS VARCHAR), ' by ', COALESCE(c.role, 'Unassigned'), ': ',
           COALESCE(NULLIF(c.text, ''), 'no details')) AS details FROM conversations c""")
def _(t):
    return t.conversations.select(
        "conv_id", "turn",
        F.concat(F.lit("Turn "), F.col("turn").cast("string"), F.lit(" by "), C.first_present("role", F.lit("Unassigned")),
                 F.lit(": "), C.first_present(F.nullif(F.col("text"), F.lit("")), F.lit("no details"))).alias("details"))


# Zones of the programs, taken by nation key modulo three.
ZONES = ["Australia/Sydney", "Australia/Perth", "Pacific/Auckland"]


@query("p18_time_zone", """
    SELECT event_id, CAST(timezone('Australia/Melbourne', timezone('UTC', ts)) AS VARCHAR) AS fixed_local,
           CAST(timezone(list_extract(['Australia/Sydney', 'Australia/Perth', 'Pacific/Auckland'], user_id % 3 + 1), timezone('UTC', ts)) AS VARCHAR) AS program_local
    FROM events""")
def _(t):
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("user_id") % 3 + 1).cast("int"))
    return t.events.select("event_id", C.utc_to_zone("ts", "Australia/Melbourne").alias("fixed_local"),
                           C.utc_to_zone("ts", zone).alias("program_local"))


@query("p19_date_key", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", C.date_key("o_orderdate").alias("date_key"))


@query("p20_date_labels", """
    SELECT event_id, concat(strftime(ts, '%Y-%m-%d'), ' (', CAST(user_id AS VARCHAR), ')') AS period_label,
           strftime(ts, '%Y%m%d%H') AS hour_key FROM events""")
def _(t):
    label = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" ("), F.col("user_id").cast("string"), F.lit(")"))
    return t.events.select("event_id", label.alias("period_label"), C.hour_key("ts").alias("hour_key"))


@query("p21_surrogate_key", """
    SELECT d.doc_id, md5(concat(CAST(d.doc_id AS VARCHAR), '-', d.lang, '-',
           COALESCE(CAST(l.quality AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS doc_key
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return joined.select("doc_id", C.surrogate_key("doc_id", "lang", "quality").alias("doc_key"))


@query("p22_reserved_members", """
    SELECT CAST(n_nationkey AS BIGINT) + 1 AS program_id, n_name AS title FROM nation
    UNION ALL SELECT -1, 'Shared' UNION ALL SELECT 0, 'Internal'""")
def _(t):
    members = t.nation.select((F.col("n_nationkey").cast("bigint") + 1).alias("program_id"), F.col("n_name").alias("title"))
    reserved = inline_table(t.spark, [(-1, "Shared"), (0, "Internal")], "program_id bigint, title string")
    return members.unionByName(reserved)


@query("p23_fixed_point", """
    SELECT o_orderkey, CAST(CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS DECIMAL(16,2)) / 100 AS DOUBLE) AS amount FROM orders""")
def _(t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.select("o_orderkey", (cents.cast("decimal(16,2)") / 100).cast("decimal(16,2)").alias("amount"))


@query("p24_code_decode", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' ELSE 'Unknown' END AS status FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", C.decode("o_orderstatus", {"F": "Finished", "O": "Open", "P": "Partial"}, "Unknown").alias("status"))


BAND_EDGES = list(range(40_000, 400_000, 45_000))
BAND_LABELS = [f"below {BAND_EDGES[0]:,}", *[f"{a:,} to {b:,}" for a, b in zip(BAND_EDGES, BAND_EDGES[1:])], f"{BAND_EDGES[-1]:,} and above"]


@query("p25_banding", "SELECT band, band_order, COUNT(*) AS n_orders FROM (SELECT CASE "
       + " ".join(f"WHEN o_totalprice < {e} THEN '{n}'" for e, n in zip(BAND_EDGES, BAND_LABELS)) + f" ELSE '{BAND_LABELS[-1]}' END AS band, CASE "
       + " ".join(f"WHEN o_totalprice < {e} THEN {i + 1}" for i, e in enumerate(BAND_EDGES))
       + f" ELSE {len(BAND_LABELS)} END AS band_order FROM orders) GROUP BY band, band_order")
def _(t):
    label, position = C.band("o_totalprice", BAND_EDGES, BAND_LABELS)
    return t.orders.groupBy(label.alias("band"), position.alias("band_order")).agg(F.count(F.lit(1)).alias("n_orders"))


@query("p26_tier_product", """
    SELECT c_custkey, CASE WHEN COALESCE(c_acctbal, 0) < 2000 THEN 'Low' WHEN c_acctbal < 6000 THEN 'Medium' ELSE 'High' END AS income_range,
           CASE WHEN COALESCE(c_acctbal, 0) < 2000 THEN 'Shirt' WHEN c_acctbal < 6000 THEN 'Sweater' ELSE 'Bag' END AS product FROM customer""")
def _(t):
    tier, _ = C.band("c_acctbal", [2000, 6000], ["Low", "Medium", "High"], null_as_zero=True)
    product, _ = C.band("c_acctbal", [2000, 6000], ["Shirt", "Sweater", "Bag"], null_as_zero=True)
    return t.customer.select("c_custkey", tier.alias("income_range"), product.alias("product"))


@query("p27_linear_score", """
    SELECT c_custkey, CASE WHEN (c_acctbal + 512.5) / 0.25 < 0 THEN 0 ELSE (c_acctbal + 512.5) / CAST(0.25 AS DOUBLE) END AS predicted FROM customer""")
def _(t):
    # The intercept comes with its sign: a negative one is added back.
    return t.customer.select("c_custkey", C.linear_score("c_acctbal", -512.5, 0.25).alias("predicted"))


@query("p28_upper_snake", """
    SELECT doc_id, upper(trim(regexp_replace(regexp_replace(concat(source, 'DocName-', lang), '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '[^A-Za-z0-9]+', '_', 'g'), '_')) AS COLUMN_NAME
    FROM documents""")
def _(t):
    named = t.documents.select("doc_id", F.concat("source", F.lit("DocName-"), "lang").alias("columnName"))
    shaped = named.select("doc_id", C.upper_snake_col("columnName").alias("columnName"))
    return shaped.toDF("doc_id", C.upper_snake("columnName"))


@query("p29_text_split", """
    SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(split_part(url, '://', 2), '/', 1) AS host,
           substring(url, 1, 8) AS head, CASE WHEN contains(url, '?') THEN split_part(substring(url, instr(url, '?') + 1), '#', 1) END AS query_text,
           CASE WHEN contains(url, '//') AND contains(substring(url, instr(url, '//') + 2), '.')
                THEN split_part(substring(url, instr(url, '//') + 2), '.', 1) END AS first_label,
           trim(concat('  ', split_part(url, '/', 4), ' ')) AS section FROM pages""")
def _(t):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        C.first_token(url, "://").alias("scheme"),
        F.split_part(F.split_part(url, F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)).alias("host"),
        F.substring(url, 1, 8).alias("head"),
        F.substring_index(C.after(url, "?"), "#", 1).alias("query_text"),
        C.between_marks(url, "//", ".").alias("first_label"),
        F.trim(F.concat(F.lit("  "), F.split_part(url, F.lit("/"), F.lit(4)), F.lit(" "))).alias("section"),
    )


@query("p30_ordinal_date", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day FROM orders""")
def _(t):
    day = F.dayofmonth("o_orderdate")
    suffix = (F.when(day.isin(1, 21, 31), F.lit("st")).when(day.isin(2, 22), F.lit("nd"))
              .when(day.isin(3, 23), F.lit("rd")).otherwise(F.lit("th")))
    text = F.concat(day.cast("string"), suffix, F.date_format("o_orderdate", " MMMM, yyyy"))
    return t.orders.select("o_orderkey", text.alias("txt")).select("o_orderkey", C.ordinal_date("txt").alias("order_day"))


@query("p31_literal_replace", "SELECT p_partkey, replace(p_brand, 'Brand#', 'B-') AS brand FROM part")
def _(t):
    return t.part.select("p_partkey", F.replace("p_brand", F.lit("Brand#"), F.lit("B-")).alias("brand"))


@query("p32_skip_blank_rows", """
    WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, COUNT(*) AS n_lines FROM lines WHERE trim(line) <> '' GROUP BY doc_id ORDER BY doc_id OFFSET 3""")
def _(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    filled = lines.filter(F.trim("line") != "").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))
    # Only the three skipped keys meet in one task; the rest stays spread. The ids are unique and not null.
    skipped = filled.select("doc_id").orderBy("doc_id").limit(3)
    return filled.join(skipped, "doc_id", "left_anti")


@query("p33_last_token", """
    SELECT page_id, split_part(url, '/', -1) AS last_part, split_part(url, '/', 3) AS host_part, split_part(url, '/', 1) AS first_part FROM pages""")
def _(t):
    return t.pages.select("page_id", C.last_token("url", "/").alias("last_part"),
                          F.split_part("url", F.lit("/"), F.lit(3)).alias("host_part"), C.first_token("url", "/").alias("first_part"))


@query("p34_metric_text", """
    WITH s AS (SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total, COUNT(*) AS n,
                      COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1)
    SELECT o_orderstatus, concat('$', format('{:,.2f}', total / 1e6), 'M') AS sales, format('{:,}', n) AS orders,
           format('{:,.2f}', total / n) AS per_order, concat(format('{:,.2f}', CAST(urgent AS DOUBLE) / n * 100), '%') AS urgent_share FROM s""")
def _(t):
    total = F.sum(C.money("o_totalprice")).cast("double")
    n = F.count(F.lit(1))
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    one = t.orders.groupBy("o_orderstatus").agg(total.alias("total"), n.alias("n"), urgent.alias("urgent"))
    return one.select("o_orderstatus", C.metric_text("total", "millions").alias("sales"), C.metric_text("n", "units").alias("orders"),
                      C.metric_text(F.col("total") / F.col("n"), "price").alias("per_order"),
                      C.metric_text(F.col("urgent") / F.col("n"), "percent").alias("urgent_share"))


@query("p35_unit_conversion", """
    SELECT source, CAST(SUM(octet_length(encode(text))) AS DOUBLE) / 1048576 AS megabytes,
           CAST(SUM(octet_length(encode(text))) AS DOUBLE) / 1073741824 AS gigabytes,
           CAST(SUM(n_chars) AS DOUBLE) / 3600000 AS hours FROM documents GROUP BY source""")
def _(t):
    size = F.sum(F.octet_length("text")).cast("double")
    return t.documents.groupBy("source").agg((size / 1048576).alias("megabytes"), (size / 1073741824).alias("gigabytes"),
                                             (F.sum("n_chars").cast("double") / 3600000).alias("hours"))


@query("p36_payload_bytes", """
    SELECT doc_id, octet_length(encode(text)) AS text_bytes, octet_length(encode(text)) AS hex_bytes FROM documents""")
def _(t):
    return t.documents.select("doc_id", C.payload_bytes("text").alias("text_bytes"),
                              C.payload_bytes(F.hex(F.col("text")), "hex").alias("hex_bytes"))


@query("p37_sign_colour", """
    WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 0 ELSE c_acctbal - 5000 END AS change FROM customer)
    SELECT c_custkey, CASE WHEN change > 0 THEN '#107C10' WHEN change = 0 THEN '#605E5C' ELSE '#C50F1F' END AS colour FROM d""")
def _(t):
    # Every tenth customer has no change on record, every tenth none at all.
    digit = F.col("c_custkey") % 10
    change = F.when(digit == 1, F.lit(0.0)).when(digit != 0, F.col("c_acctbal") - 5000)
    return t.customer.select("c_custkey", C.sign_colour(change).alias("colour"))


@query("p38_date_parts", """
    SELECT o_orderkey, year(o_orderdate) AS yr, month(o_orderdate) AS mon, day(o_orderdate) AS dom, quarter(o_orderdate) AS qtr,
           concat(CAST(year(o_orderdate) AS VARCHAR), '-Q', CAST(quarter(o_orderdate) AS VARCHAR)) AS quarter_label,
           year(o_orderdate) * 10 + quarter(o_orderdate) AS quarter_sort, strftime(o_orderdate, '%b %Y') AS month_label FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    q = quarter_of(F.month(d))
    return t.orders.select(
        "o_orderkey", F.year(d).alias("yr"), F.month(d).alias("mon"), F.dayofmonth(d).alias("dom"), q.alias("qtr"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), q.cast("string")).alias("quarter_label"),
        (F.year(d) * 10 + q).alias("quarter_sort"), F.date_format(d, "MMM yyyy").alias("month_label"))


@query("p39_lineage_columns", """
    SELECT s_suppkey, '2024-02-01 00:00:00' AS load_time, 'supplier' AS source_table FROM supplier""")
def _(t):
    return t.supplier.select("s_suppkey", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("load_time"),
                             F.lit("supplier").alias("source_table"))


@query("p40_drop_keep_reorder", "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer")
def _(t):
    return t.customer.drop("c_name", "c_nationkey").select("c_mktsegment", "c_custkey", "c_acctbal")
