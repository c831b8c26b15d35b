"""Source, sink and loader queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import dates as D
from tidemark.operators.governance import union_all
from tidemark.plans.ranking import hash_sql
from tidemark.plans.registry import query
from tidemark.session import file_count, scratch_dir
from tidemark.sources import files as S
from tidemark.sources import generators as G
from tidemark.sources import reports as R
from tidemark.streaming import streams as ST

EVENT_DDL = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz"
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "ts"]
NTZ = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def event_json(t):
    return t.events.select("event_id", F.to_date("ts").cast("string").alias("day"), F.to_json(F.struct(*EVENT_COLUMNS), NTZ).alias("value"))


@query("s01_land_json", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS n_rows, COUNT(*) AS n_numbered, CAST(SUM(event_id) AS BIGINT) AS id_sum, '2024-02-01 00:00:00' AS landed_at FROM events GROUP BY 1""")
def _(t):
    path = scratch_dir(t.spark, "landing")
    event_json(t).repartitionByRange("day", "event_id").select("day", "value").write.partitionBy("day").text(path)
    landed = S.land_json(t.spark, path, "2024-02-01 00:00:00", glob="part-*")
    per_file = landed.groupBy("file_name", "landed_at").agg(
        F.count(F.lit(1)).alias("n"), F.max("row_number").alias("last"), F.sum(C.json_field("payload", "$.event_id", "bigint")).alias("ids"))
    # The last row number of a file is its row count when the numbering is dense.
    return per_file.groupBy(C.between_marks("file_name", "day=", "/").alias("day"), "landed_at").agg(
        F.sum("n").alias("n_rows"), F.sum("last").alias("n_numbered"), F.sum("ids").alias("id_sum"))


@query("s02_skip_bad_files", "SELECT COUNT(*) AS n_total, 1 AS bad_files, 1 AS bad_records FROM events")
def _(t):
    path = scratch_dir(t.spark, "bad")
    newest = t.events.agg(F.max("event_id")).scalar()
    broken = F.when(F.col("event_id") == newest, F.substring("value", 1, 20)).otherwise(F.col("value"))
    event_json(t).select(broken.alias("value")).repartition(file_count(t.spark)).write.text(path)
    clean, bad = S.read_skipping_bad_files(t.spark, path, EVENT_DDL)
    raw = t.spark.read.text(path).select(F.col("_metadata.file_path").alias("file_name"))
    dropped = raw.join(bad.select("file_name"), "file_name", "left_semi").agg(F.count(F.lit(1))).scalar()
    report = bad.agg(F.count(F.lit(1)).alias("bad_files"), F.sum("bad_records").alias("bad_records"))
    return report.withColumn("n_total", clean.agg(F.count(F.lit(1))).scalar() + dropped)


@query("s03_continuous_files", """
    SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS run FROM events""")
def _(t):
    base = scratch_dir(t.spark, "drops")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for run, part in ((1, t.events.filter(early)), (2, t.events.filter(~early))):
        part.select(F.to_json(F.struct(*EVENT_COLUMNS), NTZ).alias("value")).write.mode("append").text(f"{base}/in/drop{run}")
        part.select("event_id").write.json(f"{base}/in/other{run}")  # the name pattern leaves these out
        stream = ST.stream_files(t.spark, f"{base}/in", EVENT_DDL, fmt="json", glob="*.txt")
        ST.run_available(stream.select("event_id", F.lit(run).alias("run")), f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.schema("event_id bigint, run int").parquet(f"{base}/out")


@query("s04_json_array", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    path = scratch_dir(t.spark, "arrays")
    # Documents of at most 500 consecutive ids, so no document grows with the table.
    item = F.struct(*EVENT_COLUMNS)
    documents = t.events.groupBy(C.whole_part("event_id", 500)).agg(F.to_json(F.collect_list(item), NTZ).alias("value"))
    documents.select("value").write.text(path)
    return S.read_json_array(t.spark, path, EVENT_DDL).select("event_id", "user_id", "event_type")


@query("s05_delimited_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = scratch_dir(t.spark, "tsv")
    t.customer.write.csv(path, sep="\t", header=True, encoding="ISO-8859-1")
    ddl = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return S.read_delimited(t.spark, path, ddl, sep="\t", header_rows=1, encoding="ISO-8859-1")


@query("s06_whole_files", "SELECT CAST(SUM(strlen(props) + 1) AS BIGINT) AS n_bytes, COUNT(*) AS n_lines FROM events")
def _(t):
    path = scratch_dir(t.spark, "whole")
    t.events.select(F.col("props").alias("value")).write.option("maxRecordsPerFile", 50_000).text(path)
    whole = S.read_whole_files(t.spark, path)
    return whole.agg(F.sum(F.octet_length("content")).alias("n_bytes"),
                     F.sum(F.length("content") - F.length(F.replace("content", F.lit("\n"), F.lit("")))).alias("n_lines"))


@query("s07_gzip_lines", "SELECT event_type, COUNT(*) AS n_rows FROM events GROUP BY event_type")
def _(t):
    path = scratch_dir(t.spark, "gzip")
    event_json(t).select("value").write.option("compression", "gzip").text(path)
    lines = S.read_gzip_lines(t.spark, path, partitions=file_count(t.spark))
    return lines.groupBy(C.json_field("value", "$.event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("s08_labelled_folder", """
    SELECT strftime(o_orderdate, '%Y-%m') AS label, COUNT(*) AS n_orders, CAST(SUM(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""")
def _(t):
    path = scratch_dir(t.spark, "months")
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("batch"))
    rows.repartitionByRange("batch", "o_orderkey").write.partitionBy("batch").parquet(path)
    combined = S.read_labelled_folder(t.spark, path, "o_orderkey bigint", left="batch=", right="/")
    return combined.groupBy("label").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_orderkey").alias("key_sum"))


# The priority list of the report.
PRIORITIES = [("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",), ("4-NOT SPECIFIED",), ("5-LOW",)]


@query("s09_inline_table", """
    WITH p AS (SELECT * FROM (VALUES ('1-URGENT', 0), ('2-HIGH', 1), ('3-MEDIUM', 2), ('4-NOT SPECIFIED', 3), ('5-LOW', 4)) AS p(priority, row_index))
    SELECT priority, row_index, COUNT(*) AS n_orders FROM p JOIN orders ON priority = o_orderpriority GROUP BY ALL""")
def _(t):
    listed = S.inline_table(t.spark, PRIORITIES, "priority string", index="row_index")
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    return listed.join(counts, F.col("priority") == F.col("o_orderpriority")).drop("o_orderpriority")


@query("s10_seed_table", """
    WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
    moon AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 29 DAY)) AS DATE) AS d FROM b)
    SELECT CASE WHEN d IS NULL THEN 'not full moon' ELSE 'full moon' END AS moon, COUNT(*) AS n_orders FROM orders LEFT JOIN moon ON CAST(o_orderdate AS DATE) = d + 1 GROUP BY 1""")
def _(t):
    path = scratch_dir(t.spark, "seed")
    day = F.to_date("o_orderdate")
    D.days_between(t.orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi")), "lo", "hi", "full_moon_date", step_days=29).write.csv(path, header=True)
    seed = S.read_delimited(t.spark, path, "full_moon_date date", header_rows=1)
    joined = t.orders.join(seed, day == F.date_add("full_moon_date", 1), "left")
    label = F.when(F.col("full_moon_date").isNull(), F.lit("not full moon")).otherwise(F.lit("full moon"))
    return joined.groupBy(label.alias("moon")).agg(F.count(F.lit(1)).alias("n_orders"))


@query("s11_create_table_as", "SELECT c_nationkey, COUNT(*) AS n_customers FROM customer GROUP BY c_nationkey")
def _(t):
    path = scratch_dir(t.spark, "ctas")
    t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers")).write.parquet(path)
    return t.spark.read.schema("c_nationkey int, n_customers bigint").parquet(path)


@query("s12_full_refresh", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    path = scratch_dir(t.spark, "refresh")
    S.full_refresh(t.supplier.withColumn("s_name", F.lit("stale")), path)
    return S.full_refresh(t.supplier, path)


def event_records(t, path):
    """Events as message-stream records in a few files."""
    records = ST.to_records(t.events, "clicks", F.to_json(F.struct(*EVENT_COLUMNS), NTZ), F.col("user_id"), F.col("event_id"), F.col("ts"))
    records.repartition(file_count(t.spark)).write.parquet(path)
    return ST.stream_files(t.spark, path, ST.RECORD_DDL)


@query("s13_stream_start_position", """
    SELECT 'earliest' AS position, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_keys FROM events
    UNION ALL SELECT '2024-01-20 00:00:00', COUNT(*), COUNT(DISTINCT user_id) FROM events WHERE ts >= TIMESTAMP '2024-01-20'""")
def _(t):
    base = scratch_dir(t.spark, "position")
    stream = event_records(t, f"{base}/in")
    parts = []
    for i, position in enumerate(("earliest", "2024-01-20 00:00:00")):
        rows = ST.bronze(ST.start_position(stream, position)).select("partitionKey", "data_str")
        ST.run_available(rows, f"{base}/out{i}", f"{base}/checkpoint{i}")
        read = t.spark.read.schema("partitionKey string, data_str string").parquet(f"{base}/out{i}")
        parts.append(read.agg(F.lit(position).alias("position"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("partitionKey").alias("n_keys")))
    return union_all(parts)


@query("s14_stream_pass_through", """
    SELECT event_type AS ticker, concat('{"event_id":', CAST(event_id AS VARCHAR), ',"event_time":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '","ticker":"', event_type, '"}') AS value FROM events""")
def _(t):
    base = scratch_dir(t.spark, "pass")
    t.events.select("event_id", F.col("ts").alias("event_time"), F.col("event_type").alias("ticker")).repartition(file_count(t.spark)).write.parquet(f"{base}/in")
    stream = ST.stream_files(t.spark, f"{base}/in", "event_id bigint, event_time timestamp_ntz, ticker string")
    ST.run_available(ST.json_pass_through(stream, ["event_id", "event_time", "ticker"], "ticker"), f"{base}/out", f"{base}/checkpoint",
                     fmt="text", partition_by=["ticker"])
    return t.spark.read.schema("value string, ticker string").text(f"{base}/out").select("ticker", "value")


@query("s15_tick_generator", f"""
    SELECT event_id AS tick_id, CAST(TIMESTAMP '2024-01-01' + to_seconds(event_id) AS VARCHAR) AS event_time,
           list_extract({G.TICKERS}, {hash_sql("concat('ticker|', CAST(event_id AS VARCHAR))")} % 5 + 1) AS ticker,
           CAST({hash_sql("concat('price|', CAST(event_id AS VARCHAR))")} % 10000 AS DOUBLE) / 100 AS price FROM events""")
def _(t):
    return G.ticks(t.events.select("event_id"), "event_id", "2024-01-01")


def _uniform_sql(column, salt, low, high):
    return f"({low} + {hash_sql(f'concat({chr(39)}{salt}|{chr(39)}, CAST({column} AS VARCHAR))')} % {high - low + 1})"


@query("s16_fact_generator", f"""
    SELECT o_orderkey AS fact_id, CAST(DATE '2023-01-01' + CAST({_uniform_sql('o_orderkey', 'day', 0, 364)} AS INTEGER) AS VARCHAR) AS order_date,
           CASE {_uniform_sql('o_orderkey', 'range', 0, 1)} WHEN 0 THEN {_uniform_sql('o_orderkey', 'customer', 1, 1000)} ELSE {_uniform_sql('o_orderkey', 'customer', 5001, 6500)} END AS customer_id,
           {_uniform_sql('o_orderkey', 'quantity', 1, 100)} AS quantity, CAST({_uniform_sql('o_orderkey', 'amount', 1000, 500000)} AS DOUBLE) / 100 AS amount FROM orders""")
def _(t):
    return G.facts(t.orders.select("o_orderkey"), "o_orderkey", "2023-01-01", 365, [(1, 1000), (5001, 6500)])


@query("s17_daily_generator", f"""
    WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
    e AS (SELECT d, unnest(generate_series(0, {hash_sql("concat('extra|', d)")} % 6)) AS n FROM d)
    SELECT d AS entry_date, n AS entry_no, CAST({hash_sql("concat('amount|', d, '|', CAST(n AS VARCHAR))")} % 100000 AS DOUBLE) / 100 AS amount FROM e""")
def _(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return G.daily_entries(days, "day")


@query("s18_latest_modified_file", "SELECT 'P' AS folder, COUNT(*) AS n_rows FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    base = scratch_dir(t.spark, "newest")
    folders = [f"{base}/status={s}" for s in ("F", "O", "P")]
    for folder in folders:
        t.orders.filter(F.col("o_orderstatus") == folder[-1]).select("o_orderkey").write.parquet(folder)
    newest = S.latest_modified_file(t.spark, folders).select(C.between_marks("path", "status=", "/").alias("folder"))
    counts = t.spark.read.parquet(base).groupBy(F.col("status").alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))
    return newest.join(counts, "folder")


@query("s19_chunk_items", """
    WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents),
    c AS (SELECT doc_id, words, unnest(generate_series(0, (len(words) - 1) // 100)) AS chunk FROM w)
    SELECT doc_id, chunk, len(words[chunk * 100 + 1 : chunk * 100 + 100]) AS n_items, md5(array_to_string(words[chunk * 100 + 1 : chunk * 100 + 100], ' ')) AS digest FROM c""")
def _(t):
    chunks = S.chunk_items(t.documents.select("doc_id", F.split("text", " ").alias("words")), "words", 100)
    return chunks.select("doc_id", "chunk", F.size("items").alias("n_items"), F.md5(F.array_join("items", " ")).alias("digest"))


@query("s20_merge_json", """
    SELECT o_orderstatus, COUNT(*) AS n_orders, CAST(SUM(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY o_orderstatus""")
def _(t):
    base = scratch_dir(t.spark, "merge")
    open_ = F.col("o_orderstatus") == "O"
    t.orders.filter(open_).select("o_orderkey", "o_orderstatus").write.json(f"{base}/a")
    t.orders.filter(~open_).select("o_orderkey", "o_orderstatus").write.json(f"{base}/b")
    merged = S.merge_json(t.spark, [f"{base}/a", f"{base}/b"], "o_orderkey bigint, o_orderstatus string")
    return merged.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_orderkey").alias("key_sum"))


@query("s21_nested_normalise", """
    WITH c AS (SELECT c_custkey // 1000 AS doc, c_name AS name, c_mktsegment AS unit FROM customer)
    SELECT c.doc, c.name, c.unit, h.head FROM c JOIN (SELECT doc, unit, MIN(name) AS head FROM c GROUP BY ALL) h ON c.doc = h.doc AND c.unit = h.unit""")
def _(t):
    # One nested document per block of 1000 customer numbers: documents stay small.
    rows = t.customer.select(C.whole_part("c_custkey", 1000).alias("doc"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("unit"))
    heads = rows.groupBy("doc", "unit").agg(F.min("name").alias("head"))
    people = rows.groupBy("doc").agg(F.collect_list(F.struct("name", "unit")).alias("employees"))
    units = heads.groupBy("doc").agg(F.collect_list(F.struct("unit", "head")).alias("departments"))
    documents = people.join(units, "doc").select("doc", F.to_json(F.struct("employees", "departments")).alias("payload"))
    ddl = "employees array<struct<name:string,unit:string>>, departments array<struct<unit:string,head:string>>"
    parsed = documents.select("doc", F.from_json("payload", ddl).alias("d"))
    return S.head_lookup(parsed, F.col("d.employees"), F.col("d.departments"), ["doc"]).select("doc", "name", "unit", "head")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query("s22_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {n}" for n in TABLES))
def _(t):
    return R.row_counts({n: getattr(t, n) for n in TABLES})


@query("s23_non_empty_views", " UNION ALL ".join(
    f"SELECT '{n}' AS view_name, CASE WHEN COUNT(*) > 0 THEN 'filled' ELSE 'empty' END AS status, false AS has_message FROM {n}" for n in TABLES)
    + " UNION ALL SELECT 'no_such_table', 'error', true")
def _(t):
    views = {n: (lambda n=n: getattr(t, n)) for n in [*TABLES, "no_such_table"]}
    return R.non_empty_report(t.spark, views).select("view_name", "status", F.col("message").isNotNull().alias("has_message"))


@query("s24_request_validation", """
    WITH cat AS (SELECT DISTINCT source AS s, lang AS t FROM documents JOIN labels USING (doc_id) WHERE toxic = 0), req AS (SELECT DISTINCT source AS s, CASE WHEN n_chars < 200 THEN NULL ELSE lang END AS t FROM documents
        UNION SELECT DISTINCT concat('x', source), lang FROM documents)
    SELECT s AS schema_name, t AS table_name, CASE WHEN s NOT IN (SELECT s FROM cat) THEN 'INVALID SCHEMA'
           WHEN t IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cat WHERE cat.s = req.s AND cat.t = req.t) THEN 'INVALID TABLE' ELSE 'VALID' END AS status FROM req""")
def _(t):
    clean = t.documents.join(t.labels.filter("toxic = 0"), "doc_id", "left_semi")
    catalog = clean.select(F.col("source").alias("schema_name"), F.col("lang").alias("table_name"))
    asked = t.documents.select(F.col("source").alias("schema_name"), F.when(F.col("n_chars") >= 200, F.col("lang")).alias("table_name"))
    unknown = t.documents.select(F.concat(F.lit("x"), "source").alias("schema_name"), F.col("lang").alias("table_name"))
    return R.validate_requests(asked.union(unknown).distinct(), catalog)
