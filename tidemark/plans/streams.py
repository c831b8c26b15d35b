"""Streaming queries (R01-R08). Each runs what is available and returns the sink's rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import statistics as S
from tidemark.operators.changes import parse_metadata, route, split_null_payload
from tidemark.operators.feeds import ChangeFeed, append_changes
from tidemark.operators.incremental import StateFolder
from tidemark.plans.columns import DATA_DDL, OPERATION_SQL, TABLE_SQL, envelopes, operation
from tidemark.plans.loaders import event_records
from tidemark.plans.registry import query
from tidemark.session import file_count, scratch_dir
from tidemark.streaming import streams as ST
from tidemark.streaming.progress import ProgressLog, run_statistics


@query("r01_bronze_stream", """
    SELECT 'clicks' AS stream, CAST(user_id AS VARCHAR) AS partition_key, lpad(CAST(event_id AS VARCHAR), 20, '0') AS sequence_number, CAST(ts AS VARCHAR) AS arrival,
           event_id FROM events""")
def _(t):
    base = scratch_dir(t.spark, "bronze")
    ST.run_available(ST.bronze(event_records(t, f"{base}/in")), f"{base}/out", f"{base}/checkpoint")
    rows = t.spark.read.schema(f"{ST.RECORD_DDL}, data_str string").parquet(f"{base}/out")
    return rows.select("stream", F.col("partitionKey").alias("partition_key"), F.col("sequenceNumber").alias("sequence_number"),
                       F.col("approximateArrivalTimestamp").alias("arrival"), C.json_field("data_str", "$.event_id", "bigint").alias("event_id"))


@query("r02_silver_stream", f"""
    SELECT event_id, CAST(user_id AS VARCHAR) AS id, CAST(ts AS VARCHAR) AS created_on, {OPERATION_SQL} AS operation FROM events
    WHERE {TABLE_SQL} = 'activity' AND event_type <> 'purchase'""")
def _(t):
    base = scratch_dir(t.spark, "silver")
    envelopes(t.events).repartition(file_count(t.spark)).write.parquet(f"{base}/in")
    stream = ST.stream_files(t.spark, f"{base}/in", "event_id bigint, data_str string")
    accepted, _ = split_null_payload(route(stream, "shop", "activity", DATA_DDL))
    silver = accepted.select("event_id", F.col("data.ID").alias("id"), C.to_timestamp_or_null("data.CREATED_ON").alias("created_on"), "operation")
    ST.run_available(silver, f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.schema(silver.schema).parquet(f"{base}/out")


@query("r03_streaming_merge", f"""
    WITH l AS (SELECT user_id, event_type, event_id, {OPERATION_SQL} AS op FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, event_type, event_id FROM l WHERE op <> 'delete'""")
def _(t):
    base = scratch_dir(t.spark, "merge")
    feed = t.events.select("user_id", "event_type", "event_id", "ts", operation().alias("operation"))
    # Rows are dealt over the files by hash, so batches arrive out of order.
    files = file_count(t.spark)
    feed.repartition(files, F.xxhash64("event_id")).write.parquet(f"{base}/in")
    stream = ST.stream_files(t.spark, f"{base}/in", "user_id bigint, event_type string, event_id bigint, ts timestamp_ntz, operation string", files_per_batch=-(-files // 3))
    table = ST.MergedTable(t.spark, f"{base}/state", ["user_id"], ["ts", "event_id"], F.col("operation") == "delete")
    return ST.merge_stream(stream, table, f"{base}/checkpoint", compact_every=2).select("user_id", "event_type", "event_id")


@query("r04_stream_throughput", """
    SELECT CAST(date_trunc('minute', ts) AS VARCHAR) AS window_start, COUNT(*) AS n_rows, CAST(SUM(strlen(props)) AS BIGINT) AS n_bytes FROM events GROUP BY 1""")
def _(t):
    base = scratch_dir(t.spark, "throughput")
    # Dealt by hash: every batch reaches over the whole time.
    files = file_count(t.spark)
    t.events.select(F.col("ts").cast("timestamp").alias("ts"), "props").repartition(files, F.xxhash64("ts")).write.parquet(f"{base}/in")
    stream = ST.stream_files(t.spark, f"{base}/in", "ts timestamp, props string", files_per_batch=-(-files // 3))
    rows = ST.stream_throughput(stream, "ts", "props", f"{base}/sums", f"{base}/checkpoint")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_rows", "n_bytes")


@query("r05_layer_latency", """
    WITH l AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS ms FROM events)
    SELECT 'min' AS measure, CAST(MIN(ms) AS DOUBLE) AS value FROM l UNION ALL SELECT 'max', MAX(ms) FROM l UNION ALL SELECT 'avg', CAST(SUM(ms) AS DOUBLE) / COUNT(ms) FROM l""")
def _(t):
    base = scratch_dir(t.spark, "latency")
    delay = C.json_field("props", "$.k", "bigint")
    t.events.select(F.col("ts").alias("arrival"), F.timestamp_add("MILLISECOND", delay, "ts").alias("silver_at")).repartition(file_count(t.spark)).write.parquet(f"{base}/in")
    stream = ST.stream_files(t.spark, f"{base}/in", "arrival timestamp_ntz, silver_at timestamp_ntz")
    latency = stream.select(F.timestamp_diff("MILLISECOND", F.col("arrival"), F.col("silver_at")).alias("ms"))
    ST.run_available(latency, f"{base}/out", f"{base}/checkpoint")
    return S.labelled_extremes(t.spark.read.schema("ms bigint").parquet(f"{base}/out"), "ms")


@query("r06_progress_report", """
    SELECT 3 AS n_batches, COUNT(*) AS input_rows, true AS durations_known, true AS intervals_known FROM events""")
def _(t):
    base = scratch_dir(t.spark, "progress")
    files = file_count(t.spark, 6)
    envelopes(t.events).repartition(files).write.parquet(f"{base}/in")
    stream = ST.stream_files(t.spark, f"{base}/in", "event_id bigint, data_str string", files_per_batch=-(-files // 3))
    run = ST.run_available(parse_metadata(stream).select("event_id", "operation"), f"{base}/out", f"{base}/checkpoint")
    progress = ST.progress_rows(t.spark, run).filter("input_rows > 0")
    return progress.agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("input_rows").alias("input_rows"), (F.min("duration_ms") >= 0).alias("durations_known"),
        (F.avg("seconds_since_previous") >= 0).alias("intervals_known"))


@query("r07_keyed_pass_through", """
    SELECT CAST(user_id AS VARCHAR) AS partition_key, COUNT(*) AS n_rows, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1""")
def _(t):
    base = scratch_dir(t.spark, "keyed")
    keyed = event_records(t, f"{base}/in").select(F.col("partitionKey").alias("partition_key"), F.col("data").cast("string").alias("value"))
    ST.run_available(ST.spread_by_element(keyed), f"{base}/out", f"{base}/checkpoint")
    rows = t.spark.read.schema("partition_key string, value string").parquet(f"{base}/out")
    return rows.groupBy("partition_key").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(C.json_field("value", "$.event_id", "bigint")).alias("id_sum"))


@query("r08_consume_changes", """
    SELECT 1 AS run, COUNT(*) FILTER (event_type <> 'signup') AS n_rows FROM events UNION ALL SELECT 2, COUNT(*) FILTER (event_type = 'signup') FROM events UNION ALL SELECT 3, 0""")
def _(t):
    base = scratch_dir(t.spark, "consume")
    first = F.col("event_type") != "signup"
    for run, part in ((1, t.events.filter(first)), (2, t.events.filter(~first)), (3, None)):
        if part is not None:
            part.select("event_id", "event_type").write.mode("append").parquet(f"{base}/in")
        stream = ST.stream_files(t.spark, f"{base}/in", "event_id bigint, event_type string", glob="*.parquet")
        ST.run_available(stream.withColumn("run", F.lit(run)), f"{base}/out", f"{base}/checkpoint")
    rows = t.spark.read.schema("event_id bigint, event_type string, run int").parquet(f"{base}/out")
    runs = t.spark.range(1, 4).select(F.col("id").cast("int").alias("run"))
    counts = rows.groupBy("run").agg(F.count_distinct("event_id").alias("n"))
    return runs.join(counts, "run", "left").select("run", F.coalesce("n", F.lit(0)).alias("n_rows"))


@query("r06_run_statistics", """
    WITH d AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1)
    SELECT COUNT(*) AS n_batches, CAST(SUM(n) AS BIGINT) AS input_rows, MAX(n) AS largest_batch, MIN(n) AS smallest_batch, true AS ordered_seconds, COUNT(*) > 1 AS has_gap FROM d""")
def _(t):
    base = scratch_dir(t.spark, "statistics")
    # One file for each day, and one file for each batch: the number and the sizes of the batches follow from the data.
    days = t.events.select("event_id", F.to_date("ts").alias("day"))
    days.repartition("day").write.partitionBy("day").option("maxRecordsPerFile", 0).parquet(f"{base}/in")
    stream = ST.stream_files(t.spark, f"{base}/in", "event_id bigint", glob="*.parquet", files_per_batch=1)
    with ProgressLog(t.spark, f"{base}/events") as log:
        ST.run_available(stream, f"{base}/out", f"{base}/checkpoint")
    found = run_statistics(log.read().filter("input_rows > 0"))
    seconds = (F.col("min_seconds") >= 0) & (F.col("min_seconds") <= F.col("mean_seconds")) & (F.col("mean_seconds") <= F.col("max_seconds"))
    return found.select("n_batches", "input_rows", "largest_batch", "smallest_batch", seconds.alias("ordered_seconds"), (F.col("mean_gap") >= 0).alias("has_gap"))


# Three versions of a table: the second loses errors, changes purchases and gains signups; the third loses views and changes clicks.
VERSIONS_SQL = """a AS (SELECT event_id, event_type, CAST(event_id % 100 AS BIGINT) AS amount FROM events),
    v1 AS (SELECT * FROM a WHERE event_type <> 'signup'),
    v2 AS (SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN amount + 1000 ELSE amount END AS amount FROM a WHERE event_type <> 'error'),
    v3 AS (SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN amount + 500 ELSE amount END AS amount FROM v2 WHERE event_type <> 'view')"""


def _net_sql(old, new, since, until):
    return f"""SELECT o.event_id, o.event_type, o.amount, 'DELETE' AS action, n.event_id IS NOT NULL AS is_update, {since} AS since, {until} AS until
        FROM {old} o LEFT JOIN {new} n USING (event_id) WHERE n.event_id IS NULL OR n.amount <> o.amount
        UNION ALL SELECT n.event_id, n.event_type, n.amount, 'INSERT', o.event_id IS NOT NULL, {since}, {until}
        FROM {new} n LEFT JOIN {old} o USING (event_id) WHERE o.event_id IS NULL OR n.amount <> o.amount"""


@query("r08_change_feed", f"""
    WITH {VERSIONS_SQL}, v0 AS (SELECT * FROM a WHERE false)
    {_net_sql("v0", "v1", 0, 1)} UNION ALL {_net_sql("v1", "v2", 1, 2)} UNION ALL {_net_sql("v2", "v3", 2, 3)}""")
def _(t):
    base = scratch_dir(t.spark, "feed")
    table = StateFolder(t.spark, f"{base}/table")
    feed = ChangeFeed(table, ["event_id"], f"{base}/offsets")
    keep = append_changes(f"{base}/out")
    kind, rows = F.col("event_type"), t.events.select("event_id", "event_type", (F.col("event_id") % 100).alias("amount"))
    second = rows.filter(kind != "error").withColumn("amount", F.when(kind == "purchase", F.col("amount") + 1000).otherwise(F.col("amount")))
    third = second.filter(kind != "view").withColumn("amount", F.when(kind == "click", F.col("amount") + 500).otherwise(F.col("amount")))
    for version, state in enumerate((rows.filter(kind != "signup"), second, third), 1):
        table.commit(state, version)
        # The consumer writes, but its offset is not published: the round runs again and repeats nothing.
        keep(feed.changes(feed.offset(), version), feed.offset())
        feed.consume(keep)
        feed.consume(keep)
    kept = t.spark.read.schema("event_id bigint, event_type string, amount bigint, action string, is_update boolean, since int, until int").parquet(f"{base}/out")
    return kept.drop("round")
