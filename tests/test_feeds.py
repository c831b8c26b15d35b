"""Change feeds, run statistics of streams, bucketed merges and tombstones."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.buckets import BucketedFolder, bucket_number
from tidemark.operators.feeds import ChangeFeed, append_changes
from tidemark.operators.incremental import StateFolder
from tidemark.session import scratch_dir
from tidemark.streaming import streams as ST
from tidemark.streaming.progress import ProgressLog, run_statistics

DDL = "id bigint, v string"


def table(spark, *states):
    folder = StateFolder(spark, scratch_dir(spark, "feed-table"))
    for i, state in enumerate(states, 1):
        folder.commit(spark.createDataFrame(state, DDL), i)
    return folder


def found(spark, path):
    rows = spark.read.parquet(path).collect()
    return sorted((r["since"], r["until"], r["action"], r["is_update"], r["id"], r["v"]) for r in rows)


def test_feed_gives_each_change_once(spark):
    folder, out = table(spark, [(1, "a"), (2, "b")]), scratch_dir(spark, "feed-out")
    feed = ChangeFeed(folder, ["id"], scratch_dir(spark, "feed-offsets"))
    keep = append_changes(out)
    assert feed.offset() == 0 and feed.consume(keep) == 1
    first = [(0, 1, "INSERT", False, 1, "a"), (0, 1, "INSERT", False, 2, "b")]
    assert found(spark, out) == first
    assert feed.consume(keep) == 1 and found(spark, out) == first
    folder.commit(spark.createDataFrame([(2, "B"), (3, "c")], DDL), 2)
    folder.commit(spark.createDataFrame([(2, "B"), (3, None)], DDL), 3)

    def fails(changes, since):
        keep(changes, since)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        feed.consume(fails)
    assert feed.offset() == 1
    # Another version comes in before the round runs again: the round's folder holds what the new round saw.
    folder.commit(spark.createDataFrame([(3, None), (4, "d")], DDL), 4)
    assert feed.consume(keep) == 4
    got = {(r[2], r[3], r[4], r[5]) for r in found_rows(spark, out, 1)}
    assert got == {("DELETE", False, 1, "a"), ("DELETE", False, 2, "b"), ("INSERT", False, 4, "d"), ("INSERT", False, 3, None)}


def found_rows(spark, path, since):
    return [(r["since"], r["until"], r["action"], r["is_update"], r["id"], r["v"]) for r in spark.read.parquet(path).filter(F.col("since") == since).collect()]


def test_feed_shows_updates_as_pairs_and_refuses_lost_versions(spark):
    folder = table(spark, [(1, "a"), (2, None)], [(1, "b"), (2, None)])
    feed = ChangeFeed(folder, ["id"], scratch_dir(spark, "feed-offsets"))
    assert {(r["action"], r["is_update"], r["v"]) for r in feed.changes(1, 2).collect()} == {("DELETE", True, "a"), ("INSERT", True, "b")}
    assert feed.changes(2, 2).isEmpty()
    feed.consume(lambda changes, since: changes.count())
    for i in (3, 4):
        folder.commit(spark.createDataFrame([(i, "x")], DDL), i, keep=2)
    with pytest.raises(ValueError, match="no longer kept"):
        feed.consume(lambda changes, since: None)
    assert feed.offset() == 2


def test_every_batch_of_a_long_run_is_reported(spark, tmp_path):
    """More batches than a query remembers."""
    spark.range(120).repartitionByRange(120, "id").write.parquet(str(tmp_path / "in"))
    stream = ST.stream_files(spark, str(tmp_path / "in"), "id bigint", glob="*.parquet", files_per_batch=1)
    with ProgressLog(spark, str(tmp_path / "events"), every=50) as log:
        run = ST.run_each_batch(stream, lambda batch, i: None, str(tmp_path / "checkpoint"))
    events = log.read().filter("input_rows > 0 or batch_id >= 0")
    n = len([n for n in (tmp_path / "in").glob("*.parquet")])
    assert events.select("batch_id").distinct().count() == n > 100 and len(run.recentProgress) <= 100
    r = run_statistics(events).collect()
    assert len(r) == 1 and r[0]["n_batches"] == n and r[0]["min_seconds"] <= r[0]["mean_seconds"] <= r[0]["max_seconds"] and r[0]["mean_gap"] > 0


def test_statistics_of_known_events(spark):
    rows = [("q", "r", i, f"2024-01-01 00:00:{s:02d}", n, ms) for i, s, n, ms in ((0, 0, 5, 1000), (1, 4, 7, 3000), (2, 10, 1, 500))] + [("q", "s", 0, "2024-01-01 00:00:00", 2, None)]
    at = F.col("started_at").cast("timestamp")
    events = spark.createDataFrame(rows, "query_id string, run_id string, batch_id bigint, started_at string, input_rows bigint, duration_ms bigint")
    events = events.withColumn("started_at", at).withColumn("completed_at", F.timestamp_add("MILLISECOND", F.col("duration_ms"), at))
    got = {r["run_id"]: r for r in run_statistics(events).collect()}
    r = got["r"]
    assert (r["n_batches"], r["input_rows"], r["largest_batch"], r["smallest_batch"]) == (3, 13, 7, 1)
    assert (r["mean_gap"], r["min_seconds"], r["max_seconds"], r["mean_seconds"]) == (5.0, 0.5, 3.0, 1.5)
    assert got["s"]["mean_gap"] is None and got["s"]["mean_seconds"] is None
    assert run_statistics(events.limit(0)).isEmpty()


def test_merge_rewrites_touched_buckets_only(spark):
    folder = BucketedFolder(spark, scratch_dir(spark, "buckets"), ["id"], 16)
    assert folder.read() is None
    folder.merge(spark.range(500).select("id", F.lit("old").alias("v")), [F.col("v")])
    before = folder.files()
    batch = spark.createDataFrame([(7, "new"), (7, "older"), (9_000, "added")], DDL)
    touched = folder.merge(batch, [F.col("v")])
    after = folder.files()
    numbers = {r[0] for r in batch.select(bucket_number(["id"], 16)).collect()}
    assert set(touched) == numbers and len(numbers) < 16
    assert all((after[b] == before[b]) == (b not in numbers) for b in after)
    rows = {r["id"]: r["v"] for r in folder.read().collect()}
    assert len(rows) == 501 and rows[7] == "new" and rows[9_000] == "added" and folder.read().count() == 501
    assert folder.merge(batch, [F.col("v")]) == touched and folder.read().count() == 501
    assert folder.merge(batch.limit(0), [F.col("v")]) == [] and folder.files().keys() == after.keys()


def feed_rows(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string, at timestamp_ntz, op string") if rows else spark.createDataFrame([], "k bigint, v string, at timestamp_ntz, op string")


def test_compaction_by_buckets_and_tombstones(spark):
    from datetime import datetime

    def at(minute):
        return datetime(2024, 1, 1, 0, minute)

    merged = ST.MergedTable(spark, scratch_dir(spark, "merged"), ["k"], ["at"], F.col("op") == "delete", buckets=8, lateness=600)
    merged.add(feed_rows(spark, [(i, "a", at(0), "insert") for i in range(100)]), 0)
    assert len(merged.compact(0)) == 8
    before = merged.base.files()
    merged.add(feed_rows(spark, [(3, None, at(5), "delete")]), 1)
    touched = merged.compact(1)
    assert len(touched) == 1 and sum(merged.base.files()[b] != before[b] for b in before) == 1
    # A late older row within the lateness does not bring the key back; a replayed batch and a repeated compaction change nothing.
    merged.add(feed_rows(spark, [(3, "late", at(2), "insert")]), 2)
    assert merged.current().filter("k = 3").isEmpty() and merged.compact(1) == []
    merged.compact(2)
    assert merged.current().filter("k = 3").isEmpty() and merged.state().filter("k = 3").count() == 1
    # Half an hour on, the tombstone goes when its bucket is next rewritten.
    merged.add(feed_rows(spark, [(3 + 100 * i, "b", at(40), "insert") for i in range(1, 60)]), 3)
    merged.compact(3)
    assert merged.state().filter("k = 3").isEmpty() and merged.current().count() == 99 + 59
    assert merged.delta_batches()[-1] == 3


def test_gate_publishes_only_what_passes(spark):
    from tidemark.operators.gates import fresh, publish_checked, relationship, unique
    from tidemark.operators.quality import RowRule

    folder = StateFolder(spark, scratch_dir(spark, "gate"))
    parents = spark.createDataFrame([(1,), (2,)], "p bigint")
    ddl = "id bigint, p bigint, at timestamp_ntz"
    rules = [RowRule("not_null", "id", F.col("id").isNull()), RowRule("positive_value", "id", F.col("id") < 1, "warn")]
    checks = [unique("id"), relationship("p", parents, "p", "warn"), fresh("at", F.lit("2024-01-02").cast("timestamp_ntz"), 12, 48)]

    def state(*rows):
        return spark.createDataFrame(rows, "id bigint, p bigint, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))

    def judge(df, batch):
        got = publish_checked(folder, df, batch, rules, checks)
        return {(r["check"], r["column"]): (r["failures"], r["severity"], r["passed"], r["published"]) for r in got.collect()}

    got = judge(state((0, 1, "2024-01-01 06:00"), (2, 9, "2024-01-01 05:00")), 1)
    assert got == {("not_null", "id"): (0, "error", True, True), ("positive_value", "id"): (1, "warn", False, True), ("unique", "id"): (0, "error", True, True),
                   ("relationships", "p"): (1, "warn", False, True), ("freshness", "at"): (1, "warn", False, True)}
    assert folder.read().count() == 2
    # Refused: two rows of one id, and a null; the version before stays, and the folder of the refused one is gone.
    got = judge(state((5, 1, "2024-01-02"), (5, 1, None), (None, 1, None)), 2)
    assert got["unique", "id"] == (1, "error", False, False) and got["not_null", "id"][0] == 1 and got["freshness", "at"][0] == 0
    assert folder.read().count() == 2 and [n for n in folder.names(folder.path) if n.startswith("v=")] == ["v=1"]
    assert judge(state(), 3)["freshness", "at"] == (1, "error", False, False)
    # A replayed batch reports the published rows.
    assert judge(state((7, 7, None)), 1)["positive_value", "id"] == (1, "warn", False, True) and folder.read().count() == 2


def test_partition_sample_opens_chosen_files_only(spark, tmp_path):
    from tidemark.operators.topn import sample_partitions

    rows = spark.range(2000).select("id", F.concat(F.lit("a b"), (F.col("id") % 40).cast("string")).alias("block"))
    rows.write.partitionBy("block").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    sample = sample_partitions(table, "block", 25, salt="x")
    blocks = {r["block"] for r in sample.select("block").distinct().collect()}
    assert 3 <= len(blocks) <= 20 and sample.count() == 50 * len(blocks)
    assert {r["block"] for r in sample_partitions(table, "block", 25, salt="x").select("block").distinct().collect()} == blocks
    assert "PartitionFilters: [" in sample._jdf.queryExecution().executedPlan().toString() and "PartitionFilters: []" not in sample._jdf.queryExecution().executedPlan().toString()
    assert sample_partitions(table, "block", 0).isEmpty() and sample_partitions(table, "block", 100).count() == 2000
