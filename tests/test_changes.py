import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as X
from tidemark.operators import incremental as I
from tidemark.operators import snapshots as H
from tidemark.session import scratch_dir
from tidemark.streaming import streams as ST

FEED = [
    ("a", 1, "insert", 10), ("a", 3, "update", 30), ("a", 2, "update", 20),  # a lower sequence arrives late
    ("b", 1, "insert", 11), ("b", 5, "delete", None), ("b", 4, "update", 44),  # delete, then an older update
    ("c", 1, "insert", 12), ("c", 2, "delete", None), ("c", 3, "insert", 33),  # a key that returns
    ("d", 1, "insert", 13), ("d", 1, "insert", 13),  # exact duplicate
]
CURRENT = [("a", 3, 30), ("c", 3, 33), ("d", 1, 13)]
DDL = "key string, seq int, op string, value int"


def feed(spark, rows):
    return spark.createDataFrame(rows, DDL)


def deleted():
    return F.col("op") == "delete"


def test_apply_changes(spark, rows):
    assert rows(X.apply_changes(feed(spark, FEED), ["key"], ["seq"], deleted(), ["op"])) == CURRENT


@pytest.mark.parametrize("seed", range(4))
def test_batches_in_any_order_give_the_same_state(spark, rows, seed):
    shuffled = FEED[:]
    random.Random(seed).shuffle(shuffled)
    state = None
    for batch in itertools.batched(shuffled, 3 + seed):
        state = X.apply_changes_state(feed(spark, batch), ["key"], ["seq"], deleted(), state)
    assert rows(X.current_rows(state, ["op"])) == CURRENT


def test_tombstone_stops_a_late_row(spark, rows):
    state = X.apply_changes_state(feed(spark, [("b", 5, "delete", None)]), ["key"], ["seq"], deleted())
    state = X.apply_changes_state(feed(spark, [("b", 4, "update", 44)]), ["key"], ["seq"], deleted(), state)
    assert rows(X.current_rows(state)) == []


def test_merged_table_survives_replay_and_compaction(spark, rows):
    table = ST.MergedTable(spark, scratch_dir(spark, "t"), ["key"], ["seq"], deleted())
    batches = [FEED[:4], FEED[4:7], FEED[7:]]
    for i, batch in enumerate(batches):
        table.add(feed(spark, batch), i)
        table.add(feed(spark, batch), i)  # replay of the same batch
        table.compact(i)
    table.compact(2)  # replay of a compaction
    assert rows(table.current().drop("op")) == CURRENT
    assert table.delta_batches() == [2]


def test_route_keeps_only_its_table(spark, rows):
    texts = [
        '{"metadata":{"schema-name":"s","table-name":"t","operation":"insert"},"data":{"ID":"1"}}',
        '{"metadata":{"schema-name":"s","table-name":"other","operation":"insert"},"data":{"ID":"2"}}',
        '{"metadata":{"schema-name":"s","table-name":"t","operation":"delete"}}',
        "not json",
        None,
    ]
    df = spark.createDataFrame([(x,) for x in texts], "data_str string")
    accepted, rejected = X.split_null_payload(X.route(df, "s", "t", "struct<ID:string>"))
    assert rows(accepted, "operation", "data.ID") == [("insert", "1")]
    assert rows(rejected, "operation") == [("delete",)]


def test_merge_upsert_and_first_wins(spark, rows):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "n1"), (2, "n2"), (3, "n1")], "k int, v string")
    assert rows(X.merge_upsert(target, batch, ["k"], [F.col("v").desc()])) == [(1, "old"), (2, "n2"), (3, "n1")]
    assert rows(X.insert_first_wins(target, batch, ["k"], [F.col("v")])) == [(1, "old"), (2, "old"), (3, "n1")]


def test_append_newer_takes_all_for_an_empty_target(spark):
    source = spark.range(5)
    assert X.append_newer(source.filter("id < 0"), source, "id").count() == 5
    assert X.append_newer(source.filter("id < 3"), source, "id").count() == 2


def test_change_stream(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "k int, v string")
    assert rows(X.change_stream(before, after, ["k"])) == sorted(
        [(2, None, "DELETE", True), (2, "b", "INSERT", True), (3, "c", "DELETE", False), (4, "d", "INSERT", False)], key=repr)


def ts(day):
    return F.lit(f"2024-01-{day:02d}").cast("timestamp_ntz")


def versions(history):
    return sorted((r["k"], r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in history.collect())


def test_check_snapshot_lifecycle(spark):
    def source(*rows):
        return spark.createDataFrame(rows, "k int, v string")

    history = H.initial_snapshot(source((1, "a"), (2, "b")), ["k"], ts(1))
    unchanged = H.snapshot_by_columns(history, source((1, "a"), (2, "b")), ["k"], ["v"], ts(2))
    assert versions(unchanged) == versions(history)
    changed = H.snapshot_by_columns(unchanged, source((1, None)), ["k"], ["v"], ts(3))  # null is a value; 2 is gone
    back = H.snapshot_by_columns(changed, source((1, None), (2, "b")), ["k"], ["v"], ts(5))  # 2 returns
    got = sorted((r["k"], r["v"] or "-", r["valid_from"].day, r["valid_to"].day if r["valid_to"] else 99) for r in back.collect())
    assert got == [(1, "-", 3, 99), (1, "a", 1, 3), (2, "b", 1, 3), (2, "b", 5, 99)]
    assert H.as_of(back, ts(4)).collect() == [(1, None)]
    assert H.as_of(back, ts(9)).count() == 2
    first = back.filter("k = 1 and valid_to is null").first()["scd_id"]
    assert H.before_change(back, ["k"], first).count() == 2


def test_snapshot_refuses_a_repeated_key(spark):
    start = H.initial_snapshot(spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], ts(1))
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="source key repeats"):
        H.snapshot_by_columns(start, twice, ["k"], ["v"], ts(2)).collect()


def test_timestamp_snapshot_ignores_older_rows(spark):
    def source(day, value):
        return spark.createDataFrame([(1, value)], "k int, v string").withColumn("at", ts(day))

    history = H.initial_snapshot(source(5, "x"), ["k"], F.col("at"))
    late = H.snapshot_by_timestamp(history, source(4, "late"), ["k"], "at", ts(9))
    assert versions(late) == [(1, "x", 5, None)]
    newer = H.snapshot_by_timestamp(late, source(7, "y"), ["k"], "at", ts(9))
    assert [(r["v"], r["valid_from"].day) for r in newer.orderBy("valid_from").collect()] == [("x", 5), ("y", 7)]


def test_history_table_leaves_closed_files_alone(spark):
    def source(*rows):
        return spark.createDataFrame(rows, "k int, v string")

    table = H.HistoryTable(spark, scratch_dir(spark, "history"), source((1, "a")).schema, ["k"], check=["v"])
    assert table.rows().collect() == [] and table.files("closed") == set()
    states = [[(1, "a"), (2, "b")], [(1, "a"), (2, "b")], [(1, None)], [(1, None), (2, "b")], [(1, "c"), (2, "b")]]
    whole, closed = None, set()
    for day, state in enumerate(states, 1):
        whole = H.initial_snapshot(source(*state), ["k"], ts(day)) if whole is None else H.snapshot_by_columns(whole, source(*state), ["k"], ["v"], ts(day))
        assert table.run(source(*state), ts(day)) == day
        # What was closed stays in the same files; a run only adds some.
        assert closed <= table.files("closed")
        closed = table.files("closed")
        got, want = table.rows(), whole
        assert sorted(map(repr, got.select(*sorted(got.columns)).collect())) == sorted(map(repr, want.select(*sorted(want.columns)).collect()))
    assert H.as_of(table.rows(), ts(3)).collect() == [(1, None)]
    # The next run's plan opens open versions only.
    assert all("state=open" in name and "run=5" in name for name in table.open_rows().inputFiles())
    # Only the open parts of the last two runs are left.
    assert [n for n in range(1, 6) if table._part(n, "open").inputFiles()] == [4, 5]


def test_history_table_does_not_publish_a_failed_run(spark):
    def source(*rows):
        return spark.createDataFrame(rows, "k int, v string")

    table = H.HistoryTable(spark, scratch_dir(spark, "history"), source((1, "a")).schema, ["k"], check=["v"])
    table.run(source((1, "a"), (2, "b")), ts(1))
    before = versions(table.rows())
    with pytest.raises(Exception, match="source key repeats"):
        table.run(source((1, "x"), (1, "y")), ts(2))
    assert table.runs() == [1] and versions(table.rows()) == before
    assert table.run(source((1, "x")), ts(3)) == 2
    assert sorted(map(repr, versions(table.rows()))) == sorted(map(repr, [(1, "a", 1, 3), (1, "x", 3, None), (2, "b", 1, 3)]))
    table.run(source((1, "x")).limit(0), ts(4))
    assert table.open_rows().count() == 0 and table.closed_rows().count() == 3
    with pytest.raises(ValueError):
        H.HistoryTable(spark, "x", source((1, "a")).schema, ["k"])


def test_duplicate_snapshot_keys_are_reported(spark):
    assert H.duplicate_keys(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).count() == 1


def test_schema_policy(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    wider = spark.createDataFrame([(2, "b", 1.0)], "k int, v string, w double")
    assert I.align_schema(target, wider).columns == ["k", "v", "w"]
    with pytest.raises(ValueError):
        I.align_schema(target, wider, "fail")
    with pytest.raises(ValueError):
        I.align_schema(target, spark.createDataFrame([(2, 3)], "k int, v int"))


def test_state_folder_versions_and_replay(spark):
    folder = I.StateFolder(spark, scratch_dir(spark, "state"))
    assert folder.read() is None
    assert folder.commit(spark.range(1), 0) and folder.commit(spark.range(2), 1)
    assert not folder.commit(spark.range(9), 1)
    assert folder.read().count() == 2 and folder.read(version=1).count() == 1
    folder.commit(spark.range(3), 2, keep=2)
    assert sorted(folder.versions()) == [2, 3]


def test_uncommitted_version_is_not_read(spark):
    path = scratch_dir(spark, "half")
    folder = I.StateFolder(spark, path)
    folder.commit(spark.range(1), 0)
    spark.range(7).write.parquet(f"{path}/v=2")  # written, but its commit never happened
    assert folder.read().count() == 1
    assert folder.commit(spark.range(3), 1) and folder.read().count() == 3


def test_high_water_mark(spark):
    mark = I.HighWaterMark(spark, scratch_dir(spark, "mark"))
    assert mark.current("start") == "start"
    mark.publish("one")
    mark.publish("two")
    assert mark.current("start") == "two"


def test_load_log(spark, rows):
    ddl = "project string, environment string, table_name string, updated_at timestamp_ntz"
    stamp = lambda text: F.lit(text).cast("timestamp_ntz")
    empty = spark.createDataFrame([], ddl)
    run = spark.createDataFrame([("p", "e", "t")], "project string, environment string, table_name string")
    log = I.log_run(empty, run.withColumn("updated_at", stamp("2024-01-20")))
    log = I.log_run(log, run.withColumn("updated_at", stamp("2024-02-01")))
    assert log.count() == 3 and log.filter("updated_at is null").count() == 1
    assert I.purge_log(log, F.lit("2024-02-02").cast("date")).count() == 3
    assert I.purge_log(log, F.lit("2024-02-03").cast("date")).count() == 1


def test_affected_keys_equal_full_recompute(spark):
    facts = spark.range(1000).select((F.col("id") % 100).alias("key"), (F.col("id") * 7 % 1000).alias("at"), F.col("id").alias("v"))

    def compute(keys=None):
        base = facts if keys is None else facts.join(keys, "key", "left_semi")
        return base.groupBy("key").agg(F.sum("v").alias("total"))

    old = facts.filter("at < 950").groupBy("key").agg(F.sum("v").alias("total"))
    keys = I.affected_keys([(facts, F.col("key"), F.col("at") >= 950)], "key")
    updated = I.recompute_affected(old, keys, "key", compute)
    assert keys.count() < 100
    assert updated.exceptAll(compute()).isEmpty() and compute().exceptAll(updated).isEmpty()


def test_streams_without_files_and_with_late_rows(spark):
    base = scratch_dir(spark, "empty")
    feed = spark.createDataFrame([], "k int, at int, gone boolean")
    feed.write.parquet(f"{base}/in")
    stream = ST.stream_files(spark, f"{base}/in", "k int, at int, gone boolean")
    table = ST.MergedTable(spark, f"{base}/state", ["k"], ["at"], F.col("gone"))
    assert ST.merge_stream(stream, table, f"{base}/checkpoint").select("k", "at").collect() == []

    # The last file brings a row sixty days late, for a minute that has rows already.
    for day in ("2024-01-01", "2024-03-01", "2024-01-01"):
        rows = spark.createDataFrame([(f"{day} 00:00:30", "ab")], "ts string, p string").withColumn("ts", F.to_timestamp("ts"))
        rows.coalesce(1).write.mode("append").parquet(f"{base}/late")
    late = ST.stream_files(spark, f"{base}/late", "ts timestamp, p string", files_per_batch=1)
    sums = ST.stream_throughput(late, "ts", "p", f"{base}/sums", f"{base}/late-checkpoint")
    assert sorted((r["n_rows"], r["n_bytes"]) for r in sums.collect()) == [(1, 2), (2, 4)]
