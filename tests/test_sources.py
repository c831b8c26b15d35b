import gzip

import pytest
from pyspark.sql import functions as F

from tidemark.operators.governance import file_ranges, range_overlap, write_clustered
from tidemark.operators.topn import sample_blocks, sample_percent
from tidemark.session import scratch_dir
from tidemark.sources import files as S
from tidemark.sources import generators as G
from tidemark.streaming import streams as ST


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_row_numbers_of_a_split_file(spark, tmp_path):
    write(tmp_path / "in" / "a.json", "".join(f'{{"n":{i}}}\n' for i in range(5000)))
    write(tmp_path / "in" / "b.json", '{"n":0}\n{"n":1}\n')
    write(tmp_path / "in" / "c.txt", "ignored\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        landed = S.land_json(spark, str(tmp_path / "in"), "2024-01-01")
        n = F.get_json_object("payload", "$.n").cast("bigint")
        blocks = spark.read.text(str(tmp_path / "in")).select("_metadata.file_block_start").distinct()
        assert blocks.count() > 1
        assert landed.count() == 5002
        assert landed.filter(F.col("row_number") != n + 1).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_bad_record_drops_its_file(spark, tmp_path):
    write(tmp_path / "good.json", '{"n":1}\n{"n":2}\n')
    write(tmp_path / "bad.json", '{"n":3}\n{"n":\n{"n":5}\n')
    clean, bad = S.read_skipping_bad_files(spark, str(tmp_path), "n int")
    assert sorted(r["n"] for r in clean.collect()) == [1, 2]
    assert [r["bad_records"] for r in bad.collect()] == [1]


@pytest.mark.parametrize("per_file", [False, True])
def test_json_array(spark, tmp_path, per_file):
    text = '[{"n":1},{"n":2}]' if not per_file else '[\n {"n":1},\n {"n":2}\n]'
    write(tmp_path / "a.json", text)
    assert sorted(r["n"] for r in S.read_json_array(spark, str(tmp_path), "n int", per_file).collect()) == [1, 2]


def test_several_header_rows(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.csv", f"report\ncreated today\nid;name\n1;\"caf\xe9; {name}\"\nx;bad\n2;plain\n", "iso-8859-1")
    out = S.read_delimited(spark, str(tmp_path), "id int, name string", sep=";", header_rows=3, encoding="ISO-8859-1")
    got = sorted((r["id"] or 0, r["name"]) for r in out.collect())
    assert got == [(0, "bad"), (0, "bad"), (1, "caf\xe9; a"), (1, "caf\xe9; b"), (2, "plain"), (2, "plain")]


def test_malformed_rows_are_dropped(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name\n1,a\nx,b\n3,c\n")
    assert sorted(r["id"] for r in S.read_delimited(spark, str(tmp_path), "id int, name string", header_rows=1).collect()) == [1, 3]


def test_whole_gzip_and_labelled_files(spark, tmp_path):
    write(tmp_path / "w" / "a.txt", "x\ny\n")
    assert S.read_whole_files(spark, str(tmp_path / "w")).first()["content"] == "x\ny\n"
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "a.gz").write_bytes(gzip.compress(b"1\n2\n3\n"))
    assert S.read_gzip_lines(spark, str(tmp_path / "g"), 2).count() == 3
    write(tmp_path / "l" / "Sales_2020_v1.json", '{"n":1}\n')
    write(tmp_path / "l" / "Sales_2021_v1.json", '{"n":2}\n')
    out = S.read_labelled_folder(spark, str(tmp_path / "l"), "n int", "Sales_", "_", fmt="json")
    assert sorted((r["n"], r["label"]) for r in out.collect()) == [(1, "2020"), (2, "2021")]


def test_latest_modified_file(spark, tmp_path):
    import os

    for i, name in enumerate(("b", "c", "a")):
        write(tmp_path / name / "f.txt", "x" * (i + 1))
        os.utime(tmp_path / name / "f.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    newest = S.latest_modified_file(spark, [str(tmp_path / n) for n in "abc"]).first()
    assert newest["path"].endswith("/a/f.txt") and newest["length"] == 3


def test_chunks_rejoin_to_the_input(spark):
    df = spark.createDataFrame([(1, list(range(10))), (2, [1]), (3, []), (4, None)], "k int, items array<int>")
    chunks = S.chunk_items(df, "items", 4)
    got = {}
    for r in chunks.orderBy("k", "chunk").collect():
        assert len(r["items"]) <= 4
        got[r["k"]] = got.get(r["k"], []) + r["items"]
    assert got == {1: list(range(10)), 2: [1]}


def test_full_refresh_replaces(spark):
    path = scratch_dir(spark, "refresh")
    S.full_refresh(spark.range(9), path)
    assert S.full_refresh(spark.range(3), path).count() == 3


def test_inline_table_index(spark):
    out = S.inline_table(spark, [("a", None), ("b", 2)], "x string, y int", index="i")
    assert [tuple(r) for r in out.collect()] == [("a", None, 0), ("b", 2, 1)]


def test_generators_repeat_and_stay_in_range(spark):
    facts = G.facts(spark.range(500), "id", "2024-01-01", 30, [(1, 10), (100, 110)])
    assert facts.exceptAll(G.facts(spark.range(500).repartition(7), "id", "2024-01-01", 30, [(1, 10), (100, 110)])).isEmpty()
    assert facts.filter("not (customer_id between 1 and 10 or customer_id between 100 and 110) or quantity not between 1 and 100").isEmpty()
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-01')) as d")
    per_day = G.daily_entries(days, "d").groupBy("entry_date").count().agg(F.min("count"), F.max("count"), F.count("count")).first()
    assert per_day[0] >= 1 and per_day[1] <= 6 and per_day[2] == 61
    assert G.ticks(spark.range(100), "id", "2024-01-01").filter("price < 0 or price >= 100 or ticker is null").isEmpty()


def test_samples(spark):
    df = spark.range(20000)
    n = sample_percent(df, 10, ["id"]).count()
    assert 1700 < n < 2300 and n == sample_percent(df.repartition(5), 10, ["id"]).count()
    path = scratch_dir(spark, "blocks")
    df.repartition(20).write.parquet(path)
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), "id")
    taken = sample_blocks(spark.read.parquet(path), 50).select("id").join(files, "id").groupBy("f").count()
    whole = files.groupBy("f").count()
    assert taken.join(whole, ["f", "count"], "left_anti").isEmpty() and 0 < taken.count() < 20


def test_clustered_files_overlap_less(spark):
    df = spark.range(4000).select(F.col("id"), (F.hash("id") % 1000).alias("k"))
    plain, clustered = scratch_dir(spark, "p"), scratch_dir(spark, "c")
    df.repartition(8).write.parquet(plain)
    write_clustered(df, clustered, [F.col("k")], 8)
    worst = {
        p: range_overlap(file_ranges(spark.read.parquet(p), "k"), F.floor(F.col("at") / 100)).agg(F.max("overlaps")).first()[0]
        for p in (plain, clustered)
    }
    assert worst[plain] == 7 and worst[clustered] <= 2


def test_stream_reads_only_new_files(spark):
    base = scratch_dir(spark, "stream")
    for run, n in ((0, 3), (1, 4), (2, 0)):
        if n:
            spark.range(n).write.mode("append").parquet(f"{base}/in")
        stream = ST.stream_files(spark, f"{base}/in", "id bigint", glob="*.parquet").withColumn("run", F.lit(run))
        ST.run_available(stream, f"{base}/out", f"{base}/checkpoint")
    got = {r["run"]: r["count"] for r in spark.read.schema("id bigint, run int").parquet(f"{base}/out").groupBy("run").count().collect()}
    assert got == {0: 3, 1: 4}
