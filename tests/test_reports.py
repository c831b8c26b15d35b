import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import governance as G
from tidemark.operators import lookups as L
from tidemark.operators import measures as M
from tidemark.operators import quality as Q
from tidemark.operators import statistics as S
from tidemark.operators import text as X
from tidemark.operators import vectors as V
from tidemark.sources.files import inline_table
from tidemark.sources.reports import non_empty_report, validate_requests


def test_line_fit_and_r_squared(spark):
    df = spark.createDataFrame([(1.0, 3.0, "a"), (2.0, 5.0, "b"), (4.0, 9.0, "c"), (None, 1.0, "d")], "x double, y double, g string")
    fit = S.line_fit(df, "x", "y").first()
    assert (fit["n"], fit["slope"], fit["intercept"]) == (3, 2.0, 1.0)
    assert S.line_fit(df.filter("x = 1"), "x", "y").first()["slope"] is None
    points = S.grouped_r_squared(df.filter("x is not null"), "g", F.sum("x"), F.sum("y")).first()
    assert points["n"] == 3 and points["r_squared"] == pytest.approx(1.0)


def test_distinct_count_by_sketch(spark):
    row = spark.range(10000).agg(S.distinct_count("id").alias("exact"), S.distinct_count("id", 0.02).alias("near")).first()
    assert row["exact"] == 10000 and abs(row["near"] - 10000) < 800


def test_histogram_holds_every_value(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    bins = S.histogram(df, "v", 10).collect()
    assert sum(b["n"] for b in bins) == 101 and len(bins) == 10
    assert S.square_root_bins(df) == 11
    assert S.histogram(df.filter("v = 3"), "v", 5).first()["n"] == 1


def test_spread_keeps_the_sum(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-04", 100.0), ("2024-01-03", "2024-01-03", 7.0), ("2024-01-10", "2024-01-08", 3.0)],
                               "a string, b string, v double")
    days = S.spread_over_days(df, "a", "b", F.col("v"))
    got = {str(r["day"]): float(r["amount"]) for r in days.collect()}
    assert got == {"2024-01-01": 25.0, "2024-01-02": 25.0, "2024-01-03": 32.0, "2024-01-04": 25.0, "2024-01-10": 3.0}


def test_hierarchy_with_a_cycle_is_refused(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string")
    with pytest.raises(ValueError, match="cycle"):
        S.hierarchy_closure(edges)


def test_hierarchy_closure(spark, rows):
    edges = spark.createDataFrame([("c", "b"), ("b", "a"), ("x", "a")], "child string, parent string")
    assert rows(S.hierarchy_closure(edges)) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1), ("x", "a", 1)]


def test_hierarchy_closure_rounds_grow_with_the_logarithm(spark, monkeypatch):
    rounds, cut = [], S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    chain = spark.range(300).select(F.col("id").alias("child"), (F.col("id") + 1).alias("parent"))
    closure = S.hierarchy_closure(chain)
    assert closure.where("ancestor = node + depth").count() == closure.distinct().count() == 300 * 301 // 2
    assert len(rounds) == 11  # the edges, joins at 1, 2, 4 ... 256 edges, and one at 512 that finds nothing


def test_hierarchy_closure_with_several_parents(spark, rows):
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "r"), ("d", "a"), (None, "a"), ("r", None)], "child string, parent string")
    level = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    expected = []
    while found := level.collect():
        expected += [(r.node, r.ancestor, r.depth) for r in found]
        level = spark.createDataFrame(found, level.schema).join(edges, F.col("ancestor") == F.col("child")).select("node", F.col("parent").alias("ancestor"), (F.col("depth") + 1).alias("depth"))
    assert sorted(map(str, rows(S.hierarchy_closure(edges)))) == sorted(map(str, expected))
    assert S.hierarchy_closure(edges.limit(0)).count() == 0


def test_reconcile_counts_a_missing_side_as_zero(spark, rows):
    left = spark.createDataFrame([("a", 5), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([("a", 3)], "k string, v int")
    assert rows(S.reconcile(left, right, ["k"], "v"), "k", "variance") == [("a", 2), ("b", 2)]


def test_periods_on_leap_day(spark):
    fact = spark.createDataFrame([("2024-02-29", 4), ("2024-02-01", 2), ("2023-02-28", 8), ("2023-03-01", 16), ("2023-01-05", 1)], "d string, v int")
    fact = fact.select(F.col("d").cast("timestamp_ntz").alias("d"), "v")
    row = M.period_totals(fact, "d", {"m": F.col("v")}, M.latest_day(fact, "d")).first()
    assert (row["m_day"], row["m_mtd"], row["m_mtd_ly"], row["m_ytd"], row["m_ytd_ly"]) == (4, 6, 8, 6, 9)


def test_period_filter_reaches_the_scan(spark, tmp_path):
    fact = spark.range(10).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).cast("timestamp_ntz").alias("d"), F.lit(1).alias("v"))
    fact.write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    plan = M.period_totals(fact, "d", {"m": F.col("v")}, M.latest_day(fact, "d"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2023-01-01" in plan


def test_growth_blanks(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 1.0), (None, 1.0), (1.0, 0.0), (1.0, None)], "c double, b double")
    got = [tuple(r) for r in df.select(M.growth(F.col("c"), F.col("b")), M.growth_blank_zero(F.col("c"), F.col("b"))).collect()]
    assert got == [(1.0, 1.0), (0.0, None), (None, None), (None, None), (None, None)]


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (None, None)], "k int, v string")
    assert rows(Q.not_unique(df, "k")) == [(1, 2)]
    assert Q.not_null(df, "k").count() == 2
    assert rows(Q.unaccepted_values(df, "v", ["a", "b"])) == [("z", 1)]
    assert Q.any_null(df).count() == 2
    assert Q.orphans(df, "k", spark.createDataFrame([(2,)], "id int"), "id").count() == 2


def test_gate(spark):
    df = spark.range(5)
    warn = Q.RowRule("positive", "id", F.col("id") < 1, "warn")
    assert Q.gate(Q.summarise(df, [warn])) == ["positive(id): 1"]
    with pytest.raises(ValueError):
        Q.gate(Q.summarise(df, [warn, Q.RowRule("small", "id", F.col("id") > 2)]))


@pytest.mark.parametrize("hours, status", [(1, "pass"), (5, "warn"), (50, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    at = F.timestamp_add("HOUR", F.lit(hours), F.lit("2024-01-01").cast("timestamp_ntz"))
    assert Q.freshness(df, "t", at, 2, 24).first()["status"] == status
    assert Q.freshness(df.filter("t is null"), "t", at, 2, 24).first()["status"] == "error"


def test_personal_data_scan(spark):
    df = spark.createDataFrame([("mail bob@example.com now", 1), ("call +1 (555) 123-4567", 2), ("card 1234-5678-9012-3456", 3),
                                ("at 10.0.0.1", 4), ("id 123-45-6789.", 5), ("nothing @ all", 6), (None, 7)], "t string, n int")
    scan = Q.scan_personal_data({"o": df})
    hits = {r["detector"]: r["hits"] for r in scan.collect()}
    assert hits == {"email": 1, "phone": 1, "card": 1, "ip_address": 1, "national_id": 1}
    previous = scan.withColumn("hits", F.when(F.col("detector") == "email", 0).otherwise(F.col("hits")))
    assert [r["detector"] for r in Q.scan_delta(scan, previous).collect()] == ["email"]


def test_unique_lookup(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "k string, v int")
    assert rows(L.unique_lookup(df, "k", "v")) == [("a", 1, False), ("b", None, True)]
    with pytest.raises(PySparkException):
        L.unique_lookup(df, "k", "v", "error").collect()


def test_converted_total_repeats_duplicates_on_request(spark):
    sales = inline_table(spark, [("d", "x", 2.0), ("d", "x", 2.0), ("d", "x", 3.0)], "day string, cur string, v double")
    rates = inline_table(spark, [("d", 10.0)], "day string, rate double")
    plain = L.converted_total(sales, rates, ["day"], F.col("v"), "rate", ["cur"])
    report = L.converted_total(sales, rates, ["day"], F.col("v"), "rate", ["cur"], per_row_measure=True)
    assert plain.first()["converted"] == 70.0 and report.first()["converted"] == 110.0


def test_entitlement_keeps_rows_without_tenant(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, tenant int")
    assert sorted(r[0] for r in G.entitled_view(df, ["id"], "tenant", [10]).collect()) == [1, 3]
    assert G.entitled_view(df, None, extra_filter="id > 1").count() == 2


def test_registry_rules(spark):
    catalog = spark.createDataFrame([("s", "t1"), ("s", "t2"), ("r", "u")], "schema_name string, table_name string")
    ddl = "entity string, schema_name string, table_name string, access_type string"
    registry = spark.createDataFrame([("e1", "s", "t1", "TABLE"), ("e2", "s", "t1", "SCHEMA")], ddl)
    requests = spark.createDataFrame(
        [("e1", "s", None, "SCHEMA"), ("e2", "s", "t2", "TABLE"), ("e1", "s", "t2", "TABLE"), ("e3", "s", None, "SCHEMA"),
         ("e1", "x", "t1", "TABLE"), ("e1", "r", "nope", "TABLE")], ddl)
    updated, judged = G.registry_upsert(registry, requests, catalog)
    status = {(r["entity"], r["schema_name"], r["table_name"]): r["status"] for r in judged.collect()}
    assert status == {
        ("e1", "s", None): "TABLE ACCESS EXISTS", ("e2", "s", "t2"): "SCHEMA ACCESS EXISTS", ("e1", "s", "t2"): "ACCEPTED",
        ("e3", "s", None): "ACCEPTED", ("e1", "x", "t1"): "INVALID SCHEMA", ("e1", "r", "nope"): "INVALID TABLE"}
    assert updated.count() == 5


def test_registry_replaces_a_schema_and_judges_one_batch_in_order(spark, rows):
    catalog = spark.createDataFrame([("s", "t1"), ("s", "t2")], "schema_name string, table_name string")
    ddl = "entity string, schema_name string, table_name string, access_type string"
    registry = spark.createDataFrame([("e1", "s", "left", "SCHEMA"), ("e1", "s", "t1", "SCHEMA")], ddl)
    requests = spark.createDataFrame(
        [("e1", "s", None, "SCHEMA", 1), ("e2", "s", "t1", "TABLE", 1), ("e2", "s", None, "SCHEMA", 2), ("e3", "s", "nope", "TABLE", 1),
         ("e3", "s", None, "SCHEMA", 2)], f"{ddl}, n int")
    updated, judged = G.registry_upsert(registry, requests, catalog, ["n"])
    assert rows(updated) == [("e1", "s", "t1", "SCHEMA"), ("e1", "s", "t2", "SCHEMA"), ("e2", "s", "t1", "TABLE"),
                             ("e3", "s", "t1", "SCHEMA"), ("e3", "s", "t2", "SCHEMA")]
    assert rows(judged, "entity", "access_type", "status") == [
        ("e1", "SCHEMA", "ACCEPTED"), ("e2", "SCHEMA", "TABLE ACCESS EXISTS"), ("e2", "TABLE", "ACCEPTED"),
        ("e3", "SCHEMA", "ACCEPTED"), ("e3", "TABLE", "INVALID TABLE")]


def test_access_defaults(spark):
    ddl = "entity string, source_database string, source_schema string, source_table string, target_database string, target_schema string, target_table string, access_roles string"
    df = spark.createDataFrame([
        ("e", "raw_shop_dev", "s", "t", None, "", None, ""), ("e", "plain", "s", "t", "", None, "", None), ("e", "raw_x", "s", "t", "d", "c", "b", "r"), (None, None, None, None, None, None, None, None)], ddl)
    got = [tuple(r) for r in G.access_defaults(df, "reader").select("target_database", "target_schema", "target_table", "access_roles").collect()]
    assert got == [("e_dev", "s", "t", "reader"), ("e_plain", "s", "", "reader"), ("d", "c", "b", "r"), (None, None, None, "reader")]


def brute_overlap(ranges):
    return {f: (sum(1 for g, a, b in ranges if g != f and a <= hi and b >= lo), sum(1 for g, a, b in ranges if a <= lo <= b))
            for f, lo, hi in ranges}


@pytest.mark.parametrize("seed", range(3))
def test_range_overlap_against_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    ranges = [(f"f{i}", int(lo), int(lo + size)) for i, (lo, size) in enumerate(zip(rng.integers(0, 60, 40), rng.integers(0, 15, 40)))]
    df = spark.createDataFrame(ranges, "file string, low int, high int")
    out = G.range_overlap(df)
    assert {r["file"]: (r["overlaps"], r["depth"]) for r in out.collect()} == brute_overlap(ranges)
    assert sum(r["n_files"] for r in G.depth_histogram(out).collect()) == 40


def test_validate_requests(spark):
    catalog = spark.createDataFrame([("s", "t")], "schema_name string, table_name string")
    requests = spark.createDataFrame([("s", "t"), ("s", None), ("s", "x"), ("z", "t")], "schema_name string, table_name string")
    got = {(r[0], r[1]): r["status"] for r in validate_requests(requests, catalog).collect()}
    assert got == {("s", "t"): "VALID", ("s", None): "VALID", ("s", "x"): "INVALID TABLE", ("z", "t"): "INVALID SCHEMA"}


def test_non_empty_report(spark):
    views = {"a": lambda: spark.range(1), "b": lambda: spark.range(0), "c": lambda: spark.table("no_such_table")}
    got = {r["view_name"]: (r["status"], bool(r["message"])) for r in non_empty_report(spark, views).collect()}
    assert got == {"a": ("filled", False), "b": ("empty", False), "c": ("error", True)}


def test_replacements_chain_in_order(spark):
    df = spark.createDataFrame([("ab a",)], "t string")
    assert df.select(X.replace_in_order("t", [("a", "b"), ("b", "c")])).first()[0] == "cc c"
    assert df.select(X.replace_longest_first("t", [("a", "x"), ("ab", "y")])).first()[0] == "y x"


def test_long_dictionary_equals_the_nested_form(spark):
    pairs = [(f"w{i}", f"w{i + 1}") for i in range(500)]
    df = spark.createDataFrame([("w0 w499 x",), (None,)], "t string")
    want = "w0 w499 x"
    for old, new in pairs:
        want = want.replace(old, new)
    assert [r[0] for r in df.select(X.replace_in_order("t", pairs)).collect()] == [want, None]


def test_stitching_across_buckets(spark, rows):
    lines = [("f", 0, "88,lead"), ("f", 1, "16,a"), ("f", 2, "88,  b "), ("f", 3, "88,c"), ("f", 4, "49,d"), ("g", 1, "88,x"), ("g", 2, "01,y")]
    df = spark.createDataFrame(lines, "file string, n int, line string")
    for size in (1, 2, 100):
        got = rows(X.stitch_records(df, "file", "n", "line", ranges=size), "file", "record")
        assert got == [("f", "16,abc"), ("f", "49,d"), ("f", "lead"), ("g", "01,y"), ("g", "x")]


def test_referenced_tables(spark, rows):
    sql = "select * from a.b, x\nLEFT JOIN c; inner join (select 1) join {{ source('raw', 'src') }} from_x join AS"
    df = spark.createDataFrame([("m", sql)], "name string, txt string")
    assert rows(X.referenced_tables(df, "name", "txt")) == [("m", "ab"), ("m", "c"), ("m", "src")]


def test_referenced_tables_of_any_case_and_odd_names(spark, rows):
    sql = "from {{ SOURCE( 'raw','x' ) }} join my-table t join {{source(\"raw\", 'y')}}, from p.q; from fn(1)"
    df = spark.createDataFrame([("m", sql)], "name string, txt string")
    assert rows(X.referenced_tables(df, "name", "txt")) == [("m", "fn"), ("m", "pq"), ("m", "x"), ("m", "y")]


def test_run_log(spark, rows):
    lines = ["sql view model a.v SUCCESS 1 in 100.01s", "sql incremental model a.i SUCCESS 1 in 100s", "\x1b[0m sql table model a.b ...... [\x1b[32mSUCCESS 1\x1b[0m in 123.4s]", "sql table model a.c SUCCESS 1 in 99.9s", "other"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert rows(X.mine_run_log(df, "line", 100), "model", "seconds") == [("a.b", 123.4), ("a.v", 100.01)]


def test_block_replacement_counts(spark):
    df = spark.createDataFrame([("has OLD text",), ("none",)], "t string")
    out = X.replace_block_and_append(df, "t", "OLD", "NEW", "\nfooter ")
    assert sorted(r["t"] for r in out.collect()) == ["has NEW text\nfooter", "none\nfooter"]
    assert out.filter("replaced").count() == 1


def brute_top(corpus, queries, k):
    want = []
    for q, vector in queries:
        scored = []
        for name, other in corpus:
            if other is not None and np.linalg.norm(other) > 0:
                scored.append((-float(np.dot(vector, other) / np.linalg.norm(vector) / np.linalg.norm(other)), name))
        want += [(q, name) for _, name in sorted(scored)[:k]]
    return sorted(want)


def test_batch_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    corpus = [(i, rng.normal(size=5).round(3).tolist()) for i in range(200)] + [(200, None), (201, [0.0] * 5)]
    queries = [(i, rng.normal(size=5).round(3).tolist()) for i in range(7)]
    df = spark.createDataFrame(corpus, "id bigint, v array<double>").repartition(3)
    asked = spark.createDataFrame(queries, "q bigint, v array<double>")
    for limit in (131_072, 10):  # one block a task, or blocks of two rows
        monkeypatch.setattr(V, "BLOCK_VALUES", limit)
        got = sorted((r["query_id"], r["id"]) for r in V.batch_top_k(df, "id", "v", asked, "q", "v", 4).collect())
        assert got == brute_top(corpus, queries, 4)


def test_batch_top_k_ties_gaps_and_empty_sides(spark):
    ddl = "id bigint, v array<double>, q string"
    df = spark.createDataFrame(
        [(5, [1.0, 0.0], "x"), (3, [2.0, 0.0], "x"), (3, [2.0, 0.0], "x"), (9, [0.0, 1.0], None), (7, [None, 1.0], "x"),
         (8, [float("nan"), 1.0], "x"), (None, [1.0, 0.0], "x"), (1, None, "x"), (2, [], "x")], ddl)
    asked = spark.createDataFrame([(1, [3.0, 0.0]), (2, None), (3, [0.0, 0.0])], "id bigint, v array<double>")
    got = [tuple(r) for r in V.batch_top_k(df, "id", "v", asked, "id", "v", 3).orderBy("rank").collect()]
    assert got == [(1, 3, 1.0, 1), (1, 3, 1.0, 2), (1, 5, 1.0, 3)]
    assert V.batch_top_k(df, "id", "v", asked.limit(0), "id", "v", 3).collect() == []
    assert V.batch_top_k(df.limit(0), "id", "v", asked, "id", "v", 3).collect() == []
    with pytest.raises(ValueError, match="different length"):
        V.batch_top_k(df, "id", "v", spark.createDataFrame([(1, [1.0])], "id bigint, v array<double>"), "id", "v", 3)


def test_batch_top_k_many_queries(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_VALUES", 512)
    rng = np.random.default_rng(2)
    corpus = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 8)))]
    df = spark.createDataFrame(corpus, "id bigint, v array<double>").repartition(5)
    got = V.batch_top_k(df, "id", "v", df.withColumnRenamed("id", "q"), "q", "v", 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" in plan
    unit = np.array([v for _, v in corpus])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = {(q, int(i)) for q, row in enumerate(unit @ unit.T) for i in np.argsort(-row)[:3]}
    assert {(r["query_id"], r["id"]) for r in got.collect()} == want


def test_lanes_send_few_copies():
    assert V._lanes(200, 100_000, 1) == (200, 1)
    assert V._lanes(200, 1, 100_000) == (1, 200)
    assert V._lanes(100, 50_000, 50_000) == (10, 10)
    assert V._lanes(8, 3, 2) == (3, 2)


def test_cosine_of_missing_vectors_is_null(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [-2.0, 0.0])], "id int, v array<double>")
    got = {r["id"]: r["s"] for r in df.select("id", V.cosine_to("v", [3.0, 0.0]).alias("s")).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: -1.0}
    assert V.top_k(df, "v", [3.0, 0.0], 5, "id").count() == 1
