from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import layout, recall, search
from tidemark.operators import maintenance as M
from tidemark.operators import qualification as Q
from tidemark.operators.text_index import IndexCoverageError, TextIndex
from tidemark.operators.vector_index import VectorIndex, VectorIndexError, generation, reusable
from tidemark.sources.versions import VersionConflict, VersionedTable


@pytest.fixture()
def table(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    rows = spark.range(200).select(F.col("id").alias("record_id"), F.when(F.col("id") % 20 != 7, F.array((F.col("id") % 4).cast("double"), F.lit(0.0))).alias("vector"))
    t.write(rows.repartition(6), None)
    return t


def test_clustered_rewrite_keeps_all_rows(spark, table):
    centroids = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], "pid long, centroid array<double>")
    assert M.rewrite_clustered(table, centroids, 30) == 2
    assert sorted(r.record_id for r in table.read().collect()) == list(range(200))
    sizes = M.clustered(table.read(), centroids, 30).groupBy("bucket", "pid").count().groupBy("bucket").agg(F.countDistinct("pid").alias("p"), F.sum("count").alias("n")).collect()
    assert sum(r.n for r in sizes) == 200 and all(r.p == 1 or r.n <= 30 for r in sizes)


def test_compaction(table):
    assert M.compact(table) == 2 and len(table.read().inputFiles()) == 1
    assert M.compact(table) is None


def test_retries_end(table):
    calls = []

    def commit():
        calls.append(1)
        if len(calls) < 3:
            raise VersionConflict("late")
        return 9

    assert M.commit_with_retries(commit, 3, 0) == 9
    with pytest.raises(VersionConflict):
        M.commit_with_retries(lambda: (_ for _ in ()).throw(VersionConflict("x")), 2, 0)


def test_schema_growth_is_an_error(spark):
    declared = T.StructType([T.StructField("id", T.LongType())])
    M.check_schema(spark.range(1), declared)
    for bad in (spark.range(1).withColumn("x", F.lit(1)), spark.range(1).select(F.col("id").cast("int"))):
        with pytest.raises(M.SchemaError):
            M.check_schema(bad, declared)


def test_decisions():
    assert M.index_needs_work(False, True, 10, 100, 0, 0) is None
    assert M.index_needs_work(False, False, 10, 100, 0, 0) == "absent"
    assert M.index_needs_work(True, True, 10, 1, 1, 0) == "uncovered"
    assert M.index_needs_work(True, True, 10, 1, 0, 5) == "deltas"
    assert M.index_needs_work(True, True, 50, 1, 0, 0, rows_at_training=10) == "retrain"
    assert M.merge_roles({"a": "KEY"}, {"a": "TEXT", "b": "TEXT"}) == {"a": "KEY", "b": "TEXT"}
    assert (M.shuffle_width(1, 1), M.shuffle_width(10**7, 5), M.shuffle_width(10, 100), M.shuffle_width(10**12, 5)) == (1, 40, 13, 4096)


def test_retention_publishes_what_stays(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/r")
    now = datetime(2024, 3, 1, tzinfo=UTC)
    rows = [(1, datetime(2024, 2, 29), False), (2, datetime(2024, 1, 1), False), (3, datetime(2024, 2, 1), True), (4, datetime(2023, 1, 1), True), (5, None, False)]
    t.write(spark.createDataFrame(rows, "record_id long, ts timestamp_ntz, is_deleted boolean"), None)
    assert M.retain(t, "ts", now, 7 * 86400, 60 * 86400) == 2
    assert sorted(r.record_id for r in t.read().collect()) == [1, 3, 5]
    assert M.retain(t, "ts", now, 7 * 86400, 60 * 86400) is None
    for bad in (0, -5):
        with pytest.raises(ValueError):
            M.retain(t, "ts", now, bad)


def test_a_round_keeps_going_past_errors(spark, table, tmp_path):
    empty = VersionedTable(spark, f"file://{tmp_path}/none")

    def broken(t):
        raise RuntimeError("lost")

    got = M.maintenance_round({"a": table, "b": empty}, {"compact": M.compact, "check": lambda t: broken(t) if t is table else None, "late": lambda t: 1})
    assert [(r["table"], r["step"], r["outcome"], r["error"]) for r in got] == [("a", "compact", "2", None), ("a", "check", None, "RuntimeError: lost"), ("b", "compact", "skipped", None), ("b", "check", "skipped", None), ("b", "late", "1", None)]


def test_source_files_are_packed(spark, tmp_path):
    spark.range(1000).repartition(8).write.parquet(f"file://{tmp_path}/src")
    assert M.pack_files(spark, f"file://{tmp_path}/src", f"file://{tmp_path}/out") == 1
    out = spark.read.parquet(f"file://{tmp_path}/out")
    assert out.count() == 1000 and len(out.inputFiles()) == 1


def test_text_index_versions(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i % 3} common term{i}") for i in range(12)] + [(12, None)], "record_id long, text string")
    index = TextIndex(spark, f"file://{tmp_path}/i")
    for part in range(6):
        index.add(docs.where(F.col("record_id") % 6 == part), [f"f{part}"])
    terms = spark.createDataFrame([(1, "word1"), (1, "term4"), (2, "none")], "query_id long, term string")
    want = search.bm25(docs, terms, 5).collect()
    assert index.deltas() == 5 and index.bm25(terms, 5).collect() == want
    assert index.merge_deltas() and index.deltas() == 0 and index.merge_deltas() is None and index.bm25(terms, 5).collect() == want
    assert index.covered(["f0", "f5"]) and not index.covered(["f9"])
    before = index.table.current()
    with pytest.raises(IndexCoverageError):
        index.swap(docs, ["g1", "g2"], {"g1"})
    assert index.table.current() == before and index.swap(docs, ["g1"], {"g1"}) == before + 1
    scan = index.hits(["common"])._jdf.queryExecution().toString().split("PartitionFilters:")[1]
    assert "bucket" in scan.split("PushedFilters:")[0] and "term" in scan.split("PushedFilters:")[1][:80]


def test_vector_index(spark, tmp_path):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(12, 8)) * 6
    rows = [(i, (centre[i % 12] + rng.normal(size=8)).tolist()) for i in range(1200)] + [(1200, None), (1201, [1.0])]
    v = spark.createDataFrame(rows, "record_id long, vector array<double>")
    index = VectorIndex(spark, f"file://{tmp_path}/v")
    index.build(v, 8, partitions=12, files=["f"])
    generation_ = generation(index.config())
    q = v.where("record_id % 100 = 0 and vector is not null").select(F.col("record_id").alias("query_id"), "vector")
    exact = index.query(q, 5, bypass=True)
    assert exact.count() == 60 and index.table.read().where("vector is null").count() == 1
    assert index.query(q, 5).join(exact, ["query_id", "record_id"]).count() >= 0.9 * 60
    assert "PartitionFilters: [pid" in index._probed(q.limit(1), 1, 1, None)._jdf.queryExecution().toString().replace("PartitionFilters: [isnotnull(pid", "PartitionFilters: [pid")
    few = index.query(q, 5, live=F.col("record_id") % 400 == 0)
    assert few.groupBy("query_id").count().where("count < 3").count() == 0  # probes wider where partitions hold too few
    with pytest.raises(VectorIndexError):
        index.query(q, 5, probes=100)
    with pytest.raises(VectorIndexError):
        index.query(q, 5, fast_search=False, files=["f", "g"])
    assert index.query(q, 5, fast_search=False, files=["f"]).count() == 60
    index.build(v, 8)  # the stored centroids serve again
    assert generation(index.config()) == generation_ and index.table.versions() == [1, 2]
    assert not reusable(index.config(), 8, "dot") and not reusable(None, 8, "l2")


def test_index_rounds_replan_what_came_too_late():
    tries = []

    def commit(name, built):
        tries.append(name)
        if name == "late" or (name == "once" and tries.count("once") == 1):
            raise VersionConflict("x")

    def plan(name):
        return [] if name == "none" else [name]

    def build(name, spec):
        if name == "bad":
            raise RuntimeError("lost")
        return spec

    assert Q.index_round(["none", "once", "late", "bad", "ok"], plan, build, commit) == {"none": "skipped", "once": "committed", "late": "stale", "bad": "RuntimeError: lost", "ok": "committed"}
    assert tries.count("late") == 3
    assert (Q.shard_count(0), Q.shard_count(33)) == (1, 2)
    assert Q.default_metric(None) == "l2" and Q.default_metric({"metric": "dot"}) == "dot"
    assert Q.default_vector_column(T.StructType().add("a", "string").add("v", T.ArrayType(T.FloatType()))) == "v"


def test_chunks_of_samples():
    assert recall.chunks_by_k([5, 5, 5], 10) == [[0, 1], [2]]
    with pytest.raises(ValueError):
        recall.chunks_by_k([11], 10)


def test_round_robin_salts_are_even(spark):
    rows = spark.range(103).selectExpr("id as record_id", "id % 2 as pid")
    sizes = [r["count"] for r in layout.round_robin(rows, 4).groupBy("pid", "salt").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    assert layout.trainable_partitions(64, 1000) == 3


def test_tags_must_be_dates(spark):
    tags = spark.createDataFrame([(1, "20240101T000000Z"), (1, "20240102T000000Z"), (1, "20249999T000000Z"), (1, "x")], "dataset_id long, tag string")
    assert [r.tag for r in layout.prunable_tags(tags, 1).collect()] == ["20240101T000000Z"]


def test_text_index_makes_no_row_a_token(spark, tmp_path):
    texts = ["a b a", "b B b c", "", None, "c a " * 500, "é_1 é_1 x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "record_id long, text string").coalesce(1)
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.build(docs)
    stored = index.table.read()
    assert stored.count() == stored.select("term").distinct().count() == 5
    marks = index.table.marks()
    assert (marks["n"], marks["tokens"]) == (6, 3 + 4 + 1000 + 3)
    want = search.postings(docs).join(docs.select("record_id", F.size(search.T.tokens(F.col("text"))).alias("dl")), "record_id")
    got = index.hits(["a", "b", "c", "é_1", "x"])
    assert sorted(map(tuple, got.select("record_id", "term", "tf", "dl").collect())) == sorted(map(tuple, want.select("record_id", "term", "tf", "dl").collect()))
    places = {(r.record_id, r.term): r.positions for r in got.collect()}
    assert places[0, "a"] == [0, 2] and places[1, "b"] == [0, 1, 2] and places[4, "a"] == list(range(1, 1000, 2)) and places[5, "x"] == [2]
    scan = index.hits(["a"], False)._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[1]
    assert "positions" not in scan
