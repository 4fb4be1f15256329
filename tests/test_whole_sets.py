"""Queries over the whole query set and the whole vocabulary."""

import pytest
from oracle import compare, connect

from tidemark import registry
from tidemark.operators import search
from tidemark.sources import tables

ROOT = "/root/testdata"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_index_search_finds_nine_in_ten_of_the_whole_query_set(spark, sf):
    exact = spark.read.parquet(f"{ROOT}/{sf}/embeddings.parquet").where("vec_id % 100 = 0").count()
    hits = registry.QUERIES["ivf_search"](spark, f"{ROOT}/{sf}")
    assert hits.groupBy("query_id").count().where("query_id % 100 = 0 and count = 5").count() == exact
    (r,) = registry.QUERIES["ivf_recall"](spark, f"{ROOT}/{sf}").first()
    print(sf, r)
    assert r >= 0.9


NAMES = ["knn_l2", "knn_cosine", "knn_dot", "knn_hamming", "knn_filtered", "dedup_hits", "ranking_quality", "report_grouping_sets", "captured_samples", "rrf", "weighted_fusion", "hybrid_modes", "hybrid_search", "ivf_stored", "recall_samples"]


@pytest.mark.parametrize("name", NAMES)
def test_whole_query_set_in_blocks_matches_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr(search, "QUERY_BLOCK", 7)
    sf = f"{ROOT}/sf0.1"
    assert "vec_id % 100 = 0" in registry.ORACLES[name]
    compare(spark, connect(sf), registry.QUERIES[name], registry.ORACLES[name], sf)


def test_stored_layout_finds_nine_in_ten(spark):
    for sf in ("sf0.01", "sf0.1"):
        assert registry.QUERIES["ivf_stored_recall"](spark, f"{ROOT}/{sf}").first()[0] >= 0.9


def test_many_queries_are_not_broadcast(spark, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    v, q = tables.vectors(spark, f"{ROOT}/sf0.01"), tables.vectors(spark, f"{ROOT}/sf0.01").selectExpr("record_id AS query_id", "vector")
    want = {tuple(r) for r in search.knn(v, q, 3, "l2").collect()}
    monkeypatch.setattr(search, "QUERY_BLOCK", 90)
    got = search.knn(v, q, 3, "l2")
    assert "CartesianProduct" in plan(got) and "Broadcast" not in plan(got)
    assert {tuple(r) for r in got.collect()} == want and len(want) == 1500
    probed = search.ivf_knn(v, tables.centroids(spark, f"{ROOT}/sf0.01"), q, 3, 10)
    assert {tuple(r) for r in probed.collect()} == want


def test_all_terms_are_counted(spark):
    got = {r.term: (r.n, r.df) for r in registry.QUERIES["token_freq"](spark, f"{ROOT}/sf0.01").collect()}
    assert min(df for _, df in got.values()) == 1 and len(got) > 60_000


def test_every_route_has_its_streamed_digest(spark):
    sf = f"{ROOT}/sf0.001"
    assert registry.QUERIES["streamed_source_digest"](spark, sf).count() == 8
    assert {tuple(r) for r in registry.QUERIES["streamed_source_digest"](spark, sf).collect()} == {tuple(r) for r in registry.QUERIES["source_digest"](spark, sf).collect()}
