"""Nearest neighbours in array code against the same distances as Column expressions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.operators import nearest, search


def _expected(v, q, k, metric):
    pairs = v.where("vector is not null").crossJoin(q.withColumnRenamed("vector", "query_vector"))
    scored = pairs.select("query_id", "record_id", search.checked_distance(metric, F.col("vector"), F.col("query_vector")).alias("distance"))
    return search.top_k(scored, k, F.col("distance"))


def _rows(df):
    return sorted(map(repr, df.select("query_id", "record_id", "distance", "rank").collect()))


def _odd(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 6)).round(1)
    x[100:300] = x[7]  # copies
    x[300:310] = 0.0
    x[310] = -0.0
    x[311:320] *= 1e-170
    x[320:325] *= 1e170
    rows = [[float(y) for y in r] for r in x]
    rows[400][2], rows[401][0], rows[402][5] = None, float("nan"), float("inf")
    rows[7][1] = rows[150][1] + 1e-16
    ids = [str(i) if kind == "string" else i for i in range(700)]
    v = spark.createDataFrame([*zip(ids, rows, strict=True), (ids[0], None)], f"record_id {kind}, vector array<double>")
    q = v.where("vector is not null").where("record_id % 7 = 0 or record_id between 398 and 404").selectExpr("record_id as query_id", "vector")
    return v.repartition(3), q


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("metric", V.METRICS)
def test_odd_vectors_have_the_distances_of_the_expression(spark, monkeypatch, metric, kind):
    monkeypatch.setattr(nearest, "CHUNK", 64)
    v, q = _odd(spark, kind)
    want = _rows(_expected(v, q, 9, metric))
    assert _rows(search.knn(v, q, 9, metric)) == want
    monkeypatch.setattr(search, "QUERY_BLOCK", 25)
    monkeypatch.setattr(nearest, "HELD", 2)
    assert _rows(search.knn(v, q, 9, metric)) == want
    assert len(want) == q.count() * 9


def test_no_row_is_made_for_a_pair(spark):
    plan = search.knn(*_odd(spark, "long"), 3, "l2")._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan and plan.count("MapInArrow") == 3  # chunks, blocks, and what meets


def test_few_partitions_are_dealt_over_more_tasks(spark):
    v, q = _odd(spark, "long")
    v, q = (x.where("size(filter(vector, x -> x is null or isnan(x) or abs(x) > 1e9)) = 0") for x in (v, q))
    c = spark.createDataFrame([(0, [1.0] * 6), (1, [-1.0] * 6), (2, [0.0] * 6)], "pid long, centroid array<double>")
    near = search.knn(c.selectExpr("pid as record_id", "centroid as vector"), q, 2, "l2").selectExpr("query_id", "record_id as pid")
    pairs = search.placed(v, c).join(near, "pid").join(q.withColumnRenamed("vector", "query_vector"), "query_id")
    want = search.top_k(pairs.select("query_id", "record_id", search.checked_distance("l2", F.col("vector"), F.col("query_vector")).alias("distance")), 5, F.col("distance"))
    assert _rows(search.ivf_knn(v, c, q, 5, 2)) == _rows(want)


def test_dimensions_must_agree_and_empty_sides_give_nothing(spark):
    v, q = _odd(spark, "long")
    none = q.where("false")
    assert search.knn(v, none, 3, "l2").count() == 0 and search.knn(v.where("false"), q, 3, "l2").count() == 0
    short = q.limit(1).select("query_id", F.array(F.lit(1.0)).alias("vector"))
    with pytest.raises(Exception, match="different dimensions"):
        search.knn(v, short, 3, "l2").collect()
    with pytest.raises(ValueError, match="unknown metric"):
        search.knn(v, q, 3, "l1")
