"""Queries that read stored indexes, and the recall job over captured searches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import audit, recall, search
from tidemark.operators.text_index import TextIndex
from tidemark.operators.vector_index import PROBES, VectorIndex
from tidemark.queries import retrieval as R
from tidemark.queries.streams import _folder
from tidemark.sources import tables
from tidemark.sources.tables import sql

_built: dict[tuple[str, str, str], object] = {}


def _index(spark, sf, kind: str):
    """The stored index of a test folder, built once an application."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _built:
        path = f"{_folder(spark)}/{kind}-{uuid.uuid4().hex[:8]}"
        if kind == "text":
            index = TextIndex(spark, path)
            index.build(tables.texts(spark, sf))
        elif kind == "deltas":  # the same postings as a build, five deltas and their merge
            index = TextIndex(spark, path)
            d = tables.texts(spark, sf)
            for part in range(6):
                index.add(d.where(F.col("record_id") % 6 == part), [f"part-{part}"])
            index.merge_deltas()
        else:
            index = VectorIndex(spark, path)
            index.build(tables.vectors(spark, sf), 64, centroids=tables.centroids(spark, sf))
        _built[key] = index
    return _built[key]


def bm25_stored(spark, sf):
    return _index(spark, sf, "text").bm25(tables.terms(spark, sf), 10).select("query_id", "record_id", "score", "rank")


def bm25_stored_and(spark, sf):
    return _index(spark, sf, "text").bm25(tables.terms(spark, sf), 10, "and").select("query_id", "record_id", "score", "rank")


def bm25_merged_deltas(spark, sf):
    return _index(spark, sf, "deltas").bm25(tables.terms(spark, sf), 10).select("query_id", "record_id", "score", "rank")


def phrase_stored(spark, sf):
    return _index(spark, sf, "text").phrase(["licensed", "the", "license"], 3)


def text_index_state(spark, sf):
    """What the merged index knows of itself."""
    index = _index(spark, sf, "deltas")
    marks = index.table.marks()
    return spark.createDataFrame([(marks["n"], marks["tokens"], len(marks["files"]), index.deltas())], "n long, tokens long, files long, deltas long")


def ivf_stored(spark, sf):
    hits = _index(spark, sf, "vectors").query(tables.vector_queries(spark, sf), 5, probes=PROBES)
    return hits.select("query_id", "record_id", F.round("distance", 9).alias("distance"), "rank")


def ivf_stored_live(spark, sf):
    hits = _index(spark, sf, "vectors").query(tables.vector_queries(spark, sf), 5, probes=PROBES, live=F.expr("not is_deleted and label <= 4"))
    return hits.select("query_id", "record_id", F.round("distance", 9).alias("distance"), "rank")


def ivf_bypass(spark, sf):
    hits = _index(spark, sf, "vectors").query(tables.vector_queries(spark, sf), 5, bypass=True)
    return hits.select("query_id", "record_id", F.round("distance", 9).alias("distance"), "rank")


def ivf_stored_recall(spark, sf):
    """Mean recall of the stored layout against the exact scan, over the whole query set."""
    lists = lambda h, name: h.groupBy("query_id").agg(F.collect_set("record_id").alias(name))
    truth, got = ivf_bypass(spark, sf), ivf_stored(spark, sf)
    each = lists(truth, "t").join(lists(got, "g"), "query_id", "left").select(F.size(F.array_intersect("t", F.coalesce("g", F.array().cast("array<bigint>")))) / F.size("t"))
    return each.toDF("recall").agg(F.round(F.avg("recall"), 9).alias("recall"))


def _samples(spark, sf):
    """The query set as it might have been served, by vector, text and both, and some that can't be graded."""
    q = tables.vector_queries(spark, sf)
    v, d = tables.vectors(spark, sf), tables.texts(spark, sf)
    ids = lambda h, order: h.groupBy("query_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), "record_id"))), lambda x: x["record_id"]).alias("result_ids"))
    served = {
        "vector": ids(search.knn(v, q, 5, "l2", F.col("record_id") % 4 != 1), F.col("rank")),
        "text": ids(search.bm25(d, tables.terms(spark, sf), 5), -F.col("rank")),
        "hybrid": ids(search.knn(v, q, 5, "l2"), F.col("rank")),
    }
    terms = tables.terms(spark, sf).groupBy("query_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    base = q.withColumnRenamed("vector", "query_vector").join(terms, "query_id")
    rows = None
    for i, (kind, got) in enumerate(served.items()):
        part = base.join(got, "query_id").select((F.col("query_id") * 10 + i).alias("sample_id"), F.lit(kind).alias("query_type"), F.lit(5).alias("k"), "result_ids", "query_vector", "terms", F.lit("balanced").alias("mode"))
        rows = part if rows is None else rows.unionByName(part)
    path = f"{_folder(spark)}/samples-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(path)  # captured searches are records: what served them is no part of the plans that grade them
    rows = spark.read.schema(rows.schema).parquet(path)
    none = rows.where("query_type = 'vector'")
    rows = rows.unionByName(none.withColumns({"sample_id": F.col("sample_id") + 5, "result_ids": F.lit(None).cast("array<bigint>")}))
    rows = rows.unionByName(none.withColumns({"sample_id": F.col("sample_id") + 6, "query_vector": F.lit(None).cast("array<double>")}))
    return rows.unionByName(rows.where("query_type = 'hybrid'").withColumns({"sample_id": F.col("sample_id") + 5, "mode": F.lit("other")}))


def recall_samples(spark, sf):
    return recall.score_samples(_samples(spark, sf).persist(), tables.vectors(spark, sf), tables.texts(spark, sf)).select("sample_id", "query_type", *recall.GRADES, "skip")


def _diff_sides(spark, sf):
    d = tables.texts(spark, sf).select("record_id", "lang", "source")
    actual = d.where("record_id % 50 <> 7").withColumn("lang", F.when(F.col("record_id") % 40 == 3, None).otherwise(F.col("lang"))).withColumn("source", F.when(F.col("record_id") % 60 == 3, "other").otherwise(F.col("source")))
    return d, actual.unionByName(d.where("record_id % 70 = 5").withColumn("record_id", -F.col("record_id")))


def state_differences(spark, sf):
    return audit.differences(*_diff_sides(spark, sf), ["record_id"])


QUERIES = {f.__name__: f for f in (bm25_stored, bm25_stored_and, bm25_merged_deltas, phrase_stored, text_index_state, ivf_stored, ivf_stored_live, ivf_bypass, ivf_stored_recall, recall_samples, state_differences)}

_NEAR = f"""near AS (SELECT query_id, pid FROM (SELECT q.query_id, c.pid, {R._DIST['l2'].format('c.centroid', 'q.vector')} AS dd FROM q, c) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY dd, pid) <= {PROBES})"""


def _ivf_sql(where: str = "true") -> str:
    return f"""SELECT query_id, record_id, round(dd, 9) AS distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dd, record_id) AS rank FROM
  (SELECT q.query_id, v.record_id, {R._DIST['l2'].format('v.vector', 'q.vector')} AS dd FROM near JOIN q USING (query_id) JOIN pl USING (pid) JOIN v ON v.record_id = pl.record_id WHERE {where})) WHERE rank <= 5"""


_SERVED = f""",, vl AS ({R._knn_sql('l2', 5)}), tl AS ({R._top(R._bm25_sql(), 5)}), hl AS ({R._top(R._RRF, 5, 12)}),
truth AS (SELECT query_id * 10 + 0 AS sample_id, 'vector' AS query_type, list(record_id ORDER BY rank) AS t FROM vl GROUP BY query_id UNION ALL SELECT query_id * 10 + 1, 'text', list(record_id ORDER BY rank) FROM tl GROUP BY query_id
  UNION ALL SELECT query_id * 10 + 2, 'hybrid', list(record_id ORDER BY rank) FROM hl GROUP BY query_id),
served AS (SELECT query_id * 10 + 0 AS sample_id, list(record_id ORDER BY rank) AS got FROM ({R._knn_sql('l2', 5, 'v.record_id % 4 <> 1')}) GROUP BY query_id UNION ALL SELECT query_id * 10 + 1, list(record_id ORDER BY rank DESC) FROM tl GROUP BY query_id
  UNION ALL SELECT query_id * 10 + 2, list(record_id ORDER BY rank) FROM vl GROUP BY query_id)"""
ORACLES = {
    "bm25_stored": R.ORACLES["bm25_or"],
    "bm25_stored_and": R.ORACLES["bm25_and"],
    "bm25_merged_deltas": R.ORACLES["bm25_or"],
    "phrase_stored": R.ORACLES["phrase_slop"],
    "text_index_state": sql("SELECT count(*) AS n, CAST(sum(len(toks)) AS BIGINT) AS tokens, CAST(6 AS BIGINT) AS files, CAST(0 AS BIGINT) AS deltas FROM toks", "toks"),
    "ivf_stored": sql(f",, pl AS ({R._PLACED}), {_NEAR} {_ivf_sql()}", "v", "q", "c"),
    "ivf_stored_live": sql(f",, pl AS ({R._PLACED}), {_NEAR} {_ivf_sql('NOT v.is_deleted AND v.label <= 4')}", "v", "q", "c"),
    "ivf_bypass": R.ORACLES["knn_l2"],
    "ivf_stored_recall": sql(f",, pl AS ({R._PLACED}), {_NEAR}, g AS ({_ivf_sql()}), e AS ({R._knn_sql('l2')}) SELECT round(avg(found), 9) AS recall FROM (SELECT count(g.record_id) / count(*) AS found FROM e LEFT JOIN g USING (query_id, record_id) GROUP BY e.query_id)", "v", "q", "c"),
    "recall_samples": sql(_SERVED + """, graded AS (SELECT sample_id, query_type, len(list_intersect(t, got)) / least(5, len(t)) AS recall,
  list_sum(list_transform(range(1, len(got) + 1), lambda i: CASE WHEN list_position(t, got[i]) > 0 THEN len(t) - list_position(t, got[i]) + 1 ELSE 0 END / log2(i + 1))) / list_sum(list_transform(range(1, len(t) + 1), lambda i: (len(t) - i + 1) / log2(i + 1))) AS ndcg,
  CASE WHEN list_position(got, t[1]) > 0 THEN 1.0::DOUBLE / list_position(got, t[1]) ELSE 0 END AS mrr FROM truth JOIN served USING (sample_id))
SELECT sample_id, query_type, round(recall, 9) AS recall, round(ndcg, 9) AS ndcg, round(mrr, 9) AS mrr, NULL AS skip FROM graded
UNION ALL SELECT query_id * 10 + x, kind, NULL, NULL, NULL, why FROM q, (VALUES (5, 'vector', 'null_result_ids'), (6, 'vector', 'missing_vector'), (7, 'hybrid', 'fusion_replay')) AS y(x, kind, why)""", *R._LEG_VIEWS),
    "state_differences": sql("""SELECT record_id, CASE WHEN record_id % 50 = 7 THEN 'missing' ELSE 'changed' END AS problem,
  CASE WHEN record_id % 50 <> 7 THEN array_to_string(list_filter([CASE WHEN record_id % 40 = 3 AND lang IS NOT NULL THEN 'lang' END, CASE WHEN record_id % 60 = 3 AND source IS DISTINCT FROM 'other' THEN 'source' END], lambda z: z IS NOT NULL), ',') END AS columns
  FROM d WHERE record_id % 50 = 7 OR (record_id % 40 = 3 AND lang IS NOT NULL) OR (record_id % 60 = 3 AND source IS DISTINCT FROM 'other')
UNION ALL SELECT -record_id, 'unexpected', NULL FROM d WHERE record_id % 70 = 5 AND record_id <> 0""", "d"),
}
