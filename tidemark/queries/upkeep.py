"""Queries over maintenance operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import maintenance
from tidemark.queries import cdc as Q
from tidemark.queries.retrieval import _PLACED
from tidemark.sources import samples, tables
from tidemark.sources.tables import sql

def streamed_source_digest(spark, sf):
    """The streamed digest of every route."""
    columns = ("tenant_id", "namespace", "org_id")
    rows = Q.cdc.latest(Q._terminal(spark, sf), Q.KEYS)
    out = []
    for route in rows.select(*columns).distinct().orderBy(*columns).collect():  # a row a route
        own = rows
        for c in columns:
            own = own.where(F.col(c).eqNullSafe(route[c]))
        out.append((*route, maintenance.streamed_source_digest(own, "record_id", "source_sequence", "event_digest", 4)))
    return spark.createDataFrame(out, "tenant_id string, namespace string, org_id string, digest string")


def clustered_layout(spark, sf):
    rows = maintenance.clustered(tables.vectors(spark, sf), tables.centroids(spark, sf), 60)
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("pid").alias("first"), F.max("pid").alias("last"), F.max("salt").alias("salt"))


def trained_partitions(spark, sf):
    v = tables.vectors(spark, sf)
    return maintenance.search.nearest_centroid(v, maintenance.train_centroids(v, 8)).groupBy("pid").agg(F.count("*").alias("n"))


def captured_samples(spark, sf):
    hits = maintenance.search.knn(tables.vectors(spark, sf), tables.vector_queries(spark, sf), 3, "l2").withColumn("distance", F.round("distance", 9))
    kept = samples.capture(hits, 3)
    return kept.select("query_id", "k", F.array_join(F.transform("result_ids", lambda x: x.cast("string")), ",").alias("ids"))


def sample_reasons(spark, sf):
    e = tables.table(spark, sf, "events").select(F.to_json(F.struct(
        F.when(F.col("event_id") % 50 != 1, F.col("event_id").cast("string")).alias("sample_id"), (F.col("event_id") % 10).cast("int").alias("k"),
        F.when(F.col("event_id") % 3 != 0, F.array(F.lit(1.0))).alias("query_vector"), F.when(F.col("event_id") % 4 == 0, "text").when(F.col("event_id") % 40 == 1, "graph").otherwise("vector").alias("query_type"),
    )).alias("attributes"))
    return samples.reasons(samples.parse(e))


QUERIES = {f.__name__: f for f in (streamed_source_digest, clustered_layout, trained_partitions, captured_samples, sample_reasons)}
_KNN = "list_sum(list_transform(list_zip(v.vector, q.vector), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
ORACLES = {
    "captured_samples": sql(f"SELECT query_id, 3 AS k, string_agg(CAST(record_id AS VARCHAR), ',' ORDER BY d, record_id) AS ids FROM (SELECT q.query_id, v.record_id, {_KNN} AS d FROM v, q QUALIFY row_number() OVER (PARTITION BY q.query_id ORDER BY d, v.record_id) <= 3) GROUP BY query_id", "v", "q"),
    "sample_reasons": """SELECT CASE WHEN event_id % 50 = 1 THEN 'unparsable' WHEN event_id % 10 < 1 THEN 'bad_k' WHEN event_id % 4 <> 0 AND event_id % 40 = 1 THEN 'unknown_type'
  WHEN event_id % 4 <> 0 AND event_id % 3 = 0 THEN 'missing_vector' ELSE 'ok' END AS reason, count(*) AS n FROM events GROUP BY 1""",
}
ORACLES["clustered_layout"] = sql(f""",, pl AS ({_PLACED}), h AS (SELECT r.pid, count(pl.record_id) AS n FROM (SELECT unnest(range(0, (SELECT max(pid) + 1 FROM pl))) AS pid) r LEFT JOIN pl USING (pid) GROUP BY r.pid),
st AS (SELECT CAST(-1 AS BIGINT) AS pid, CAST(0 AS BIGINT) AS made, false AS open, CAST(0 AS BIGINT) AS size, CAST(0 AS BIGINT) AS first, CAST(1 AS BIGINT) AS salts
  UNION ALL SELECT h.pid, CASE WHEN n > 60 THEN made + CAST(ceil(n / 60) AS BIGINT) WHEN n = 0 AND NOT open THEN made WHEN open AND size + n <= 60 THEN made ELSE made + 1 END, n <= 60 AND (n > 0 OR open), CASE WHEN n > 60 THEN 0 WHEN open AND size + n <= 60 THEN size + n ELSE n END,
  CASE WHEN n <= 60 AND open AND size + n <= 60 THEN made - 1 ELSE made END, CASE WHEN n > 60 THEN CAST(ceil(n / 60) AS BIGINT) ELSE 1 END FROM st JOIN h ON h.pid = st.pid + 1),
x AS (SELECT pl.pid, CAST(CAST('0x' || substr(sha256(CAST(record_id AS VARCHAR)), 1, 8) AS BIGINT) % salts AS INTEGER) AS salt, first FROM pl JOIN st USING (pid))
SELECT CAST(first + salt AS INTEGER) AS bucket, count(*) AS n, min(pid) AS first, max(pid) AS last, max(salt) AS salt FROM x GROUP BY 1""", "v", "c", recursive=True)
ORACLES["streamed_source_digest"] = sql(Q._T + Q._L + f" SELECT tenant_id, namespace, org_id, sha256(unhex('{Q.D.SOURCE_HEADER.encode().hex().upper()}' || string_agg({Q._TEXT.format('record_id')} || printf('%016X', source_sequence) || upper(event_digest), '' ORDER BY record_id))) AS digest FROM l GROUP BY tenant_id, namespace, org_id", "m")
