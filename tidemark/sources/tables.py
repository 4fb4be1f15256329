"""The test tables as the engine's domain: mutations, vectors, texts, control tables.

Each view has a SQL twin in ``VIEWS``, a list of common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.digest import micros

#: event type -> operation as it is written in the stream.
OPERATIONS = {"signup": "insert", "view": "update", "click": "update", "purchase": "upsert", "error": "delete"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a mutation stream: route, record, op, time, sequence, day window and payload."""
    e = table(spark, sf_dir, "events")
    op = F.lit("update")
    for kind, name in OPERATIONS.items():
        op = F.when(F.col("event_type") == kind, name).otherwise(op)
    return e.select(
        F.concat(F.lit("t"), F.col("user_id") % 2).alias("tenant_id"),
        F.concat(F.lit("n"), F.col("user_id") % 4).alias("namespace"),
        F.concat(F.lit("o"), F.col("user_id") % 8).alias("org_id"),
        F.col("user_id").cast("string").alias("record_id"),
        op.alias("op"),
        "ts",
        micros("ts").alias("ts_us"),
        F.col("event_id").alias("source_sequence"),
        F.expr("datediff(cast(ts as date), date'2024-01-01')").cast("long").alias("window_seq"),
        F.col("event_type").alias("kind"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("value").alias("amount"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("record_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("long").alias("label"), ((F.col("vec_id") % 7) == 3).alias("is_deleted"))


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query set, which grows with the table: the vectors whose ids are divisible by 100."""
    return vectors(spark, sf_dir).where(F.col("record_id") % 100 == 0).select(F.col("record_id").alias("query_id"), "vector")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One a label: the vector with the smallest id."""
    v = vectors(spark, sf_dir)
    return v.groupBy("label").agg(F.min_by("vector", "record_id").alias("centroid")).select(F.col("label").alias("pid"), "centroid")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text", "lang", "source", "n_chars", ((F.col("doc_id") % 11) == 5).alias("is_deleted"))


#: Query terms, which the queries take in turn.
TERM_SETS = (("the", "of", "thing"), ("license", "under"), ("que", "der", "license"))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, term) of the whole query set."""
    sets = F.array(*[F.array(*[F.lit(t) for t in own]) for own in TERM_SETS])
    turn = F.pmod(F.floor(F.col("query_id") / 100), F.lit(len(TERM_SETS))).cast("int")
    return vector_queries(spark, sf_dir).select("query_id", F.explode(F.element_at(sets, turn + 1)).alias("term"))


def work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a work queue."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("long").alias("work_id"),
        F.col("o_custkey").cast("long").alias("dataset_id"),
        (F.col("o_custkey") % 25).cast("long").alias("source_id"),
        F.when(k % 5 != 0, (k % 97).cast("long")).alias("source_seq"),
        F.when(k % 3 == 0, "PUBLISH").when(k % 13 == 1, "REBUILD").otherwise("INGEST").alias("kind"),
        F.when(k % 4 == 0, "SUCCEEDED").when(k % 17 == 2, "RUNNING").when(k % 29 == 3, "BLOCKED").when(k % 7 == 1, "RETRY").otherwise("PENDING").alias("state"),
        (k % 1000).cast("long").alias("due_at"),
        (k % 5000).cast("long").alias("created_at"),
        F.when(k % 17 == 2, (k % 800).cast("long")).alias("lease_until"),
        F.when(k % 6 != 0, (k % 3).cast("long")).alias("expected_version"),
        F.when(k % 9 != 0, (F.col("o_custkey") * 10 + k % 2).cast("long")).alias("expected_publication_id"),
    )


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as datasets."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("long").alias("dataset_id"),
        F.when(k % 10 == 0, "RETIRED").otherwise("ACTIVE").alias("lifecycle"),
        (k % 3).cast("long").alias("version"),
        F.when(k % 8 != 0, (k * 10).cast("long")).alias("active_publication_id"),
        F.concat(F.lit("store/"), k.cast("string")).alias("uri"),
    )


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten a dataset, by number; all but the first are retired."""
    d = datasets(spark, sf_dir).select("dataset_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"))
    return d.select(
        (F.col("dataset_id") * 10 + F.col("i")).alias("publication_id"),
        "dataset_id",
        (F.col("dataset_id") % 3).alias("spec_id"),
        (1000 - F.col("i") * 100 + F.col("dataset_id") % 50).cast("long").alias("published_at"),
        F.when(F.col("i") > 0, 1000 + F.col("i") * 37 + F.col("dataset_id") % 11).cast("long").alias("retired_at"),
        F.col("i").cast("long").alias("version"),
        (50 + F.col("i") + F.col("dataset_id") % 7).cast("long").alias("source_seq"),
    )


def specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, 1, 50), (1, 2, 100), (2, 3, 400)], "spec_id long, keep long, retention long")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as source snapshots: chains of ten, some with a wrong parent or sequence."""
    k = F.col("s_suppkey").cast("long")
    return table(spark, sf_dir, "supplier").select(
        F.floor(k / 10).alias("chain"),
        (k % 10).alias("position"),
        k.alias("snapshot_id"),
        F.when(k % 10 == 0, F.lit(None)).when(k % 23 == 5, k - 2).otherwise(k - 1).cast("long").alias("parent_id"),
        (k * 2 - F.when(k % 31 == 7, 5).otherwise(0)).alias("sequence"),
        (k % 25).alias("source_id"),
        F.when(k % 19 == 4, "BLOCKED").when(k % 3 == 0, "COMPLETE").otherwise("OPEN").alias("state"),
    )


def snapshot_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as snapshot metadata: operation, summary, table and partition spec."""
    k = F.col("s_suppkey").cast("long")
    op = F.when(k % 9 == 2, " Fast-Append ").when(k % 16 == 5, "overwrite").when(k % 21 == 8, "delete").when(k % 37 == 9, "merge").otherwise("append")
    files = F.when(k % 27 == 4, "many").otherwise((k % 4).cast("string"))
    return table(spark, sf_dir, "supplier").select(
        k.alias("snapshot_id"),
        op.alias("operation"),
        F.when(k % 6 != 0, F.create_map(F.lit("added-data-files"), files)).alias("summary"),
        F.when(k % 33 == 12, "other").otherwise("main").alias("table_uuid"),
        F.when(k % 26 == 3, 2).otherwise(1).cast("long").alias("spec_id"),
    )


def index_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as datasets with three index targets each, in all states."""
    k, i = F.col("dataset_id"), F.col("i")
    rows = datasets(spark, sf_dir).select("dataset_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
    exists = (k + i) % 5 != 0
    return rows.select(
        "dataset_id",
        F.element_at(F.array(F.lit("vector_ivf"), F.lit("cluster_btree"), F.lit("text_inverted")), i + 1).alias("name"),
        F.element_at(F.array(F.lit("IVF"), F.lit("BTREE"), F.lit("INVERTED")), i + 1).alias("kind"),
        F.element_at(F.array(F.lit("vector"), F.lit("cluster"), F.lit("text")), i + 1).alias("column"),
        (k % 40 * 50).alias("rows"),
        F.when(k % 31 == 7, 0).otherwise(k % 90 + 1).cast("long").alias("files"),
        exists.alias("exists"),
        F.when((k + i) % 4 == 1, k % 70).otherwise(0).cast("long").alias("uncovered"),
        F.when(k % 9 == 4, 6).otherwise(1).cast("long").alias("deltas"),
        F.when(exists, k % 11 * 40).cast("long").alias("rows_at_training"),
        (k % 8 != 3).alias("reusable"),
        F.when(exists, F.element_at(F.array(F.lit("ivf_rq"), F.lit("BTREE"), F.lit("Inverted")), i + 1)).alias("actual_kind"),
        F.when(k % 17 == 2, "other").otherwise(F.element_at(F.array(F.lit("vector"), F.lit("cluster"), F.lit("text")), i + 1)).alias("actual_column"),
        F.when(k % 13 != 5, F.concat(F.lit("g"), k.cast("string"))).alias("generation"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as candidates with their counts."""
    k = F.col("dataset_id")
    return datasets(spark, sf_dir).select(
        "dataset_id",
        F.when(k % 14 == 6, "s2").otherwise("s1").alias("schema_digest"),
        F.lit("s1").alias("declared_digest"),
        (k % 100 + F.when(k % 12 == 1, 1).otherwise(0)).alias("stored_rows"),
        (k % 100).alias("total"),
        (k % 100 - F.when(k % 15 == 4, 1).otherwise(0)).alias("distinct_keys"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as manifest entries of snapshots."""
    k = F.col("l_orderkey").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        (k % 500).alias("snapshot_id"),
        F.when((k % 500) % 11 == 3, F.when(F.col("l_linenumber") % 2 == 0, "DELETED").otherwise("ADDED")).when((k % 500) % 13 == 6, "EXISTING").otherwise("ADDED").alias("status"),
        F.when((k % 500) % 17 == 2, "DELETES").otherwise("DATA").alias("content"),
        F.concat(F.lit("t"), F.col("l_suppkey") % 3).alias("tenant_id"),
        F.concat(F.lit("o"), F.col("l_suppkey") % 5).alias("org_id"),
        ((k % 500) % 4 + F.when((k % 500) % 29 == 1, F.col("l_linenumber") % 2).otherwise(0)).cast("long").alias("spec_id"),
        (k * 10 + F.col("l_linenumber")).cast("long").alias("file_id"),
        ((k % 500) + F.when((k % 500) % 41 == 7, 1).otherwise(0)).alias("added_by"),
    )


_V = "CAST(embedding AS DOUBLE[])"
VIEWS = {
    "m": """SELECT 't' || (user_id % 2) AS tenant_id, 'n' || (user_id % 4) AS namespace, 'o' || (user_id % 8) AS org_id, CAST(user_id AS VARCHAR) AS record_id,
  CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'upsert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
  ts, epoch_us(ts) AS ts_us, event_id AS source_sequence, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS window_seq, event_type AS kind, strftime(ts, '%Y-%m-%d') AS day, value AS amount FROM events""",
    "v": f"SELECT vec_id AS record_id, {_V} AS vector, CAST(label AS BIGINT) AS label, vec_id % 7 = 3 AS is_deleted FROM embeddings",
    "q": f"SELECT vec_id AS query_id, {_V} AS vector FROM embeddings WHERE vec_id % 100 = 0",
    "c": f"SELECT CAST(label AS BIGINT) AS pid, min_by({_V}, vec_id) AS centroid FROM embeddings GROUP BY label",
    "d": "SELECT doc_id AS record_id, text, lang, source, n_chars, doc_id % 11 = 5 AS is_deleted FROM documents",
    "toks": r"SELECT doc_id AS record_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}_]+') AS toks FROM documents",
    "terms": "SELECT CAST(vec_id AS BIGINT) AS query_id, unnest(" + str([list(t) for t in TERM_SETS]) + f"[1 + vec_id // 100 % {len(TERM_SETS)}]) AS term FROM embeddings WHERE vec_id % 100 = 0",
    "w": """SELECT CAST(o_orderkey AS BIGINT) AS work_id, CAST(o_custkey AS BIGINT) AS dataset_id, CAST(o_custkey % 25 AS BIGINT) AS source_id,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 97 AS BIGINT) END AS source_seq,
  CASE WHEN o_orderkey % 3 = 0 THEN 'PUBLISH' WHEN o_orderkey % 13 = 1 THEN 'REBUILD' ELSE 'INGEST' END AS kind,
  CASE WHEN o_orderkey % 4 = 0 THEN 'SUCCEEDED' WHEN o_orderkey % 17 = 2 THEN 'RUNNING' WHEN o_orderkey % 29 = 3 THEN 'BLOCKED' WHEN o_orderkey % 7 = 1 THEN 'RETRY' ELSE 'PENDING' END AS state,
  CAST(o_orderkey % 1000 AS BIGINT) AS due_at, CAST(o_orderkey % 5000 AS BIGINT) AS created_at, CASE WHEN o_orderkey % 17 = 2 THEN CAST(o_orderkey % 800 AS BIGINT) END AS lease_until,
  CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey % 3 AS BIGINT) END AS expected_version,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_custkey * 10 + o_orderkey % 2 AS BIGINT) END AS expected_publication_id FROM orders""",
    "ds": """SELECT CAST(c_custkey AS BIGINT) AS dataset_id, CASE WHEN c_custkey % 10 = 0 THEN 'RETIRED' ELSE 'ACTIVE' END AS lifecycle, CAST(c_custkey % 3 AS BIGINT) AS version,
  CASE WHEN c_custkey % 8 <> 0 THEN CAST(c_custkey * 10 AS BIGINT) END AS active_publication_id, 'store/' || c_custkey AS uri FROM customer""",
    "p": """SELECT dataset_id * 10 + i AS publication_id, dataset_id, dataset_id % 3 AS spec_id, 1000 - i * 100 + dataset_id % 50 AS published_at,
  CASE WHEN i > 0 THEN 1000 + i * 37 + dataset_id % 11 END AS retired_at, i AS version, 50 + i + dataset_id % 7 AS source_seq
  FROM (SELECT CAST(c_custkey AS BIGINT) AS dataset_id, unnest(range(0, 5)) AS i FROM customer)""",
    "sp": "SELECT * FROM (VALUES (0, 1, 50), (1, 2, 100), (2, 3, 400)) AS t(spec_id, keep, retention)",
    "s": """SELECT s_suppkey // 10 AS chain, s_suppkey % 10 AS position, CAST(s_suppkey AS BIGINT) AS snapshot_id,
  CAST(CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 23 = 5 THEN s_suppkey - 2 ELSE s_suppkey - 1 END AS BIGINT) AS parent_id,
  CAST(s_suppkey * 2 - CASE WHEN s_suppkey % 31 = 7 THEN 5 ELSE 0 END AS BIGINT) AS sequence, CAST(s_suppkey % 25 AS BIGINT) AS source_id,
  CASE WHEN s_suppkey % 19 = 4 THEN 'BLOCKED' WHEN s_suppkey % 3 = 0 THEN 'COMPLETE' ELSE 'OPEN' END AS state FROM supplier""",
    "mf": """SELECT CAST(l_orderkey % 500 AS BIGINT) AS snapshot_id,
  CASE WHEN (l_orderkey % 500) % 11 = 3 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'DELETED' ELSE 'ADDED' END WHEN (l_orderkey % 500) % 13 = 6 THEN 'EXISTING' ELSE 'ADDED' END AS status,
  CASE WHEN (l_orderkey % 500) % 17 = 2 THEN 'DELETES' ELSE 'DATA' END AS content, 't' || (l_suppkey % 3) AS tenant_id, 'o' || (l_suppkey % 5) AS org_id,
  CAST((l_orderkey % 500) % 4 + CASE WHEN (l_orderkey % 500) % 29 = 1 THEN l_linenumber % 2 ELSE 0 END AS BIGINT) AS spec_id, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS file_id,
  CAST(l_orderkey % 500 + CASE WHEN (l_orderkey % 500) % 41 = 7 THEN 1 ELSE 0 END AS BIGINT) AS added_by FROM lineitem""",
    "sm": """SELECT CAST(s_suppkey AS BIGINT) AS snapshot_id, CASE WHEN s_suppkey % 9 = 2 THEN ' Fast-Append ' WHEN s_suppkey % 16 = 5 THEN 'overwrite' WHEN s_suppkey % 21 = 8 THEN 'delete' WHEN s_suppkey % 37 = 9 THEN 'merge' ELSE 'append' END AS operation,
  CASE WHEN s_suppkey % 6 <> 0 THEN CASE WHEN s_suppkey % 27 = 4 THEN 'many' ELSE CAST(s_suppkey % 4 AS VARCHAR) END ELSE '0' END AS added_files,
  CASE WHEN s_suppkey % 33 = 12 THEN 'other' ELSE 'main' END AS table_uuid, CAST(CASE WHEN s_suppkey % 26 = 3 THEN 2 ELSE 1 END AS BIGINT) AS spec_id FROM supplier""",
    "it": """SELECT k AS dataset_id, ['vector_ivf', 'cluster_btree', 'text_inverted'][i + 1] AS name, ['IVF', 'BTREE', 'INVERTED'][i + 1] AS kind, ['vector', 'cluster', 'text'][i + 1] AS wanted_column, k % 40 * 50 AS rows,
  CASE WHEN k % 31 = 7 THEN 0 ELSE k % 90 + 1 END AS files, (k + i) % 5 <> 0 AS exists, CASE WHEN (k + i) % 4 = 1 THEN k % 70 ELSE 0 END AS uncovered, CASE WHEN k % 9 = 4 THEN 6 ELSE 1 END AS deltas,
  CASE WHEN (k + i) % 5 <> 0 THEN k % 11 * 40 END AS rows_at_training, k % 8 <> 3 AS reusable, CASE WHEN (k + i) % 5 <> 0 THEN ['IVF', 'BTREE', 'INVERTED'][i + 1] END AS actual_kind,
  CASE WHEN k % 17 = 2 THEN 'other' ELSE ['vector', 'cluster', 'text'][i + 1] END AS actual_column, CASE WHEN k % 13 <> 5 THEN 'g' || k END AS generation
  FROM (SELECT CAST(c_custkey AS BIGINT) AS k, unnest(range(0, 3)) AS i FROM customer)""",
    "ca": """SELECT CAST(c_custkey AS BIGINT) AS dataset_id, CASE WHEN c_custkey % 14 = 6 THEN 's2' ELSE 's1' END AS schema_digest, 's1' AS declared_digest, c_custkey % 100 + CASE WHEN c_custkey % 12 = 1 THEN 1 ELSE 0 END AS stored_rows,
  c_custkey % 100 AS total, c_custkey % 100 - CASE WHEN c_custkey % 15 = 4 THEN 1 ELSE 0 END AS distinct_keys FROM customer""",
}


def sql(body: str, *views: str, recursive: bool = False) -> str:
    """A query over the named views."""
    heads = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views)
    return f"WITH {'RECURSIVE ' if recursive else ''}{heads}{',' if body.lstrip().startswith(',,') else ''}\n{body.lstrip().removeprefix(',,')}" if heads else body
