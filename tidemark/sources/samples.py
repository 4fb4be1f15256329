"""Captured search samples: parsing with reasons, time windows, replay of a capture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "sample_id string, captured_at_unix_ms long, org_id string, tenant_id string, namespace string, dataset_version long, k int, "
    "query_vector array<double>, result_ids array<long>, result_distances array<double>, query_type string, nprobes_min int, nprobes_max int, refine_factor int"
)
TYPES = ("vector", "text", "hybrid")


def parse(records: DataFrame, column: str = "attributes") -> DataFrame:
    """Columns of SCHEMA and ``reason``: why a record can't be graded, null where it can."""
    s = F.from_json(column, SCHEMA)
    rows = records.withColumn("s", s)
    reason = (
        F.when(F.col("s").isNull() | F.col("s.sample_id").isNull(), "unparsable")
        .when(F.col("s.k").isNull() | (F.col("s.k") < 1), "bad_k")
        .when(F.coalesce("s.query_type", F.lit("vector")).isin(*TYPES), None)
        .otherwise("unknown_type")
    )
    reason = F.coalesce(reason, F.when(F.coalesce("s.query_type", F.lit("vector")).isin("vector", "hybrid") & F.col("s.query_vector").isNull(), "missing_vector"))
    reason = F.coalesce(reason, F.when(F.size("s.result_ids") > F.col("s.k"), "too_many_results"))
    return rows.select("s.*", reason.alias("reason"))


def reasons(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


def between(parsed: DataFrame, start_ms: int, end_ms: int, most: int) -> DataFrame:
    """The first ``most`` samples of a time window, in order of time."""
    inside = parsed.where((F.col("captured_at_unix_ms") >= start_ms) & (F.col("captured_at_unix_ms") < end_ms))
    return inside.orderBy("captured_at_unix_ms", "sample_id").limit(most)


def capture(hits: DataFrame, k: int) -> DataFrame:
    """Served hits (query_id, record_id, distance, rank) as one record a query."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "record_id", "distance")))
    rows = hits.groupBy("query_id").agg(ordered.alias("h"))
    return rows.select("query_id", F.lit(k).alias("k"), F.transform("h", lambda x: x["record_id"]).alias("result_ids"), F.transform("h", lambda x: x["distance"]).alias("result_distances"))
