"""Queries over lineage, work queue, publications and layout."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import layout, lineage, qualification, queue
from tidemark.sources import scans, tables
from tidemark.sources.tables import sql

NOW = 1200


def lineage_check(spark, sf):
    return lineage.violations(tables.snapshots(spark, sf))


def snapshot_classify(spark, sf):
    return lineage.classify(tables.snapshot_meta(spark, sf), tables.manifest(spark, sf))


def snapshot_identity(spark, sf):
    return lineage.changed_identity(tables.snapshot_meta(spark, sf), "main", 1)


def added_targets(spark, sf):
    return lineage.targets(tables.manifest(spark, sf), ["tenant_id", "org_id"])


def baseline_targets(spark, sf):
    return lineage.targets(tables.manifest(spark, sf), ["tenant_id", "org_id"], "EXISTING")


def incremental_plan(spark, sf):
    rows = snapshot_classify(spark, sf).join(tables.snapshots(spark, sf).select("chain", "snapshot_id", "sequence"), "snapshot_id")
    return lineage.accepted_prefix(rows)


def partition_spec_ids(spark, sf):
    return lineage.spec_ids(tables.manifest(spark, sf))


def conflicting_snapshots(spark, sf):
    s = tables.snapshots(spark, sf).select("snapshot_id", "parent_id", "sequence")
    return lineage.conflicting_metadata(s.unionByName(s.where("snapshot_id % 7 = 1").withColumn("sequence", F.col("sequence") + 1)).unionByName(s.where("snapshot_id % 5 = 1")))


def claim_order(spark, sf):
    return queue.claimable(tables.work(spark, sf), tables.snapshots(spark, sf), 500, 200).select("work_id", "dataset_id", "source_seq", "kind", "state")


def anti_join_lane(spark, sf):
    return queue.lane_open(tables.work(spark, sf)).groupBy("state", "kind").agg(F.count("*").alias("n"))


def source_gate(spark, sf):
    return queue.without_blocked_source(tables.work(spark, sf), tables.snapshots(spark, sf)).groupBy("kind").agg(F.count("*").alias("n"))


def expired_leases(spark, sf):
    return queue.expired_leases(tables.work(spark, sf), 400).groupBy("state").agg(F.count("*").alias("n"), F.count("lease_until").alias("leases"))


def stale_work(spark, sf):
    return queue.stale(tables.work(spark, sf), tables.datasets(spark, sf)).select("work_id")


def completed_snapshots(spark, sf):
    return queue.completed_snapshots(tables.work(spark, sf))


def _status(spark, sf):
    return queue.status(tables.work(spark, sf), tables.snapshots(spark, sf), tables.publications(spark, sf), 500)


def queue_status(spark, sf):
    return _status(spark, sf)


def health_rules(spark, sf):
    return queue.health(_status(spark, sf), 6000, 100, 7000).select("reasons", "healthy")


def retention_floor(spark, sf):
    return queue.retention_floor(tables.work(spark, sf), tables.snapshots(spark, sf), tables.publications(spark, sf))


def publication_cleanup(spark, sf):
    return queue.publication_cleanup(tables.publications(spark, sf), tables.datasets(spark, sf), tables.specs(spark), NOW, 100)


def serving_routes(spark, sf):
    return queue.serving_routes(tables.datasets(spark, sf), tables.publications(spark, sf))


def ambiguous_routes(spark, sf):
    """Datasets joined with publications and specs: routes that more than one row answers, and those that one does."""
    d = tables.datasets(spark, sf).withColumn("route", F.concat(F.lit("r"), (F.col("dataset_id") % 1000).cast("string")))
    return queue.resolved_routes(d, tables.publications(spark, sf), tables.specs(spark))


def claim_with_datasets(spark, sf):
    return queue.claimable_datasets(tables.work(spark, sf), tables.snapshots(spark, sf), tables.datasets(spark, sf), 500, 200).select("work_id", "dataset_id", "uri")


def retention_decision(spark, sf):
    status = retention_floor(spark, sf).select("floor", F.lit(None).cast("long").alias("parent_snapshot_id"), F.lit(7).cast("long").alias("snapshot_id"))
    return qualification.retention_decision(status)


def qualification_gate(spark, sf):
    t = tables.index_targets(spark, sf)
    gaps = qualification.index_gaps(t.select("dataset_id", "name", "kind", "column"), t.where("exists").select("dataset_id", "name", "actual_kind", "actual_column", "uncovered", "generation"))
    return qualification.gate(tables.candidates(spark, sf), gaps)


def index_plan(spark, sf):
    return qualification.index_plan(tables.index_targets(spark, sf))


def index_plan_rebuild(spark, sf):
    return qualification.index_plan(tables.index_targets(spark, sf), rebuild=True).groupBy("name", "mode").agg(F.count("*").alias("n"), F.sum("shards").alias("shards"))


def even_split(spark, sf):
    files = tables.manifest(spark, sf).select("file_id").distinct()
    return layout.even_split(files, 7, "file_id").groupBy("shard").agg(F.count("*").alias("n"), F.min("file_id").alias("first"), F.max("file_id").alias("last"))


def fragment_shards(spark, sf):
    """Files dealt in turn over seven shards."""
    w = Window.orderBy("file_id")
    files = tables.manifest(spark, sf).select("file_id").distinct().select((F.row_number().over(w) - 1).cast("long").alias("position"), "file_id")
    return scans.round_robin(files, 7).groupBy("shard").agg(F.count("*").alias("n"), F.min("file_id").alias("first"), F.sum("file_id").alias("ids"))


_stored: dict[tuple[str, str], str] = {}


def indexed_lookup(spark, sf):
    """A range of days, a state and some customers, over orders in files that are laid out for that."""
    from tidemark.queries.streams import _folder

    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        path = f"{_folder(spark)}/orders"
        layout.write_indexed(tables.table(spark, sf, "orders"), path, btree=("o_custkey",), bitmap=("o_orderstatus",), zonemap=("o_orderdate",))
        _stored[key] = path
    o = spark.read.parquet(_stored[key]).where("o_orderdate >= date'1995-01-01' and o_orderdate < date'1996-01-01' and o_orderstatus = 'O' and o_custkey in (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)")
    return o.select("o_orderkey", "o_custkey")


def cleanup_slots(spark, sf):
    active = layout.active_slot(1706572800, 6, 12)
    d = tables.datasets(spark, sf).select("dataset_id", layout.cleanup_slot(F.col("uri"), 12).alias("slot"))
    return d.withColumn("active", F.col("slot") == active)


def tag_pruning(spark, sf):
    tag = F.when(F.col("o_orderkey") % 10 == 0, "manual").otherwise(F.date_format(F.col("o_orderdate"), "yyyyMMdd'T'HHmmss'Z'"))
    tags = tables.table(spark, sf, "orders").select(F.col("o_custkey").cast("long").alias("dataset_id"), tag.alias("tag")).distinct()
    return layout.prunable_tags(tags, 3)


def index_build_merge(spark, sf):
    m = tables.manifest(spark, sf)
    shards = m.select(F.col("org_id").alias("index"), (F.col("snapshot_id") % 2 * (F.col("org_id") == "o1").cast("int")).alias("spec"), F.lit(1).alias("rows"), F.when((F.col("org_id") == "o3") & (F.col("status") == "DELETED"), "lost").alias("error"))
    return layout.merge_builds(shards)


def index_coverage(spark, sf):
    m = tables.manifest(spark, sf).where("status <> 'DELETED'").select("file_id", "snapshot_id")
    return layout.uncovered(m, m.where("file_id % 3 <> 0")).groupBy("snapshot_id").agg(F.count("*").alias("uncovered"))


def committable_segments(spark, sf):
    m = tables.manifest(spark, sf)
    return layout.committable(m.select(F.col("snapshot_id").alias("segment_id"), "file_id"), m.where("status <> 'DELETED'"))


QUERIES = {f.__name__: f for f in (lineage_check, snapshot_classify, added_targets, baseline_targets, incremental_plan, partition_spec_ids, conflicting_snapshots, claim_order, anti_join_lane, source_gate, expired_leases, stale_work, completed_snapshots, queue_status, health_rules, retention_floor, publication_cleanup, serving_routes, cleanup_slots, tag_pruning, index_build_merge, index_coverage, committable_segments, snapshot_identity, ambiguous_routes, claim_with_datasets, retention_decision, qualification_gate, index_plan, index_plan_rebuild, even_split, fragment_shards, indexed_lookup)}

_CLASSIFY = """SELECT sm.snapshot_id, CASE WHEN lower(trim(operation)) IN ('append', 'fast-append') THEN
    CASE WHEN try_cast(added_files AS BIGINT) IS NULL THEN 'MANIFEST_SUMMARY_INVALID' WHEN try_cast(added_files AS BIGINT) > 0 AND NOT coalesce(has_data, false) THEN 'MANIFEST_EVIDENCE_MISSING'
    WHEN coalesce(strange, false) THEN 'MANIFEST_SNAPSHOT_MISMATCH' WHEN coalesce(removes, false) THEN 'PHYSICAL_DELETE' WHEN coalesce(delete_file, false) THEN 'DELETE_FILE' ELSE 'APPEND' END
  WHEN lower(trim(operation)) IN ('replace', 'overwrite') THEN 'UNTRUSTED_REWRITE' WHEN lower(trim(operation)) IN ('delete', 'row_delta') THEN 'PHYSICAL_DELETE' ELSE 'UNKNOWN_OPERATION' END AS verdict
  FROM sm LEFT JOIN (SELECT snapshot_id, bool_or(status = 'ADDED' AND content = 'DATA') AS has_data, bool_or(status <> 'EXISTING' AND added_by <> snapshot_id) AS strange, bool_or(status = 'DELETED') AS removes,
    bool_or(status = 'ADDED' AND content <> 'DATA') AS delete_file FROM mf GROUP BY snapshot_id) m ON m.snapshot_id = sm.snapshot_id"""
_SEQ, _RANK = "coalesce({0}.source_seq, 9223372036854775807)", "CASE WHEN {0}.kind = 'INGEST' THEN 0 ELSE 1 END"
_PRECEDES = f"({_SEQ.format('e')} < {_SEQ.format('x')} OR ({_SEQ.format('e')} = {_SEQ.format('x')} AND {_RANK.format('e')} < {_RANK.format('x')}))"
_LANE = f"NOT EXISTS (SELECT 1 FROM w e WHERE e.dataset_id = x.dataset_id AND e.work_id <> x.work_id AND e.state <> 'SUCCEEDED' AND {_PRECEDES})"
_GATE = "(kind <> 'INGEST' OR NOT EXISTS (SELECT 1 FROM s WHERE s.source_id = x.source_id AND s.state = 'BLOCKED'))"
_ORDER = "source_seq NULLS LAST, CASE WHEN kind = 'INGEST' THEN 0 ELSE 1 END, created_at, work_id"
_FLOOR = "SELECT min(q) FROM (SELECT source_seq AS q FROM w WHERE state <> 'SUCCEEDED' AND source_seq IS NOT NULL UNION ALL SELECT sequence FROM s WHERE state <> 'COMPLETE' UNION ALL SELECT source_seq FROM p WHERE retired_at IS NULL)"
_STATUS = """SELECT count(*) FILTER (state = 'PENDING') AS pending, count(*) FILTER (state = 'RETRY') AS retry, count(*) FILTER (state = 'RUNNING') AS running, count(*) FILTER (state = 'BLOCKED') AS blocked,
  count(*) FILTER (state IN ('PENDING', 'RETRY') AND due_at <= 500) AS due, min(created_at) AS oldest_open, (SELECT count(*) FROM s WHERE state = 'BLOCKED') AS blocked_snapshots, (""" + _FLOOR + ") AS floor FROM w WHERE state <> 'SUCCEEDED'"

_CLAIM = f""",, x AS (SELECT * FROM w x WHERE state IN ('PENDING', 'RETRY') AND due_at <= 500 AND {_GATE} AND NOT EXISTS (SELECT 1 FROM w e WHERE e.dataset_id = x.dataset_id AND e.work_id <> x.work_id AND e.state <> 'SUCCEEDED' AND {_GATE.replace('x.source_id', 'e.source_id').replace('(kind', '(e.kind')} AND {_PRECEDES})),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY {_ORDER}) = 1)"""
_STALE = "kind = 'IVF' AND coalesce(rows > 4 * rows_at_training, false)"


def _plan_sql(rebuild: bool) -> str:
    r = "true" if rebuild else "false"
    return f""",, x AS (SELECT *, {r} OR (CASE WHEN NOT exists THEN kind <> 'IVF' OR rows >= 256 ELSE uncovered > 0 OR deltas > 4 OR ({_STALE}) END) AS needed FROM it),
y AS (SELECT *, bool_or(needed) OVER (PARTITION BY dataset_id) AS any_needed FROM x),
z AS (SELECT *, CASE WHEN kind = 'IVF' AND rows < 256 THEN 'below_floor' WHEN kind = 'IVF' AND ({r} OR NOT exists OR NOT reusable OR ({_STALE})) THEN 'bootstrap' WHEN kind = 'INVERTED' AND exists AND NOT {r} THEN 'maintain'
  WHEN files = 0 THEN 'done' WHEN kind = 'INVERTED' THEN 'rebuild' WHEN uncovered > 0 OR NOT exists OR {r} THEN 'segments' WHEN deltas > 4 THEN 'merge_deltas' ELSE 'done' END AS mode FROM y WHERE any_needed)
SELECT dataset_id, name, mode, CAST(CASE WHEN mode IN ('done', 'below_floor') THEN 0 WHEN mode = 'rebuild' THEN greatest(1, ceil(files / 32)) WHEN mode = 'segments' THEN greatest(1, ceil(CASE WHEN exists AND NOT {r} THEN uncovered ELSE files END / 32)) ELSE 1 END AS INTEGER) AS shards FROM z
UNION ALL SELECT DISTINCT dataset_id, NULL, 'skip', 0 FROM y WHERE NOT any_needed"""


ORACLES = {
    "lineage_check": sql(""",, x AS (SELECT *, lag(snapshot_id) OVER (PARTITION BY chain ORDER BY position) AS b, lag(sequence) OVER (PARTITION BY chain ORDER BY position) AS bs FROM s),
y AS (SELECT CAST(chain AS BIGINT) AS chain, snapshot_id, CASE WHEN b IS NOT NULL AND parent_id IS DISTINCT FROM b THEN 'fork' WHEN bs >= sequence THEN 'sequence' END AS problem FROM x)
SELECT * FROM y WHERE problem IS NOT NULL""", "s"),
    "snapshot_classify": sql(_CLASSIFY, "sm", "mf"),
    "snapshot_identity": sql("SELECT snapshot_id, CASE WHEN table_uuid <> 'main' THEN 'table_uuid' ELSE 'spec_id' END AS problem FROM sm WHERE table_uuid <> 'main' OR spec_id <> 1", "sm"),
    "added_targets": sql("SELECT DISTINCT tenant_id, org_id FROM mf WHERE status = 'ADDED'", "mf"),
    "baseline_targets": sql("SELECT DISTINCT tenant_id, org_id FROM mf WHERE status = 'EXISTING'", "mf"),
    "incremental_plan": sql(f""",, k AS ({_CLASSIFY}), x AS (SELECT CAST(chain AS BIGINT) AS chain, snapshot_id, sequence, verdict, sum(CASE WHEN verdict = 'APPEND' THEN 0 ELSE 1 END) OVER (PARTITION BY chain ORDER BY sequence) AS r FROM k JOIN s USING (snapshot_id))
SELECT chain, snapshot_id, sequence, verdict FROM x WHERE r = 0""", "sm", "mf", "s"),
    "partition_spec_ids": sql("SELECT snapshot_id, count(DISTINCT spec_id) AS n_specs, max(spec_id) AS spec_id FROM mf GROUP BY snapshot_id", "mf"),
    "conflicting_snapshots": sql("SELECT snapshot_id FROM s WHERE snapshot_id % 7 = 1", "s"),
    "claim_order": sql(f""",, x AS (SELECT * FROM w x WHERE state IN ('PENDING', 'RETRY') AND due_at <= 500 AND {_GATE} AND NOT EXISTS (SELECT 1 FROM w e WHERE e.dataset_id = x.dataset_id AND e.work_id <> x.work_id AND e.state <> 'SUCCEEDED' AND {_GATE.replace('x.source_id', 'e.source_id').replace('(kind', '(e.kind')} AND {_PRECEDES})),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY {_ORDER}) = 1)
SELECT work_id, dataset_id, source_seq, kind, state FROM y ORDER BY {_ORDER} LIMIT 200""", "w", "s"),
    "anti_join_lane": sql(f"SELECT state, kind, count(*) AS n FROM w x WHERE {_LANE} GROUP BY ALL", "w"),
    "source_gate": sql(f"SELECT kind, count(*) AS n FROM w x WHERE {_GATE} GROUP BY kind", "w", "s"),
    "expired_leases": sql("SELECT CASE WHEN state = 'RUNNING' AND lease_until <= 400 THEN 'RETRY' ELSE state END AS state, count(*) AS n, count(CASE WHEN NOT (state = 'RUNNING' AND lease_until <= 400) THEN lease_until END) AS leases FROM w GROUP BY 1", "w"),
    "stale_work": sql("SELECT work_id FROM w JOIN ds USING (dataset_id) WHERE kind <> 'INGEST' AND state <> 'SUCCEEDED' AND NOT (expected_version IS NOT DISTINCT FROM version AND expected_publication_id IS NOT DISTINCT FROM active_publication_id)", "w", "ds"),
    "completed_snapshots": sql("SELECT source_id, source_seq FROM w WHERE source_seq IS NOT NULL GROUP BY ALL HAVING bool_and(state = 'SUCCEEDED')", "w"),
    "queue_status": sql(_STATUS, "w", "s", "p"),
    "health_rules": sql(f""",, st AS ({_STATUS}), r AS (SELECT list_filter([CASE WHEN blocked > 0 THEN 'blocked_work' END, CASE WHEN blocked_snapshots > 0 THEN 'blocked_source_snapshot' END, CASE WHEN due > 100 THEN 'due_queue_over_budget' END, CASE WHEN 6000 - oldest_open > 7000 THEN 'open_work_age_over_budget' END], lambda z: z IS NOT NULL) AS l FROM st)
SELECT array_to_string(l, ',') AS reasons, len(l) = 0 AS healthy FROM r""", "w", "s", "p"),
    "ambiguous_routes": sql(""",, x AS (SELECT 'r' || (ds.dataset_id % 1000) AS route, ds.dataset_id, uri, p.version, keep FROM ds JOIN p ON publication_id = active_publication_id JOIN sp USING (spec_id) WHERE lifecycle = 'ACTIVE' AND retired_at IS NULL)
SELECT route, count(*) AS rows, CASE WHEN count(*) = 1 THEN min(dataset_id) END AS dataset_id, CASE WHEN count(*) > 1 THEN 'AMBIGUOUS_ROUTE' END AS problem FROM x GROUP BY route""", "ds", "p", "sp"),
    "claim_with_datasets": sql(_CLAIM + f", c AS (SELECT * FROM y ORDER BY {_ORDER} LIMIT 200) SELECT work_id, dataset_id, uri FROM c JOIN ds USING (dataset_id) WHERE lifecycle = 'ACTIVE'", "w", "s", "ds"),
    "retention_decision": sql(f",, f AS ({_FLOOR.replace('min(q)', 'min(q) AS floor')}) SELECT floor IS NOT NULL AS retain, floor, CASE WHEN floor IS NOT NULL THEN CAST(7 AS BIGINT) END AS retain_snapshot_id FROM f", "w", "s", "p"),
    "qualification_gate": sql(""",, g AS (SELECT dataset_id, coalesce(string_agg(name, ',' ORDER BY name) FILTER (NOT exists OR actual_kind IS DISTINCT FROM kind OR actual_column <> wanted_column OR uncovered > 0 OR (kind = 'IVF' AND generation IS NULL)), '') AS missing FROM it GROUP BY dataset_id),
x AS (SELECT ca.*, missing, CASE WHEN schema_digest <> declared_digest THEN 'CANDIDATE_SCHEMA_MISMATCH' WHEN missing <> '' THEN 'INCOMPLETE_INDEX_COVERAGE' WHEN stored_rows <> total THEN 'CANDIDATE_COUNT_MISMATCH' WHEN total <> distinct_keys THEN 'DUPLICATE_RECORD_ID' END AS code FROM ca JOIN g USING (dataset_id))
SELECT dataset_id, code, CASE WHEN code = 'INCOMPLETE_INDEX_COVERAGE' THEN missing END AS missing FROM x""", "it", "ca"),
    "index_plan": sql(_plan_sql(False), "it"),
    "index_plan_rebuild": "SELECT name, mode, count(*) AS n, CAST(sum(shards) AS BIGINT) AS shards FROM (" + sql(_plan_sql(True), "it") + ") GROUP BY name, mode",
    "fragment_shards": sql("SELECT CAST(p % 7 AS INTEGER) AS shard, count(*) AS n, min(file_id) AS first, CAST(sum(file_id) AS BIGINT) AS ids FROM (SELECT file_id, row_number() OVER (ORDER BY file_id) - 1 AS p FROM (SELECT DISTINCT file_id FROM mf)) GROUP BY 1", "mf"),
    "indexed_lookup": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1996-01-01' AND o_orderstatus = 'O' AND o_custkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)",
    "even_split": sql("SELECT CAST(shard - 1 AS INTEGER) AS shard, count(*) AS n, min(file_id) AS first, max(file_id) AS last FROM (SELECT file_id, ntile(7) OVER (ORDER BY file_id) AS shard FROM (SELECT DISTINCT file_id FROM mf)) GROUP BY 1", "mf"),
    "retention_floor": sql("SELECT min(q) AS floor FROM (SELECT source_seq AS q FROM w WHERE state <> 'SUCCEEDED' AND source_seq IS NOT NULL UNION ALL SELECT sequence FROM s WHERE state <> 'COMPLETE' UNION ALL SELECT source_seq FROM p WHERE retired_at IS NULL)", "w", "s", "p"),
    "publication_cleanup": sql(f""",, x AS (SELECT p.*, keep, retention, row_number() OVER (PARTITION BY dataset_id ORDER BY published_at DESC, publication_id DESC) AS rank FROM p JOIN sp USING (spec_id))
SELECT publication_id, dataset_id, CAST(rank AS INTEGER) AS rank, retired_at FROM x WHERE retired_at + retention <= {NOW} AND rank > keep AND NOT EXISTS (SELECT 1 FROM ds WHERE active_publication_id = publication_id) ORDER BY retired_at, publication_id LIMIT 100""", "p", "sp", "ds"),
    "serving_routes": sql("SELECT ds.dataset_id, active_publication_id, p.version AS served_version FROM ds JOIN p ON publication_id = active_publication_id WHERE lifecycle = 'ACTIVE'", "ds", "p"),
    "cleanup_slots": sql("SELECT dataset_id, CAST(CAST('0x' || substr(sha256(uri), 1, 16) AS UBIGINT) % 12 AS INTEGER) AS slot, CAST('0x' || substr(sha256(uri), 1, 16) AS UBIGINT) % 12 = 1706572800 // 3600 // 6 % 12 AS active FROM ds", "ds"),
    "tag_pruning": """WITH t AS (SELECT DISTINCT CAST(o_custkey AS BIGINT) AS dataset_id, CASE WHEN o_orderkey % 10 = 0 THEN 'manual' ELSE strftime(o_orderdate, '%Y%m%dT%H%M%SZ') END AS tag FROM orders),
x AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY tag DESC) AS rank FROM t WHERE regexp_full_match(tag, '[0-9]{8}T[0-9]{6}Z')) SELECT dataset_id, tag, CAST(rank AS INTEGER) AS rank FROM x WHERE rank > 3""",
    "index_build_merge": sql(""",, x AS (SELECT org_id AS index, count(*) AS n, bool_or(org_id = 'o3' AND status = 'DELETED') AS failed, count(DISTINCT snapshot_id % 2 * CASE WHEN org_id = 'o1' THEN 1 ELSE 0 END) > 1 AS mixed_specs FROM mf GROUP BY org_id)
SELECT index, CASE WHEN failed OR mixed_specs THEN 0 ELSE n END AS rows, failed, mixed_specs FROM x""", "mf"),
    "index_coverage": sql("SELECT snapshot_id, count(*) AS uncovered FROM mf WHERE status <> 'DELETED' AND file_id % 3 = 0 GROUP BY snapshot_id", "mf"),
    "committable_segments": sql("SELECT snapshot_id AS segment_id FROM mf GROUP BY snapshot_id HAVING bool_and(status <> 'DELETED')", "mf"),
}
