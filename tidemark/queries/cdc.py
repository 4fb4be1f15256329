"""Queries over the mutation stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import digest as D
from tidemark.operators import cdc
from tidemark.sources import scans, tables
from tidemark.sources.tables import sql

KEYS = ["tenant_id", "namespace", "org_id", "record_id"]
K = ", ".join(KEYS)


def _digest():
    fields = {"kind": (F.col("kind"), "string"), "day": (F.col("day"), "string")}
    return D.event_digest(("tenant_id", "namespace", "org_id"), "record_id", cdc.normalise_operation(F.col("op")), "ts", fields)


def _terminal(spark, sf) -> DataFrame:
    return cdc.terminal(tables.mutations(spark, sf), ["kind", "day", "amount"], _digest())


_TEXT = "printf('%016X', strlen({0})) || hex({0})"
_KIND = "CASE WHEN op = 'delete' THEN 'delete' ELSE 'upsert' END"
_HEX = " || ".join(
    [f"'{D.EVENT_HEADER.encode().hex().upper()}'"]
    + [_TEXT.format(c) for c in KEYS]
    + [_TEXT.format(f"({_KIND})"), "printf('%016X', ts_us)", "'6d' || printf('%016X', 2)"]
    + [f"'{len(k):016X}' || '{k.encode().hex().upper()}' || '73' || {_TEXT.format(k)}" for k in ("day", "kind")]
)
_T = f""",, t AS (SELECT {K}, source_sequence, window_seq, ts_us, {_KIND} AS op_kind, op = 'delete' AS is_deleted, sha256(unhex({_HEX})) AS event_digest,
  CASE WHEN op <> 'delete' THEN kind END AS kind, CASE WHEN op <> 'delete' THEN day END AS day, CASE WHEN op <> 'delete' THEN amount END AS amount FROM m)"""
_L = f", l AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY source_sequence DESC) = 1)"


def op_normalise(spark, sf):
    rows = tables.mutations(spark, sf).withColumn("op_kind", cdc.normalise_operation(F.col("op")))
    return rows.groupBy("op", "op_kind").agg(F.count("*").alias("n"))


def event_digest(spark, sf):
    return _terminal(spark, sf).select("source_sequence", "event_digest")


def lww_state(spark, sf):
    return cdc.latest(_terminal(spark, sf), KEYS).select(*KEYS, "source_sequence", "op_kind", "is_deleted", "kind", "amount")


def live_count_by_route(spark, sf):
    live = cdc.latest(_terminal(spark, sf), KEYS).where("not is_deleted")
    return live.groupBy("tenant_id", "namespace", "org_id").agg(F.count("*").alias("live"))


def conflict_keys(spark, sf):
    return cdc.conflicting_keys(_terminal(spark, sf), [*KEYS, "window_seq"])


def exact_dup_collapse(spark, sf):
    rows = _terminal(spark, sf).select(*KEYS, "source_sequence", "event_digest")
    doubled = rows.unionByName(rows.where("source_sequence % 3 = 0"))
    return cdc.collapse(doubled, [*KEYS, "source_sequence"]).groupBy("org_id").agg(F.count("*").alias("n"), F.countDistinct("event_digest").alias("digests"))


def _halves(spark, sf):
    rows = _terminal(spark, sf).select(*KEYS, "source_sequence", "event_digest", "is_deleted", "kind", "day")
    return cdc.latest(rows.where("source_sequence % 2 = 0"), KEYS), cdc.latest(rows.where("source_sequence % 2 = 1"), KEYS)


_HALVES = f""", a AS (SELECT * FROM t WHERE source_sequence % 2 = 0 QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY source_sequence DESC) = 1),
b AS (SELECT * FROM t WHERE source_sequence % 2 = 1 QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY source_sequence DESC) = 1)"""
_BOTH = f", ab AS (SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY source_sequence DESC) = 1)"


def merge_upsert(spark, sf):
    a, b = _halves(spark, sf)
    return cdc.merge(a, b, KEYS)


def merge_noop(spark, sf):
    a, b = _halves(spark, sf)
    merged = cdc.merge(a, b, KEYS)
    left = cdc.advancing(merged, b, KEYS).agg(F.count("*").alias("advancing"))
    return left.join(cdc.unreconciled(merged, b, KEYS).agg(F.count("*").alias("unreconciled"))).join(cdc.advancing(a, b, KEYS).agg(F.count("*").alias("advancing_before")))


def same_sequence_conflicts(spark, sf):
    a, _ = _halves(spark, sf)
    other = a.withColumn("event_digest", F.when(F.col("source_sequence") % 5 == 0, F.sha2("event_digest", 256)).otherwise(F.col("event_digest")))
    return cdc.same_sequence_conflicts(a, other, KEYS)


def tombstones(spark, sf):
    return cdc.latest(_terminal(spark, sf), KEYS).where("is_deleted").select(*KEYS, "source_sequence", F.col("kind").isNull().alias("cleared"))


def rebuild_winners(spark, sf):
    rows = _terminal(spark, sf).withColumn("source_sequence", F.col("window_seq"))
    return cdc.rebuild(rows, KEYS)


def retention_two_clock(spark, sf):
    rows = cdc.latest(_terminal(spark, sf), KEYS)
    day = 86_400_000_000
    kept = cdc.retained(rows, F.col("ts_us"), 1706572800000000, 2 * day, 5 * day)
    return kept.groupBy("is_deleted").agg(F.count("*").alias("kept"))


def baseline_conflicts(spark, sf):
    rows = cdc.conflicting_keys(_terminal(spark, sf).withColumn("hour", F.floor(F.col("ts_us") / 3_600_000_000)), [*KEYS, "hour"])
    return rows.groupBy("org_id").agg(F.count("*").alias("conflicts"))


def candidate_counts(spark, sf):
    return cdc.candidate_counts(_terminal(spark, sf), KEYS)


def merge_input_violations(spark, sf):
    rows = _terminal(spark, sf).withColumn("kind", F.coalesce("kind", F.when(F.col("source_sequence") % 10 == 0, "left")))
    return cdc.merge_input_violations(rows, KEYS, ["kind"])


def row_rule_flags(spark, sf):
    rows = tables.mutations(spark, sf).withColumn("vector", F.when(F.col("source_sequence") % 100 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.col("amount"))))
    rules = {
        "null_ts": F.col("ts").isNull(),
        "bad_op": ~cdc.valid_operation(F.col("op")),
        "wrong_size": F.size("vector") != 2,
        "not_finite": F.exists("vector", lambda x: F.isnan(x)),
        "missing_amount": F.col("amount").isNull(),
    }
    return cdc.rule_flags(rows, rules)


def _odd_rows(spark, sf):
    """Mutations with a payload map and a vector, some of each kind that a rule is about."""
    n, x = F.col("source_sequence"), F.col("amount")
    vector = F.when(n % 101 == 3, None).when(n % 103 == 4, F.array(x)).when(n % 107 == 5, F.array(x, F.lit(None).cast("double"))).when(n % 109 == 6, F.array(x, F.lit(float("nan")))).when(n % 113 == 7, F.array(x, F.lit(float("inf")))).otherwise(F.array(x, x))
    meta = F.create_map(F.when(n % 127 == 8, "colour").otherwise("kind"), F.col("kind"))
    return tables.mutations(spark, sf).withColumns({"op": F.when(n % 131 == 9, "merge").otherwise(F.col("op")), "ts": F.when(n % 137 != 10, F.col("ts")), "vector": vector, "meta": meta})


def source_profile(spark, sf):
    """Which rules each route's rows break."""
    rules = cdc.source_rules("ts", "op", "meta", ["kind", "day"], "vector", 2)
    rows = _odd_rows(spark, sf)
    return rows.groupBy("org_id").agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])


def envelope_check(spark, sf):
    rows = _odd_rows(spark, sf)
    return cdc.envelope_violations(rows, ["tenant_id", "namespace", "org_id", "record_id", "op", "ts"], cdc.source_rules("ts", "op", "meta", ["kind", "day"], "vector", 2))


def post_images(spark, sf):
    m = tables.mutations(spark, sf).withColumn("meta", F.map_filter(F.create_map(F.lit("kind"), F.col("kind"), F.lit("day"), F.when(F.col("source_sequence") % 2 == 0, F.col("day"))), lambda _, v: v.isNotNull()))
    return cdc.post_image(m.select("source_sequence", "meta"), "meta", ["kind", "day", "colour"])


def key_lookup(spark, sf):
    a, b = _halves(spark, sf)
    return cdc.key_lookup(a, b.where("source_sequence % 5 = 0"), KEYS).select(*KEYS, "source_sequence")


def map_pivot(spark, sf):
    m = tables.mutations(spark, sf).withColumn("meta", F.map_filter(F.create_map(F.lit("kind"), F.col("kind"), F.lit("day"), F.when(F.col("source_sequence") % 2 == 0, F.col("day"))), lambda _, v: v.isNotNull()))
    return m.select("source_sequence", *cdc.map_fields("meta", ["kind", "day", "colour"]))


def unknown_map_keys(spark, sf):
    m = tables.mutations(spark, sf).withColumn("meta", F.create_map(F.concat(F.lit("k"), (F.col("source_sequence") % 3).cast("string")), F.col("kind")))
    return m.select(F.explode(cdc.unknown_keys("meta", ["k0", "k1"])).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def source_digest(spark, sf):
    rows = cdc.latest(_terminal(spark, sf), KEYS)
    return rows.groupBy("tenant_id", "namespace", "org_id").agg(D.source_digest("record_id", "source_sequence", "event_digest").alias("digest"))


def window_scan(spark, sf):
    return _scans(tables.mutations(spark, sf))


def _scans(rows):
    parts = [scans.window_scan(rows, kind, 10, route, parent).select(F.lit(name).alias("scan"), "source_sequence") for name, kind, route, parent in (("baseline", "BASELINE", None, None), ("append", "APPEND", None, 7), ("route", "APPEND", ("t1", "n1", "o5"), 3), ("none", "MAINTENANCE", None, None))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("scan").agg(F.count("*").alias("n"), F.max("source_sequence").alias("last"))


_sources: dict[tuple[str, str], str] = {}


def window_scan_files(spark, sf):
    """The scans of ``window_scan`` over a table written by route and window, so that they prune folders."""
    from tidemark.queries.streams import _folder

    key = (spark.sparkContext.applicationId, sf)
    if key not in _sources:
        path = f"{_folder(spark)}/source"
        scans.write_source(tables.mutations(spark, sf), path)
        _sources[key] = path
    rows = spark.read.parquet(_sources[key])
    scans.check_partitioning(rows, _sources[key])
    return _scans(rows)


def route_segments(spark, sf):
    """How many names of customers could be route segments."""
    from tidemark.functions.predicates import valid_segment

    c = tables.table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("a b"), F.col("c_custkey"))).when(F.col("c_custkey") % 11 == 0, F.lit("")).when(F.col("c_custkey") % 13 == 0, None).otherwise(F.concat(F.lit("org_"), F.col("c_custkey"))).alias("name"))
    return c.groupBy(valid_segment(F.col("name")).alias("ok")).agg(F.count("*").alias("n"))


def vector_cast(spark, sf):
    """Vectors as float32 of a fixed size; those of another are null, and counted."""
    from tidemark.functions import vectors as V

    v = tables.vectors(spark, sf).withColumn("vector", F.when(F.col("record_id") % 9 == 4, F.slice("vector", 1, 8)).otherwise(F.col("vector")))
    cast = v.select(V.of_size(F.col("vector"), 64).cast("array<float>").alias("fixed"), "vector")
    return cast.agg(F.count("fixed").alias("fixed"), V.wrong_size(F.col("vector"), 64).alias("wrong"), F.round(F.sum(F.element_at("fixed", 1).cast("double")), 3).alias("first"))


def vector_mutations(spark, sf):
    """A slice of the vectors as a batch of mutations."""
    from tidemark.sources.vecfiles import mutation_batch

    v = tables.vectors(spark, sf).where("record_id >= 5 and record_id < 150").select(F.col("record_id").alias("position"), "vector", "label")
    rows = mutation_batch(v, ("t1", "n1", "o5"), 3, 1000, ("label",))
    return rows.select(*KEYS, "op", "window_seq", "source_sequence", F.size("vector").alias("size"), F.element_at("meta", "label").alias("label"))


def time_window(spark, sf):
    from tidemark.functions.predicates import time_window as window

    m = tables.mutations(spark, sf)
    exact = m.where(window(F.col("ts_us"), 1704412800123, 1705017600500)).agg(F.count("*").alias("by_micros"))
    return exact.join(m.where(window(F.floor(F.col("ts_us") / 1000000), 1704412800123, 1705017600500, seconds=True)).agg(F.count("*").alias("by_seconds"))).join(m.where(window(F.col("ts_us"), None, 1704412800000)).agg(F.count("*").alias("before")))


def sample_every(spark, sf):
    from tidemark.operators.audit import sampled

    return sampled(tables.mutations(spark, sf), "source_sequence", "org_id", 0.3).select("org_id", "source_sequence")


QUERIES = {f.__name__: f for f in (op_normalise, event_digest, lww_state, live_count_by_route, conflict_keys, exact_dup_collapse, merge_upsert, merge_noop, same_sequence_conflicts, tombstones, rebuild_winners, retention_two_clock, baseline_conflicts, candidate_counts, merge_input_violations, row_rule_flags, map_pivot, unknown_map_keys, source_digest, window_scan, time_window, sample_every, source_profile, envelope_check, post_images, key_lookup, window_scan_files, route_segments, vector_cast, vector_mutations)}

_ODD = """,, o AS (SELECT org_id, source_sequence AS n, CASE WHEN source_sequence % 131 = 9 THEN 'merge' ELSE op END AS op, amount AS x, ts IS NULL OR source_sequence % 137 = 10 AS null_ts FROM m),
b AS (SELECT org_id, null_ts, op = 'merge' AS bad_op, n % 127 = 8 AS unknown_keys, op IN ('insert', 'update', 'upsert') AND n % 101 = 3 AS missing_vector, op IN ('insert', 'update', 'upsert') AND n % 101 <> 3 AND n % 103 = 4 AS wrong_size,
  op IN ('insert', 'update', 'upsert') AND n % 101 <> 3 AND (x IS NULL OR (n % 103 <> 4 AND n % 107 = 5)) AS null_element,
  op IN ('insert', 'update', 'upsert') AND n % 101 <> 3 AND (coalesce(isnan(x), false) OR (n % 103 <> 4 AND n % 107 <> 5 AND n % 109 = 6)) AS nan_element,
  op IN ('insert', 'update', 'upsert') AND n % 101 <> 3 AND (coalesce(isinf(x), false) OR (n % 103 <> 4 AND n % 107 <> 5 AND n % 109 <> 6 AND n % 113 = 7)) AS infinite_element FROM o)"""
_RULES = ("null_ts", "bad_op", "unknown_keys", "missing_vector", "wrong_size", "null_element", "nan_element", "infinite_element")
ORACLES = {
    "source_profile": sql(_ODD + " SELECT org_id, " + ", ".join(f"count(*) FILTER ({r}) AS {r}" for r in _RULES) + " FROM b GROUP BY org_id", "m"),
    "envelope_check": sql(_ODD + " SELECT count(*) FILTER (null_ts) AS null_envelope, " + ", ".join(f"max(CAST({r} AS INTEGER)) AS {r}" for r in _RULES) + " FROM b", "m"),
    "post_images": sql("SELECT source_sequence, kind, CASE WHEN source_sequence % 2 = 0 THEN day END AS day, CAST(NULL AS VARCHAR) AS colour FROM m", "m"),
    "key_lookup": sql(_T + _HALVES + f" SELECT {K}, a.source_sequence FROM a WHERE EXISTS (SELECT 1 FROM b WHERE " + " AND ".join(f"b.{k} = a.{k}" for k in KEYS) + " AND b.source_sequence % 5 = 0)", "m"),
    "op_normalise": sql(f"SELECT op, {_KIND} AS op_kind, count(*) AS n FROM m GROUP BY ALL", "m"),
    "event_digest": sql(_T + " SELECT source_sequence, event_digest FROM t", "m"),
    "lww_state": sql(_T + _L + f" SELECT {K}, source_sequence, op_kind, is_deleted, kind, amount FROM l", "m"),
    "live_count_by_route": sql(_T + _L + " SELECT tenant_id, namespace, org_id, count(*) AS live FROM l WHERE NOT is_deleted GROUP BY ALL", "m"),
    "conflict_keys": sql(_T + f" SELECT {K}, window_seq FROM t GROUP BY ALL HAVING count(DISTINCT event_digest) > 1", "m"),
    "exact_dup_collapse": sql(_T + " SELECT org_id, count(DISTINCT source_sequence) AS n, count(DISTINCT event_digest) AS digests FROM t GROUP BY org_id", "m"),
    "merge_upsert": sql(_T + _HALVES + _BOTH + f" SELECT {K}, source_sequence, event_digest, is_deleted, kind, day FROM ab", "m"),
    "merge_noop": sql(_T + _HALVES + _BOTH + f" SELECT (SELECT count(*) FROM b LEFT JOIN ab USING ({K}) WHERE ab.source_sequence IS NULL OR ab.source_sequence < b.source_sequence) AS advancing, (SELECT count(*) FROM b LEFT JOIN ab USING ({K}) WHERE ab.source_sequence IS NULL OR ab.source_sequence < b.source_sequence OR (ab.source_sequence = b.source_sequence AND ab.event_digest <> b.event_digest)) AS unreconciled, (SELECT count(*) FROM b LEFT JOIN a USING ({K}) WHERE a.source_sequence IS NULL OR a.source_sequence < b.source_sequence) AS advancing_before", "m"),
    "same_sequence_conflicts": sql(_T + _HALVES + f" SELECT {K} FROM a WHERE source_sequence % 5 = 0", "m"),
    "tombstones": sql(_T + _L + f" SELECT {K}, source_sequence, kind IS NULL AS cleared FROM l WHERE is_deleted", "m"),
    "rebuild_winners": sql(_T + f", x AS (SELECT *, max(window_seq) OVER (PARTITION BY {K}) AS top FROM t) SELECT {K}, top AS source_sequence, count(DISTINCT event_digest) AS n_digests, min(event_digest) AS event_digest, min(is_deleted) AS is_deleted FROM x WHERE window_seq = top GROUP BY {K}, top", "m"),
    "retention_two_clock": sql(_T + _L + " SELECT is_deleted, count(*) AS kept FROM l WHERE NOT ((NOT is_deleted AND ts_us < 1706572800000000 - 2 * 86400000000) OR (is_deleted AND ts_us < 1706572800000000 - 5 * 86400000000)) GROUP BY is_deleted", "m"),
    "baseline_conflicts": sql(_T + f", x AS (SELECT {K}, ts_us // 3600000000 AS hour FROM t GROUP BY ALL HAVING count(DISTINCT event_digest) > 1) SELECT org_id, count(*) AS conflicts FROM x GROUP BY org_id", "m"),
    "candidate_counts": sql(_T + f" SELECT count(*) AS total, count(DISTINCT ({K})) AS distinct_keys, count(*) FILTER (NOT is_deleted) AS live, count(DISTINCT ({K})) FILTER (NOT is_deleted) AS live_keys FROM t", "m"),
    "merge_input_violations": sql(_T + f" SELECT count(*) FILTER (record_id IS NULL) AS null_keys, CAST(0 AS BIGINT) AS bad_lineage, count(*) FILTER (is_deleted AND source_sequence % 10 = 0) AS uncleared_tombstones, (SELECT count(*) FROM (SELECT {K} FROM t GROUP BY ALL HAVING count(*) > 1)) AS duplicate_keys FROM t", "m"),
    "row_rule_flags": sql("SELECT CAST(max(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS null_ts, CAST(max(CASE WHEN op NOT IN ('insert', 'update', 'upsert', 'delete') THEN 1 ELSE 0 END) AS INTEGER) AS bad_op, CAST(max(CASE WHEN source_sequence % 100 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS wrong_size, CAST(max(CASE WHEN isnan(amount) THEN 1 ELSE 0 END) AS INTEGER) AS not_finite, CAST(max(CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS missing_amount FROM m", "m"),
    "map_pivot": sql("SELECT source_sequence, kind, CASE WHEN source_sequence % 2 = 0 THEN day END AS day, CAST(NULL AS VARCHAR) AS colour FROM m", "m"),
    "unknown_map_keys": sql("SELECT 'k' || (source_sequence % 3) AS key, count(*) AS n FROM m WHERE 'k' || (source_sequence % 3) NOT IN ('k0', 'k1') GROUP BY 1", "m"),
    "source_digest": sql(_T + _L + f" SELECT tenant_id, namespace, org_id, sha256(unhex('{D.SOURCE_HEADER.encode().hex().upper()}' || string_agg({_TEXT.format('record_id')} || printf('%016X', source_sequence) || upper(event_digest), '' ORDER BY record_id))) AS digest FROM l GROUP BY ALL", "m"),
    "window_scan": sql("""SELECT scan, count(*) AS n, max(source_sequence) AS last FROM (
  SELECT 'baseline' AS scan, source_sequence FROM m WHERE window_seq <= 10 UNION ALL SELECT 'append', source_sequence FROM m WHERE window_seq > 7 AND window_seq <= 10
  UNION ALL SELECT 'route', source_sequence FROM m WHERE window_seq > 3 AND window_seq <= 10 AND tenant_id = 't1' AND namespace = 'n1' AND org_id = 'o5') GROUP BY scan""", "m"),
    "time_window": sql("SELECT count(*) FILTER (ts_us >= 1704412800123000 AND ts_us < 1705017600500000) AS by_micros, count(*) FILTER (ts_us // 1000000 >= 1704412801 AND ts_us // 1000000 < 1705017601) AS by_seconds, count(*) FILTER (ts_us < 1704412800000000) AS before FROM m", "m"),
    "sample_every": sql("SELECT org_id, source_sequence FROM (SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY source_sequence) AS n FROM m) WHERE floor(n * 0.3::DOUBLE) > floor((n - 1) * 0.3::DOUBLE)", "m"),
}
ORACLES["window_scan_files"] = ORACLES["window_scan"]
ORACLES["route_segments"] = "SELECT coalesce(regexp_full_match(name, '[A-Za-z0-9_-]{1,128}'), false) AS ok, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN 'a b' || c_custkey WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN NULL ELSE 'org_' || c_custkey END AS name FROM customer) GROUP BY 1"
ORACLES["vector_cast"] = sql("SELECT count(*) FILTER (record_id % 9 <> 4) AS fixed, count(*) FILTER (record_id % 9 = 4) AS wrong, round(sum(CAST(CAST(vector[1] AS FLOAT) AS DOUBLE)) FILTER (record_id % 9 <> 4), 3) AS first FROM v", "v")
ORACLES["vector_mutations"] = sql("SELECT 't1' AS tenant_id, 'n1' AS namespace, 'o5' AS org_id, CAST(record_id AS VARCHAR) AS record_id, 'insert' AS op, CAST(3 AS BIGINT) AS window_seq, record_id + 1000 AS source_sequence, CAST(64 AS INTEGER) AS size, CAST(label AS VARCHAR) AS label FROM v WHERE record_id >= 5 AND record_id < 150", "v")
