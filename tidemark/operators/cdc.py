"""Folding a mutation stream: normalisation, conflicts, collapse, merge, rebuild, retention.

State tables have a key, ``source_sequence``, ``event_digest``, ``is_deleted`` and payload
columns.  Every operator is a join or an aggregate on the key, so it needs one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUTE = ("tenant_id", "namespace", "org_id")
UPSERTS = ("insert", "update", "upsert", "i", "u")
DELETES = ("delete", "d")
LINEAGE = ("source_sequence", "event_digest", "is_deleted")


class ContractError(ValueError):
    """Input that blocks a window; ``code`` names the rule."""

    def __init__(self, code: str, detail: str = ""):
        super().__init__(f"{code} {detail}".strip())
        self.code = code


def gate(op: Column) -> Column:
    """The operation name as it is compared: lower case, without blanks at the ends (tabs stay)."""
    return F.lower(F.trim(op))


def valid_operation(op: Column) -> Column:
    return F.coalesce(gate(op).isin(*UPSERTS, *DELETES), F.lit(False))


def normalise_operation(op: Column) -> Column:
    """upsert or delete; any other operation is an error when the row is computed."""
    g = gate(op)
    return F.when(g.isin(*UPSERTS), "upsert").when(g.isin(*DELETES), "delete").otherwise(F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(op, F.lit("null")))))


def terminal(mutations: DataFrame, payload: list[str], digest: Column) -> DataFrame:
    """Mutations with kind, digest and tombstone; a delete keeps its time but loses its payload."""
    out = mutations.withColumn("op_kind", normalise_operation(F.col("op"))).withColumn("event_digest", digest)
    out = out.withColumn("is_deleted", F.col("op_kind") == "delete")
    return out.withColumns({c: F.when(~F.col("is_deleted"), F.col(c)) for c in payload})


def conflicting_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one digest: no order says which one holds."""
    return rows.groupBy(*keys).agg(F.min("event_digest").alias("low"), F.max("event_digest").alias("high")).where("low <> high").select(*keys)


def collapse(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key; only for rows without conflicting keys, where duplicates are exact."""
    return rows.dropDuplicates(list(keys))


def latest(rows: DataFrame, keys: list[str], order: str = "source_sequence") -> DataFrame:
    """The row of each key with the largest sequence."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def merge(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert what is absent, update what is older, leave the rest: replaying a source changes nothing."""
    payload = [c for c in target.columns if c not in keys]
    t, s = target.alias("t"), source.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    newer = F.col("t.source_sequence").isNull() | (F.col("t.source_sequence") < F.col("s.source_sequence"))
    cols = [F.coalesce(f"t.{k}", f"s.{k}").alias(k) for k in keys]
    return t.join(s, on, "full_outer").select(*cols, *[F.when(newer, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in payload])


def same_sequence_conflicts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that both sides have at one sequence with different digests."""
    s = source.select(*keys, F.col("source_sequence").alias("_seq"), F.col("event_digest").alias("_digest"))
    return target.join(s, keys).where("source_sequence = _seq and event_digest <> _digest").select(*keys)


def advancing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that would change the target; none of them makes a merge unnecessary."""
    t = target.select(*keys, F.col("source_sequence").alias("_seq"))
    return source.join(t, keys, "left").where("_seq is null or _seq < source_sequence").drop("_seq")


def unreconciled(stored: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that are neither stored nor superseded after a merge."""
    t = stored.select(*keys, F.col("source_sequence").alias("_seq"), F.col("event_digest").alias("_digest"))
    bad = "_seq is null or _seq < source_sequence or (_seq = source_sequence and _digest <> event_digest)"
    return source.join(t, keys, "left").where(bad).select(*keys)


def merge_input_violations(rows: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """One row of counts: null keys, bad lineage, tombstones with payload, keys given twice."""
    null_key = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    lineage = F.col("source_sequence").isNull() | (F.col("source_sequence") < 0) | F.col("event_digest").isNull() | F.col("is_deleted").isNull()
    uncleared = F.lit(False)
    for c in payload:
        uncleared = uncleared | (F.col("is_deleted") & F.col(c).isNotNull())
    counts = rows.agg(F.count_if(null_key).alias("null_keys"), F.count_if(lineage).alias("bad_lineage"), F.count_if(uncleared).alias("uncleared_tombstones"))
    twice = rows.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("duplicate_keys"))
    return counts.join(twice)  # one row each


def rebuild(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the rows of the largest sequence: ``n_digests`` over 1 is a conflict, exact ties are one row."""
    top = rows.groupBy(*keys).agg(F.max("source_sequence").alias("source_sequence"))
    ties = rows.join(top, [*keys, "source_sequence"])
    return ties.groupBy(*keys, "source_sequence").agg(F.countDistinct("event_digest").alias("n_digests"), F.min("event_digest").alias("event_digest"), F.min("is_deleted").alias("is_deleted"))


def candidate_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, keys, live rows and live keys: one group per key first, so nothing is expanded."""
    per = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(~F.col("is_deleted")).alias("live"))
    return per.agg(F.sum("n").alias("total"), F.count("*").alias("distinct_keys"), F.sum("live").alias("live"), F.count_if(F.col("live") > 0).alias("live_keys"))


def qualify(counts: dict, expected_rows: int) -> str | None:
    """The first failed gate of a candidate's counts, or None."""
    if counts["total"] != expected_rows:
        return "CANDIDATE_COUNT_MISMATCH"
    return "DUPLICATE_RECORD_ID" if counts["total"] != counts["distinct_keys"] else None


def retained(rows: DataFrame, micros: Column, now: int, live_for: int, tombstone_for: int | None) -> DataFrame:
    """Two-clock retention in microseconds: tombstones outlive the replay horizon; rows without a time stay."""
    expired = ~F.col("is_deleted") & (micros < now - live_for)
    if tombstone_for is not None:
        expired = expired | (F.col("is_deleted") & (micros < now - max(live_for, tombstone_for)))
    return rows.where(~F.coalesce(expired, F.lit(False)))


def rule_flags(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row, one pass: 1 for each rule that some row breaks."""
    return rows.agg(*[F.max(F.when(bad, 1).otherwise(0)).alias(name) for name, bad in rules.items()])


def unknown_keys(column: str, allowed: list[str]) -> Column:
    return F.array_except(F.map_keys(column), F.array(*[F.lit(a) for a in allowed]))


def key_lookup(stored: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The stored rows of a set of keys."""
    return stored.join(wanted.select(*keys).distinct(), keys, "left_semi")


def post_image(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows with a column for each allowed key of a map, null where it is absent; a key that is not allowed is an error."""
    unknown = F.size(unknown_keys(column, allowed)) > 0
    stop = F.raise_error(F.concat(F.lit("unknown payload field in "), F.array_join(F.map_keys(column), ","))).cast("boolean")
    return rows.where(F.when(F.coalesce(unknown, F.lit(False)), stop).otherwise(F.lit(True))).select("*", *map_fields(column, allowed)).drop(column)


def source_rules(time: str, op: str, payload: str, allowed: list[str], vector: str, dimension: int) -> dict[str, Column]:
    """The rules that a source row must keep, each as the condition that breaks it: a time, a known operation, known
    payload keys, and on an upsert a vector of the dimension whose elements are all there and finite."""
    upsert = F.coalesce(gate(F.col(op)).isin(*UPSERTS), F.lit(False))
    v = F.col(vector)
    return {
        "null_ts": F.col(time).isNull(),
        "bad_op": ~valid_operation(F.col(op)),
        "unknown_keys": F.coalesce(F.size(unknown_keys(payload, allowed)) > 0, F.lit(False)),
        "missing_vector": upsert & v.isNull(),
        "wrong_size": F.coalesce(upsert & (F.size(v) != dimension), F.lit(False)),
        "null_element": F.coalesce(upsert & F.exists(v, lambda x: x.isNull()), F.lit(False)),
        "nan_element": F.coalesce(upsert & F.exists(v, lambda x: F.isnan(x)), F.lit(False)),
        "infinite_element": F.coalesce(upsert & F.exists(v, lambda x: F.abs(x) == F.lit(float("inf"))), F.lit(False)),
    }


def any_null(columns: list[str]) -> Column:
    """Whether any of the columns is null."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return bad


def envelope_violations(rows: DataFrame, envelope: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row, one pass: rows with a null in the envelope, and 1 for each rule that some row breaks."""
    return rows.agg(F.count_if(any_null(envelope)).alias("null_envelope"), *[F.max(F.when(bad, 1).otherwise(0)).alias(name) for name, bad in rules.items()])


def map_fields(column: str, keys: list[str]) -> list[Column]:
    """One column a declared key; absent is null."""
    return [F.try_element_at(F.col(column), F.lit(k)).alias(k) for k in keys]
