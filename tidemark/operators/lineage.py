"""Source lineage: snapshot chains, manifests and incremental plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class LineageError(ValueError):
    """A chain that can't be walked."""


def walk(snapshots: dict[int, tuple[int | None, int]], head: int, ancestor: int | None) -> list[int]:
    """Snapshot ids after ``ancestor`` up to ``head``, oldest first.

    snapshots: id -> (parent, sequence).  The manifest of a table is small and walked by the
    driver; a cycle, a missing parent or a sequence that doesn't grow is an error.
    """
    out, seen, at = [], set(), head
    while at != ancestor:
        if at is None:
            raise LineageError("the ancestor is not in the chain")
        if at in seen:
            raise LineageError("a cycle")
        if at not in snapshots:
            raise LineageError(f"snapshot {at} is missing")
        seen.add(at)
        parent, sequence = snapshots[at]
        if parent in snapshots and snapshots[parent][1] >= sequence:
            raise LineageError(f"sequence of {at} doesn't grow")
        out.append(at)
        at = parent
    return out[::-1]


def violations(snapshots: DataFrame) -> DataFrame:
    """(chain, snapshot_id, problem) of chains in which a parent isn't the one before, or a sequence doesn't grow."""
    w = Window.partitionBy("chain").orderBy("position")
    rows = snapshots.withColumn("before", F.lag("snapshot_id").over(w)).withColumn("before_seq", F.lag("sequence").over(w))
    problem = F.when(F.col("before").isNotNull() & ~F.col("parent_id").eqNullSafe(F.col("before")), "fork").when(F.col("before_seq") >= F.col("sequence"), "sequence")
    return rows.withColumn("problem", problem).where("problem is not null").select("chain", "snapshot_id", "problem")


def conflicting_metadata(snapshots: DataFrame) -> DataFrame:
    """Ids with more than one set of metadata."""
    return snapshots.groupBy("snapshot_id").agg(F.countDistinct(F.struct("parent_id", "sequence")).alias("n")).where("n > 1").select("snapshot_id")


def changed_identity(snapshots: DataFrame, table_uuid: str, spec_id: int) -> DataFrame:
    """(snapshot_id, problem) of snapshots (snapshot_id, table_uuid, spec_id) of another table or partition spec."""
    problem = F.when(~F.col("table_uuid").eqNullSafe(F.lit(table_uuid)), "table_uuid").when(~F.col("spec_id").eqNullSafe(F.lit(spec_id)), "spec_id")
    return snapshots.withColumn("problem", problem).where("problem is not null").select("snapshot_id", "problem")


APPENDS, REWRITES, REMOVALS = ("append", "fast-append"), ("replace", "overwrite"), ("delete", "row_delta")


def classify(snapshots: DataFrame, entries: DataFrame) -> DataFrame:
    """(snapshot_id, verdict) of snapshots (snapshot_id, operation, summary map) by their manifest entries.

    An append must only add data files of its own, and one whose summary says that it added some must
    have such entries.  Deletes, rewrites (nothing here is trusted to rewrite) and other operations block.
    """
    added = (F.col("status") == "ADDED") & (F.col("content") == "DATA")
    per = entries.groupBy("snapshot_id").agg(
        F.bool_or(added).alias("has_data"),
        F.bool_or((F.col("status") != "EXISTING") & ~F.col("added_by").eqNullSafe(F.col("snapshot_id"))).alias("foreign"),
        F.bool_or(F.col("status") == "DELETED").alias("removes"),
        F.bool_or((F.col("status") == "ADDED") & (F.col("content") != "DATA")).alias("delete_file"),
    )
    op = F.lower(F.trim("operation"))
    said = [F.coalesce(F.try_element_at("summary", F.lit(c)), F.lit("0")) for c in ("added-data-files", "added-records")]
    numbers = [x.try_cast("long") for x in said]
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    append = (
        F.when(numbers[0].isNull() | numbers[1].isNull(), "MANIFEST_SUMMARY_INVALID")
        .when(((numbers[0] > 0) | (numbers[1] > 0)) & ~yes("has_data"), "MANIFEST_EVIDENCE_MISSING")
        .when(yes("foreign"), "MANIFEST_SNAPSHOT_MISMATCH")
        .when(yes("removes"), "PHYSICAL_DELETE")
        .when(yes("delete_file"), "DELETE_FILE")
        .otherwise("APPEND")
    )
    verdict = F.when(op.isin(*APPENDS), append).when(op.isin(*REWRITES), "UNTRUSTED_REWRITE").when(op.isin(*REMOVALS), "PHYSICAL_DELETE").otherwise("UNKNOWN_OPERATION")
    return snapshots.join(per, "snapshot_id", "left").select("snapshot_id", verdict.alias("verdict"))


def targets(entries: DataFrame, route: list[str], status: str = "ADDED") -> DataFrame:
    """Routes that files of a status touch, in order."""
    return entries.where(F.col("status") == status).select(*route).distinct().orderBy(*route)


def accepted_prefix(classified: DataFrame) -> DataFrame:
    """(chain, snapshot_id, sequence, verdict) up to the first snapshot of the chain that isn't an append."""
    rejected = F.sum(F.when(F.col("verdict") == "APPEND", 0).otherwise(1)).over(Window.partitionBy("chain").orderBy("sequence"))
    return classified.withColumn("rejected", rejected).where("rejected = 0").select("chain", "snapshot_id", "sequence", "verdict")


def spec_ids(entries: DataFrame) -> DataFrame:
    """Per snapshot how many partition specs its files have, and the largest."""
    return entries.groupBy("snapshot_id").agg(F.countDistinct("spec_id").alias("n_specs"), F.max("spec_id").alias("spec_id"))


def bounded(rows: DataFrame, most: int) -> list:
    """Collect at most ``most`` rows; more are an error and never reach the driver."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise LineageError(f"more than {most} rows")
    return got
