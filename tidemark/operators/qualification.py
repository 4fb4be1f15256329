"""Qualification of candidates and planning of index work, over tables of datasets and their indexes."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.versions import VersionConflict

#: Kinds as a store reports them, and what a specification calls them.
OBSERVED_KINDS = {"IVF": "IVF", "IVF_RQ": "IVF", "INVERTED": "INVERTED", "BTREE": "BTREE", "BITMAP": "BITMAP", "ZONEMAP": "ZONEMAP"}
FILES_A_TASK, MOST_DELTAS = 32, 4


def observed_kind(kind: Column) -> Column:
    """The specification's name of a reported index kind; null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in OBSERVED_KINDS.items() for x in pair]), F.upper(kind))


def index_gaps(required: DataFrame, observed: DataFrame) -> DataFrame:
    """(dataset_id, missing): names of required indexes (dataset_id, name, kind, column) that are absent, of another kind or column,
    don't cover all files, or, for vectors, have no generation.

    observed: (dataset_id, name, actual_kind, actual_column, uncovered, generation)."""
    rows = required.join(observed, ["dataset_id", "name"], "left")
    bad = (
        F.col("actual_kind").isNull()
        | ~observed_kind(F.col("actual_kind")).eqNullSafe(F.col("kind"))
        | ~F.col("actual_column").eqNullSafe(F.col("column"))
        | F.coalesce(F.col("uncovered") > 0, F.lit(True))
        | ((F.col("kind") == "IVF") & F.col("generation").isNull())
    )
    return rows.groupBy("dataset_id").agg(F.array_join(F.sort_array(F.collect_list(F.when(bad, F.col("name")))), ",").alias("missing"))


def gate(candidates: DataFrame, gaps: DataFrame) -> DataFrame:
    """(dataset_id, code, missing): the first rule that a candidate breaks, null for one that qualifies.

    candidates: (dataset_id, schema_digest, declared_digest, stored_rows, total, distinct_keys)."""
    rows = candidates.join(gaps, "dataset_id", "left")
    code = (
        F.when(~F.col("schema_digest").eqNullSafe(F.col("declared_digest")), "CANDIDATE_SCHEMA_MISMATCH")
        .when(F.coalesce(F.col("missing"), F.lit("")) != "", "INCOMPLETE_INDEX_COVERAGE")
        .when(~F.col("stored_rows").eqNullSafe(F.col("total")), "CANDIDATE_COUNT_MISMATCH")
        .when(~F.col("total").eqNullSafe(F.col("distinct_keys")), "DUPLICATE_RECORD_ID")
    )
    return rows.select("dataset_id", code.alias("code"), F.when(code == "INCOMPLETE_INDEX_COVERAGE", F.col("missing")).alias("missing"))


def shard_count(files: int, files_a_task: int = FILES_A_TASK) -> int:
    return max(1, math.ceil(files / files_a_task))


def index_plan(targets: DataFrame, row_floor: int = 256, rebuild: bool = False) -> DataFrame:
    """(dataset_id, name, mode, shards) of the work on each target, and of datasets without any one row with mode ``skip``.

    targets: (dataset_id, name, kind, rows, files, exists, uncovered, deltas, rows_at_training, reusable).
    A vector index without a layout that serves is bootstrapped whole, one with such gets segments for the files it
    does not cover; a text index that exists is maintained, else rebuilt; deltas beyond MOST_DELTAS are merged.
    """
    vector, text = F.col("kind") == "IVF", F.col("kind") == "INVERTED"
    shards = lambda n: F.greatest(F.lit(1), F.ceil(n / FILES_A_TASK)).cast("int")
    stale = vector & (F.col("rows") > 4 * F.col("rows_at_training"))
    large = ~vector | (F.col("rows") >= row_floor)
    needed = F.when(~F.col("exists"), large).otherwise((F.col("uncovered") > 0) | (F.col("deltas") > MOST_DELTAS) | F.coalesce(stale, F.lit(False)))
    needed = F.lit(True) if rebuild else needed
    mode = (
        F.when(vector & ~large, "below_floor")
        .when(vector & (F.lit(rebuild) | ~F.col("exists") | ~F.col("reusable") | F.coalesce(stale, F.lit(False))), "bootstrap")
        .when(text & F.col("exists") & ~F.lit(rebuild), "maintain")
        .when(F.col("files") == 0, "done")
        .when(text, "rebuild")
        .when((F.col("uncovered") > 0) | ~F.col("exists") | F.lit(rebuild), "segments")
        .when(F.col("deltas") > MOST_DELTAS, "merge_deltas")
        .otherwise("done")
    )
    count = F.when(F.col("mode") == "rebuild", shards(F.col("files"))).when(F.col("mode") == "segments", shards(F.when(F.col("exists") & ~F.lit(rebuild), F.col("uncovered")).otherwise(F.col("files")))).otherwise(F.lit(1))
    rows = targets.withColumn("needed", needed)
    any_ = rows.groupBy("dataset_id").agg(F.bool_or("needed").alias("any"))
    work = rows.join(any_, "dataset_id").where("any").withColumn("mode", mode)
    work = work.select("dataset_id", "name", "mode", F.when(F.col("mode").isin("done", "below_floor"), 0).otherwise(count).cast("int").alias("shards"))
    return work.unionByName(any_.where("not any").select("dataset_id", F.lit(None).cast("string").alias("name"), F.lit("skip").alias("mode"), F.lit(0).alias("shards")))


def index_round(datasets: list[str], plan: Callable[[str], list], build: Callable[[str, object], object], commit: Callable[[str, list], object], most_replans: int = 2) -> dict[str, str]:
    """Plan, build and commit each dataset's index work; one whose commit comes too late is planned again, up to
    ``most_replans`` times.  Returns dataset -> skipped, committed, stale or the error; none keeps others from running."""
    out: dict[str, str] = {}
    for name in datasets:
        for attempt in range(most_replans + 1):
            try:
                specs = plan(name)
                if not specs:
                    out[name] = "skipped"
                    break
                commit(name, [build(name, s) for s in specs])
                out[name] = "committed"
                break
            except VersionConflict:
                out[name] = "stale"
            except Exception as failed:  # the dataset's result
                out[name] = f"{type(failed).__name__}: {failed}"
                break
    return out


def retention_decision(status: DataFrame) -> DataFrame:
    """One row from (floor, parent_snapshot_id, snapshot_id): whether a source snapshot must stay, the floor and the snapshot to keep."""
    held = F.col("floor").isNotNull()
    return status.select(held.alias("retain"), F.col("floor"), F.when(held, F.coalesce("parent_snapshot_id", "snapshot_id")).alias("retain_snapshot_id"))


def default_vector_column(schema) -> str | None:
    """The first column that is an array of floating-point numbers."""
    return next((f.name for f in schema if f.dataType.simpleString() in ("array<float>", "array<double>")), None)


def default_metric(config: dict | None) -> str:
    """The metric of an index's configuration, squared l2 without one."""
    return (config or {}).get("metric") or "l2"
