"""Work-queue and publication queries over control tables.

What a claim selects is a query; taking it is a compare-and-swap by the caller, since
row locks have no counterpart in a batch engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LAST = 9223372036854775807


def _rank(kind: str = "kind"):
    return F.when(F.col(kind) == "INGEST", 0).otherwise(1)


def lane_open(work: DataFrame) -> DataFrame:
    """Work with no unfinished work before it in its dataset, by (sequence, ingest first).

    The least (sequence, kind) of unfinished work decides, so no row is compared with each other one."""
    order = F.struct(F.coalesce("source_seq", F.lit(_LAST)).alias("s"), _rank().alias("r"))
    first = work.where("state <> 'SUCCEEDED'").groupBy("dataset_id").agg(F.min(order).alias("first"))
    rows = work.join(first, "dataset_id", "left").withColumn("own", order)
    return rows.where("first is null or first >= own").drop("first", "own")


def without_blocked_source(work: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Ingest work of a source with a blocked snapshot waits; other work goes on."""
    blocked = snapshots.where("state = 'BLOCKED'").select("source_id").distinct()
    ingest = work.where("kind = 'INGEST'").join(blocked, "source_id", "left_anti").select(*work.columns)
    return ingest.unionByName(work.where("kind <> 'INGEST'"))


def claimable(work: DataFrame, snapshots: DataFrame, now: int, limit: int) -> DataFrame:
    """Due work in claim order, one row a dataset."""
    due = lane_open(without_blocked_source(work, snapshots)).where((F.col("state").isin("PENDING", "RETRY")) & (F.col("due_at") <= now))
    order = [F.col("source_seq").asc_nulls_last(), _rank(), F.col("created_at"), F.col("work_id")]
    first = due.withColumn("_n", F.row_number().over(Window.partitionBy("dataset_id").orderBy(*order))).where("_n = 1").drop("_n")
    return first.orderBy(*order).limit(limit)


def expired_leases(work: DataFrame, now: int) -> DataFrame:
    """Running work whose lease is over goes back to RETRY."""
    over = (F.col("state") == "RUNNING") & (F.col("lease_until") <= now)
    over = F.coalesce(over, F.lit(False))
    return work.withColumns({"state": F.when(over, "RETRY").otherwise(F.col("state")), "lease_until": F.when(~over, F.col("lease_until"))})


def stale(work: DataFrame, datasets: DataFrame) -> DataFrame:
    """Non-ingest work whose expectations differ from the dataset's state; nulls are equal."""
    d = datasets.select("dataset_id", "version", "active_publication_id")
    same = F.col("expected_version").eqNullSafe(F.col("version")) & F.col("expected_publication_id").eqNullSafe(F.col("active_publication_id"))
    return work.where("kind <> 'INGEST' and state <> 'SUCCEEDED'").join(d, "dataset_id").where(~same).select(*work.columns)


def completed_snapshots(work: DataFrame) -> DataFrame:
    """Snapshots all of whose work has succeeded."""
    return work.where("source_seq is not null").groupBy("source_id", "source_seq").agg(F.bool_and(F.col("state") == "SUCCEEDED").alias("done")).where("done").select("source_id", "source_seq")


def status(work: DataFrame, snapshots: DataFrame, publications: DataFrame, now: int) -> DataFrame:
    """One row: open work by state, due and blocked counts, the oldest open time, the retention floor."""
    w = work.where("state <> 'SUCCEEDED'").agg(
        F.count_if(F.col("state") == "PENDING").alias("pending"),
        F.count_if(F.col("state") == "RETRY").alias("retry"),
        F.count_if(F.col("state") == "RUNNING").alias("running"),
        F.count_if(F.col("state") == "BLOCKED").alias("blocked"),
        F.count_if(F.col("state").isin("PENDING", "RETRY") & (F.col("due_at") <= now)).alias("due"),
        F.min("created_at").alias("oldest_open"),
    )
    blocked = snapshots.agg(F.count_if(F.col("state") == "BLOCKED").alias("blocked_snapshots"))
    return w.join(blocked).join(retention_floor(work, snapshots, publications))  # one row each


def health(status_row: DataFrame, now: int, most_due: int, most_age: int) -> DataFrame:
    """Status with the list of rules it breaks."""
    rules = [
        (F.col("blocked") > 0, "blocked_work"),
        (F.col("blocked_snapshots") > 0, "blocked_source_snapshot"),
        (F.col("due") > most_due, "due_queue_over_budget"),
        (now - F.col("oldest_open") > most_age, "open_work_age_over_budget"),
    ]
    reasons = F.array_compact(F.array(*[F.when(bad, name) for bad, name in rules]))
    return status_row.withColumn("reasons", F.array_join(reasons, ",")).withColumn("healthy", F.size(reasons) == 0)


def retention_floor(work: DataFrame, snapshots: DataFrame, publications: DataFrame) -> DataFrame:
    """The least sequence that open work, open snapshots or active publications still need."""
    rows = work.where("state <> 'SUCCEEDED' and source_seq is not null").select(F.col("source_seq").alias("seq"))
    rows = rows.unionByName(snapshots.where("state <> 'COMPLETE'").select(F.col("sequence").alias("seq"))).unionByName(publications.where("retired_at is null").select(F.col("source_seq").alias("seq")))
    return rows.agg(F.min("seq").alias("floor"))


def publication_cleanup(publications: DataFrame, datasets: DataFrame, specs: DataFrame, now: int, limit: int) -> DataFrame:
    """Retired publications beyond what their spec keeps, past their retention and not active anywhere."""
    rank = F.row_number().over(Window.partitionBy("dataset_id").orderBy(F.desc("published_at"), F.desc("publication_id")))
    rows = publications.withColumn("rank", rank).join(specs, "spec_id")
    rows = rows.where(F.col("retired_at").isNotNull() & (F.col("retired_at") + F.col("retention") <= now) & (F.col("rank") > F.col("keep")))
    active = datasets.where("active_publication_id is not null").select(F.col("active_publication_id").alias("publication_id"))
    rows = rows.join(active, "publication_id", "left_anti")
    return rows.orderBy("retired_at", "publication_id").limit(limit).select("publication_id", "dataset_id", "rank", "retired_at")


def serving_routes(datasets: DataFrame, publications: DataFrame) -> DataFrame:
    """Each active dataset with the publication it serves."""
    p = publications.select(F.col("publication_id").alias("active_publication_id"), F.col("version").alias("served_version"))
    return datasets.where("lifecycle = 'ACTIVE'").join(p, "active_publication_id").select("dataset_id", "active_publication_id", "served_version")


def resolved_routes(datasets: DataFrame, publications: DataFrame, specs: DataFrame) -> DataFrame:
    """(route, rows, dataset_id, problem): active datasets of a route with their live active publication and its spec.

    A route that more than one row answers is ambiguous and names no dataset."""
    p = publications.where("retired_at is null").select(F.col("publication_id").alias("active_publication_id"), "spec_id")
    rows = datasets.where("lifecycle = 'ACTIVE'").join(p, "active_publication_id").join(specs, "spec_id")
    per = rows.groupBy("route").agg(F.count("*").alias("rows"), F.min("dataset_id").alias("least"))
    return per.select("route", "rows", F.when(F.col("rows") == 1, F.col("least")).alias("dataset_id"), F.when(F.col("rows") > 1, "AMBIGUOUS_ROUTE").alias("problem"))


def claimable_datasets(work: DataFrame, snapshots: DataFrame, datasets: DataFrame, now: int, limit: int) -> DataFrame:
    """Claimable work with its active dataset's columns; what a claim locks are the rows of both."""
    return claimable(work, snapshots, now, limit).join(datasets.where("lifecycle = 'ACTIVE'"), "dataset_id")
