"""Upkeep of versioned tables: clustered rewrites, compaction, digests at scale, index decisions."""

from __future__ import annotations

import hashlib
import math
import random
import time
from collections.abc import Callable
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.digest import SOURCE_HEADER, long_hex, micros, text_hex
from tidemark.operators import cdc, layout, search
from tidemark.sources.versions import VersionConflict, VersionedTable


class SchemaError(ValueError):
    """A table whose schema isn't the declared one."""


def check_schema(rows: DataFrame, declared: T.StructType) -> None:
    """Names, order and types must be those declared; growth is an error too."""
    got = [(f.name, f.dataType.simpleString()) for f in rows.schema]
    want = [(f.name, f.dataType.simpleString()) for f in declared]
    if got != want:
        raise SchemaError(f"{sorted(set(got) ^ set(want)) or 'order of columns'}")


def merge_roles(stored: dict[str, str], new: dict[str, str]) -> dict[str, str]:
    """Roles only grow; a stored role wins."""
    return {**new, **stored}


def shuffle_width(rows: int, routes: int, rows_a_partition: int = 250_000, routes_a_task: int = 8, most: int = 4096) -> int:
    """Shuffle partitions for a window: enough for its rows and for its routes."""
    return max(1, min(most, max(math.ceil(rows / max(1, rows_a_partition)), math.ceil(routes / max(1, routes_a_task)))))


def index_needs_work(exists: bool, vector: bool, rows: int, floor: int, uncovered: int, deltas: int, most_deltas: int = 4, rows_at_training: int | None = None) -> str | None:
    """Why an index needs work, or None: it is absent (a vector index only from ``floor`` rows), files are
    uncovered, it has too many deltas, or its centroids are out of date."""
    if not exists:
        return "absent" if not vector or rows >= floor else None
    if uncovered:
        return "uncovered"
    if deltas > most_deltas:
        return "deltas"
    return "retrain" if vector and rows_at_training and layout.retrain(rows, rows_at_training) else None


def train_centroids(vectors: DataFrame, partitions: int, seed: int = 7, sample: int = 100_000) -> DataFrame:
    """(pid, centroid) by k-means on at most ``sample`` vectors, those with the lowest hashes of their ids."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.where("vector is not null").orderBy(F.xxhash64("record_id"), "record_id").limit(sample)
    model = KMeans(k=partitions, seed=seed, featuresCol="features").fit(rows.select(array_to_vector("vector").alias("features")))
    return vectors.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "pid long, centroid array<double>")


def clustered(vectors: DataFrame, centroids: DataFrame, cap: int) -> DataFrame:
    """Vectors with pid and bucket: contiguous partitions up to ``cap`` rows share one, larger ones are salted."""
    placed = search.nearest_centroid(vectors, centroids)
    sizes = layout.histogram(placed)
    counts = {r.pid: r.n for r in sizes.collect()}  # a row a partition of the index
    packed = layout.pack([counts.get(i, 0) for i in range(max(counts, default=-1) + 1)], cap)
    names = [(pid, salt, i) for i, (first, last, salt, _) in enumerate(packed) for pid in range(first, last + 1)]
    lookup = vectors.sparkSession.createDataFrame(names, "pid long, salt int, bucket int")
    return layout.salted(placed, sizes, cap).join(F.broadcast(lookup), ["pid", "salt"]).join(vectors, "record_id")


def rewrite_clustered(table: VersionedTable, centroids: DataFrame, cap: int) -> int:
    """Publish the current version in clustered files; it must hold as many rows as before."""
    base = table.current()
    rows = table.read(base)
    out = clustered(rows, centroids, cap)
    if out.count() != rows.count():
        raise RuntimeError("a clustered rewrite lost or made rows")
    buckets = max(1, out.agg(F.max("bucket")).first()[0] + 1)
    dealt = out.repartition(buckets, "bucket").sortWithinPartitions("bucket", "pid", "record_id")
    return table.write(dealt.select(*rows.columns), base)


def compaction_skip(files: int, deleted_rows: int = 0) -> str | None:
    """Why a version needs no compaction, or None: it has one file, and no deleted rows in it."""
    return "nothing to compact" if files <= 1 and not deleted_rows else None


def stored_bytes(table: VersionedTable, version: int) -> int:
    """Bytes of a version's files, from the file system's summary."""
    return sum(table._fs.getContentSummary(table._path(f"{table.path}/{f}")).getLength() for f in table.folders(version))


def compact(table: VersionedTable, target_bytes: int = 256 << 20) -> int | None:
    """Publish the current version in files of about ``target_bytes``, or None where it has no more files than that."""
    base = table.current()
    if base is None:
        return None
    rows = table.read(base)
    files = len(rows.inputFiles())
    wanted = max(1, math.ceil(stored_bytes(table, base) / target_bytes))
    if compaction_skip(files) or files <= wanted:
        return None
    return table.write(rows.coalesce(wanted), base)


def check_retention(seconds: int | None) -> None:
    if seconds is not None and seconds <= 0:
        raise ValueError("a retention must be positive")


def retain(table: VersionedTable, time_column: str, now: datetime, live_for: int, tombstone_for: int | None = None) -> int | None:
    """Publish the current version without rows past their retention in seconds (see ``cdc.retained``), or None if all stay."""
    check_retention(live_for)
    check_retention(tombstone_for)
    base = table.current()
    rows = table.read(base) if base is not None else None
    if rows is None:
        return None
    us = int(now.replace(tzinfo=now.tzinfo or UTC).timestamp()) * 1_000_000
    kept = cdc.retained(rows, micros(time_column), us, live_for * 1_000_000, None if tombstone_for is None else tombstone_for * 1_000_000)
    return table.write(kept, base) if kept.count() < rows.count() else None


def maintenance_round(tables: dict[str, VersionedTable], steps: dict[str, Callable[[VersionedTable], object]], tries: int = 3) -> list[dict]:
    """Run steps over tables: a row (table, step, outcome, error) each.  A step that fails does not keep others from
    running, but later steps of its table wait for the next round; one that loses to another writer runs again."""
    out = []
    for name, table in sorted(tables.items()):
        for step, run in steps.items():
            row = {"table": name, "step": step, "outcome": None, "error": None}
            try:
                done = commit_with_retries(lambda run=run, table=table: run(table), tries, 0)
                row["outcome"] = "skipped" if done is None else str(done)
            except Exception as failed:  # an error is the row's result
                row["error"] = f"{type(failed).__name__}: {failed}"
            out.append(row)
            if row["error"]:
                break
    return out


def pack_files(spark, path: str, out: str, target_bytes: int = 256 << 20) -> int:
    """Rewrite a folder of a source table's Parquet files in files of about ``target_bytes``; the number of partitions written."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    n = max(1, math.ceil(size / target_bytes))
    spark.read.parquet(path).coalesce(n).write.mode("errorifexists").parquet(out)
    return n


def commit_with_retries(commit: Callable[[], int], tries: int = 3, pause: float = 0.1) -> int:
    """Run a read-modify-publish step again when another writer was first."""
    for left in range(tries - 1, -1, -1):
        try:
            return commit()
        except VersionConflict:
            if not left:
                raise
            time.sleep(pause * random.random())
    raise ValueError("tries must be positive")


def streamed_source_digest(rows: DataFrame, key: str, sequence: str, digest: str, partitions: int | None = None) -> str:
    """The source digest of one route of any size: rows are dealt by ranges of the key's bytes, encoded where
    they are, and streamed in order through one hash, a partition at a time."""

    def chunks(batches):
        """Encodings of sorted rows, joined to one value a batch."""
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(b.column(0).to_pylist())], pa.binary())], names=["chunk"])

    entry = F.unhex(F.concat(text_hex(F.col(key)), long_hex(F.col(sequence)), F.upper(F.col(digest)))).alias("entry")
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select(F.col(key).alias("key"), entry).repartitionByRange(n, "key").sortWithinPartitions("key").select("entry")
    h = hashlib.sha256(SOURCE_HEADER.encode())
    for r in ordered.mapInArrow(chunks, "chunk binary").toLocalIterator():
        h.update(r.chunk)
    return h.hexdigest()
