"""Window scans of a partitioned mutation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import check_segment

ROUTE = ("tenant_id", "namespace", "org_id")


def window_scan(rows: DataFrame, kind: str, sequence: int, route: tuple[str, str, str] | None = None, parent: int | None = None) -> DataFrame:
    """Rows of one snapshot: all up to it for a BASELINE, those since its parent for an APPEND, none for MAINTENANCE.

    Route and sequence are partition columns of the source, so both prune files."""
    if kind == "BASELINE":
        out = rows.where(F.col("window_seq") <= sequence)
    elif kind == "APPEND":
        low = sequence - 1 if parent is None else parent
        out = rows.where((F.col("window_seq") > low) & (F.col("window_seq") <= sequence))
    elif kind == "MAINTENANCE":
        out = rows.where(F.lit(False))
    else:
        raise ValueError(f"unknown snapshot kind {kind!r}")
    if route is not None:
        for c, v in zip(ROUTE, route, strict=True):
            out = out.where(F.col(c) == check_segment(v))
    return out


def write_source(rows: DataFrame, path: str, files_a_partition: int = 1) -> None:
    """Write a mutation table partitioned by route and window, the layout that ``window_scan`` prunes."""
    keys = (*ROUTE, "window_seq")
    salt = F.pmod(F.xxhash64("record_id"), F.lit(files_a_partition))
    rows.repartition(*keys, salt).sortWithinPartitions(*keys, "source_sequence").write.partitionBy(*keys).parquet(path)


def check_partitioning(rows: DataFrame, path: str) -> None:
    """The folders under ``path`` must be partitioned by route and window, exactly and in this order."""
    spark = rows.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs, found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), []
    while True:
        names = [(s.getPath().getName(), s.getPath()) for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not names:
            break
        found.append(names[0][0].split("=")[0])
        at = names[0][1]
    if found != [*ROUTE, "window_seq"]:
        raise ValueError(f"partitioned by {found}")


def fragments(rows: DataFrame) -> DataFrame:
    """(position, file) of a table's files in order of name: what the tasks of an exact version's scan read."""
    from pyspark.sql import Window

    files = rows.sparkSession.createDataFrame([(f,) for f in rows.inputFiles()], "file string")
    return files.select((F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("position"), "file")


def round_robin(fragments_: DataFrame, shards: int) -> DataFrame:
    """Fragments (position, ...) with the shard that dealing them in turn gives, of no more shards than fragments."""
    return fragments_.withColumn("shard", F.pmod("position", F.lit(max(1, shards))).cast("int"))
