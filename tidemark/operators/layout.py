"""Physical layout: clustered buckets, rotation slots, tags, index decisions."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_A_PARTITION, FEWEST, MOST = 8192, 16, 32768


def partition_count(rows: int) -> int:
    """Partitions of a vector index for so many rows."""
    return max(FEWEST, min(MOST, rows // ROWS_A_PARTITION))


def trainable_partitions(wanted: int, rows: int, sample_rate: int = 256) -> int:
    """No more partitions than rows can train, each by ``sample_rate`` of them."""
    return max(1, min(wanted, rows // sample_rate))


def retrain(rows: int, rows_at_training: int, factor: int = 4) -> bool:
    return rows > factor * rows_at_training


def pack(histogram: list[int], cap: int) -> list[tuple[int, int, int, int]]:
    """Contiguous partitions packed into buckets of at most ``cap`` rows: (first, last, salt, salts).

    A partition over the cap is a bucket for each of its salts.  The histogram has a row a
    partition, so this is the driver's work."""
    if cap <= 0:
        raise ValueError("cap must be positive")
    out, first, size = [], None, 0
    for pid, n in enumerate(histogram):
        if n > cap or (first is not None and size + n > cap):
            if first is not None:
                out.append((first, pid - 1, 0, 1))
            first, size = None, 0
        if n > cap:
            salts = math.ceil(n / cap)
            out += [(pid, pid, s, salts) for s in range(salts)]
        elif n or first is not None:
            first, size = (pid if first is None else first), size + n
    if first is not None:
        out.append((first, len(histogram) - 1, 0, 1))
    return out


def salted(rows: DataFrame, sizes: DataFrame, cap: int) -> DataFrame:
    """Rows (record_id, pid) with the salt of an oversized partition, dealt evenly by a hash of the record.

    ``sizes`` has a row a partition of the index, MOST at most, so it is broadcast."""
    n = sizes.select("pid", F.ceil(F.col("n") / cap).cast("int").alias("salts"))
    salt = F.pmod(F.conv(F.substring(F.sha2(F.col("record_id").cast("string"), 256), 1, 8), 16, 10).cast("long"), F.col("salts")).cast("int")
    return rows.join(F.broadcast(n), "pid").withColumn("salt", salt)  # a row a partition of the index


def round_robin(rows: DataFrame, salts: int) -> DataFrame:
    """Rows (record_id, pid) with the salt that dealing a partition's rows in turn gives them: sizes differ by one at most."""
    turn = F.row_number().over(Window.partitionBy("pid").orderBy("record_id")) - 1
    return rows.withColumn("salt", F.pmod(turn, F.lit(salts)).cast("int"))


def even_split(rows: DataFrame, shards: int, order: str) -> DataFrame:
    """Rows with the shard, from 0, of a contiguous split into parts whose sizes differ by one at most."""
    return rows.withColumn("shard", (F.ntile(shards).over(Window.orderBy(order)) - 1).cast("int"))


def histogram(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pid").agg(F.count("*").alias("n"))


def write_clustered(rows: DataFrame, path: str, buckets: int) -> None:
    """Rows (…, bucket, pid) in files that each hold one bucket, in partition order."""
    rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "pid").write.parquet(path)


def write_indexed(rows: DataFrame, path: str, btree: tuple[str, ...] = (), bitmap: tuple[str, ...] = (), zonemap: tuple[str, ...] = (), files: int = 8) -> None:
    """Rows in files that serve as indexes: partitioned by columns of few values, dealt by ranges and sorted by columns that are
    searched by order (row groups' least and greatest values prune), with Bloom filters on columns that are searched by value."""
    order = [*zonemap, *btree]
    out = rows.repartitionByRange(files, *order).sortWithinPartitions(*bitmap, *order) if order else rows
    writer = out.write.option("parquet.block.size", 8 << 20)
    for c in btree:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    (writer.partitionBy(*bitmap) if bitmap else writer).parquet(path)


def cleanup_slot(uri: Column, slots: int) -> Column:
    """A fixed slot of a dataset: the first eight bytes of its SHA-256, modulo the slots."""
    high = F.conv(F.substring(F.sha2(uri, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(high, F.lit(slots).cast("decimal(20,0)")).cast("int")


def active_slot(epoch_seconds: int, cadence_hours: int, slots: int) -> int:
    return epoch_seconds // 3600 // cadence_hours % slots


def retry_delay(attempt: int, work_id: str, base: float, most: float) -> float:
    """Seconds: a capped exponential delay times a fraction fixed by work and attempt."""
    if attempt < 1:
        raise ValueError("attempts count from 1")
    share = int.from_bytes(hashlib.sha256(f"{work_id}:{attempt}".encode()).digest()[:8], "big") / float(2**64 - 1)
    return min(base * 2 ** min(attempt - 1, 10), most) * share


def prunable_tags(tags: DataFrame, keep: int) -> DataFrame:
    """Interval tags (dataset_id, tag) beyond the newest ``keep``; other names are left alone."""
    ok = tags.where(F.col("tag").rlike("^[0-9]{8}T[0-9]{6}Z$") & F.try_to_timestamp("tag", F.lit("yyyyMMdd'T'HHmmss'Z'")).isNotNull())
    rank = F.row_number().over(Window.partitionBy("dataset_id").orderBy(F.desc("tag")))
    return ok.withColumn("rank", rank).where(F.col("rank") > keep).select("dataset_id", "tag", "rank")


def merge_builds(shards: DataFrame) -> DataFrame:
    """Index build shards (index, spec, rows, error) put together: any error discards the index's successes."""
    return shards.groupBy("index").agg(
        F.sum("rows").alias("rows"),
        F.bool_or(F.col("error").isNotNull()).alias("failed"),
        (F.countDistinct("spec") > 1).alias("mixed_specs"),
    ).select("index", F.when(F.col("failed") | F.col("mixed_specs"), 0).otherwise(F.col("rows")).alias("rows"), "failed", "mixed_specs")


def uncovered(files: DataFrame, covered: DataFrame) -> DataFrame:
    """Files that no index segment covers."""
    return files.join(covered.select("file_id").distinct(), "file_id", "left_anti")


def committable(segments: DataFrame, live: DataFrame) -> DataFrame:
    """Index segments (segment_id, file_id) all of whose files are still live."""
    seen = segments.join(live.select("file_id", F.lit(True).alias("live")).distinct(), "file_id", "left")
    return seen.groupBy("segment_id").agg(F.bool_and(F.col("live").isNotNull()).alias("ok")).where("ok").select("segment_id")
