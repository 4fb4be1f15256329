"""Shared plumbing: code shipping, scratch tables in the shared folder, packed rows."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()
_scratch: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once a Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tidemark-code-")
    target = os.path.join(folder, "tidemark_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)  # served by the driver
    _shipped.add(app)


def scratch(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir, which every executor sees.

    Only a local master, where all share one machine, may do without that setting.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            base = spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.split("[")[0] == "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="tidemark-scratch-")
            spark.sparkContext.setCheckpointDir(base)
        _scratch[app] = f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
        atexit.register(_drop, weakref.ref(spark), _scratch[app])
    return _scratch[app]


def _drop(ref, path: str) -> None:
    try:
        delete(ref(), path)
    except Exception:  # the JVM is gone already; the folder is the application's own
        pass


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Stored:
    """DataFrames written to the shared folder and read back, which cuts their lineage.

    ``drop`` deletes the tables that later ones were made from; what is kept is
    deleted when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{scratch(self.spark)}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for n in names:
            if n in self.paths:
                delete(self.spark, self.paths.pop(n))


def lowest(rows: DataFrame, key: Column, n: int, *ties: str) -> DataFrame:
    """The n rows with the lowest 64-bit hashes, by (key, ties).

    Of a large table a filter takes about twice as many first, so that no task sorts or ships more than its share.
    """
    total = rows.count()
    if total > 4 * n:
        rows = rows.where(key < F.lit(int(-(1 << 63) + 2 * n / total * (1 << 64))))
    return rows.orderBy(key, *ties).limit(n)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def joined(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """The arrays of a column of blobs, one after another."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def rows_of(column, dtype) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype) for b in column.to_pylist()]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of [s, s + n) for each pair, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def by_shard(shard: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of rows by shard, and the shards' bounds in it."""
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(n + 1))


def table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
