"""Readers and writers of binary vector files.

fvecs and ivecs are records of a little-endian int32 dimension and that many float32 or
int32 values, so Spark splits them by record.  u8bin and ibin begin with two uint32 (rows
and dimension); their values are cut from whole files in Arrow batches, so such a file may have 2 GB at most; larger sets are
several files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_vecs(spark: SparkSession, path: str, dimension: int, dtype: str = "float32", start: int = 0, count: int | None = None) -> DataFrame:
    """(position, vector) of the records [start, start + count) of an fvecs or ivecs file."""
    # the format's keys are the records' numbers, so nothing is counted
    name, size = "org.apache.spark.input.FixedLengthBinaryInputFormat", str(4 + 4 * dimension)
    records = spark.sparkContext.newAPIHadoopFile(path, name, "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable", conf={f"{name}.recordLength": size})
    df = spark.createDataFrame(records, "position long, record binary").where(F.col("position") >= start)
    if count is not None:
        df = df.where(F.col("position") < start + count)
    kind = "float" if dtype == "float32" else "int"

    def decode(batches):
        for b in batches:
            raw = [np.frombuffer(x, "<i4", 1)[0] for x in b.column(1).to_pylist()]
            if any(d != dimension for d in raw):
                raise ValueError("a record of another dimension")
            vs = [np.frombuffer(x, "<f4" if dtype == "float32" else "<i4", dimension, 4).tolist() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vs, pa.list_(pa.float32() if dtype == "float32" else pa.int32()))], names=["position", "vector"])

    return df.mapInArrow(decode, f"position long, vector array<{kind}>")


def read_bin(spark: SparkSession, path: str, dtype: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """(position, vector) of rows [start, stop) of a u8bin or ibin file."""
    width = 1 if dtype == "uint8" else 4

    def decode(batches):
        for b in batches:
            for content in b.column(0).to_pylist():
                n, d = np.frombuffer(content, "<u4", 2).tolist()
                last = n if stop is None else min(stop, n)
                for at in range(start, last, 4096):
                    m = min(4096, last - at)
                    a = np.frombuffer(content, np.uint8 if dtype == "uint8" else "<i4", m * d, 8 + at * d * width).reshape(m, d)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + m)), pa.array(a.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=["position", "vector"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(decode, "position long, vector array<int>")


def encode_vecs(vectors: np.ndarray) -> bytes:
    """fvecs (float32) or ivecs (int32) bytes of a matrix."""
    body = vectors.astype("<f4" if vectors.dtype.kind == "f" else "<i4")
    head = np.full((len(body), 1), body.shape[1], "<i4")
    return np.concatenate([head.view(np.uint8).reshape(len(body), 4), body.view(np.uint8).reshape(len(body), -1)], 1).tobytes()


def encode_bin(vectors: np.ndarray) -> bytes:
    """u8bin (uint8) or ibin (int32) bytes of a matrix."""
    return np.array(vectors.shape, "<u4").tobytes() + vectors.astype(np.uint8 if vectors.dtype == np.uint8 else "<i4").tobytes()


def convert_bvecs(source: str, target: str, dimension: int, rows: int | None = None, block: int = 1 << 14) -> int:
    """Write the vectors of a gzipped bvecs file (records of an int32 dimension and that many bytes) as u8bin; the rows written.

    Local files, one block of rows in memory.  A target that was left unfinished is gone on with: rows that are whole
    in it are passed over in the source, and its header is written last."""
    import gzip
    import os

    width, done = 4 + dimension, 0
    if os.path.exists(target):
        done = max(0, os.path.getsize(target) - 8) // dimension
    mode = "r+b" if os.path.exists(target) else "w+b"
    with gzip.open(source, "rb") as src, open(target, mode) as out:
        left = done * width
        while left:  # a stream can't be entered in its middle
            got = src.read(min(left, block * width))
            if not got:
                raise ValueError("the source has fewer rows than the target")
            left -= len(got)
        out.seek(0)
        out.write(np.array([0, dimension], "<u4").tobytes())
        out.seek(8 + done * dimension)
        out.truncate()
        while rows is None or done < rows:
            raw = src.read(width * (block if rows is None else min(block, rows - done)))
            if not raw:
                break
            if len(raw) % width:
                raise ValueError("a cut record")
            a = np.frombuffer(raw, np.uint8).reshape(-1, width)
            if (a[:, :4].copy().view("<i4") != dimension).any():
                raise ValueError("a record of another dimension")
            out.write(a[:, 4:].tobytes())
            done += len(a)
        out.seek(0)
        out.write(np.array([done, dimension], "<u4").tobytes())
    return done


def mutation_batch(vectors: DataFrame, route: tuple[str, str, str], window: int, first_sequence: int, payload: tuple[str, ...] = ()) -> DataFrame:
    """A slice (position, vector, ...) as insert mutations of a route: a record a position, its payload columns as a map of strings."""
    meta = F.create_map(*[x for c in payload for x in (F.lit(c), F.col(c).cast("string"))]) if payload else F.create_map().cast("map<string,string>")
    return vectors.select(
        *[F.lit(v).alias(c) for c, v in zip(("tenant_id", "namespace", "org_id"), route, strict=True)],
        F.col("position").cast("string").alias("record_id"),
        F.lit("insert").alias("op"),
        F.lit(window).cast("long").alias("window_seq"),
        (F.col("position") + first_sequence).cast("long").alias("source_sequence"),
        F.col("vector").cast("array<float>").alias("vector"),
        meta.alias("meta"),
    )
