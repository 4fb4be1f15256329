"""Queries that run a stream to its end, and the versioned store they fold into."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from tidemark.queries import cdc as Q
from tidemark.sources import tables
from tidemark.streaming.fold import StreamFold


def _folder(spark) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-stream-")
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def stream_lww(spark, sf):
    """events as a file stream, folded in micro-batches with a compaction between them: the state equals the batch fold's."""
    folder = _folder(spark)
    rows = tables.mutations(spark, sf).withColumn("part", (F.col("source_sequence") % 3).cast("int"))
    source, state, checkpoint = f"{folder}/source", f"{folder}/state", f"{folder}/checkpoint"
    fold = StreamFold(spark, state, Q.KEYS)
    for parts in ((0,), (1, 2)):  # the table is compacted between the runs, which the second must not take for a batch
        for part in parts:
            rows.where(F.col("part") == part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        terminal = Q.cdc.terminal(stream, ["kind", "day", "amount"], Q._digest())
        fold.run(terminal.select(*Q.KEYS, "source_sequence", "event_digest", "is_deleted", "kind", "amount"), checkpoint)
        base = fold.state.current()
        fold.state.write(fold.state.read(base).coalesce(1), base)
    state = fold.state.read()
    return state.select(*Q.KEYS, "source_sequence", "is_deleted", "kind", "amount")


QUERIES = {"stream_lww": stream_lww}
ORACLES = {"stream_lww": tables.sql(Q._T + Q._L + f" SELECT {Q.K}, source_sequence, is_deleted, kind, amount FROM l", "m")}
