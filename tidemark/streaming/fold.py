"""Folding a stream of mutations into a versioned state table, exactly once.

Each micro-batch is merged into the current version and published as the next one, with a
mark of the stream and its last batch.  Merging is by source sequence, never by time, so late
rows need no watermark and a replayed batch changes nothing: it is recognised by its stream's
mark, whatever other versions lie between, or merges to the same state.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import cdc
from tidemark.sources.versions import VersionConflict, VersionedTable

#: Attempts of a batch against a table to which others write too.
ROUNDS = 5


class StreamFold:
    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.state, self.keys = spark, VersionedTable(spark, path), keys

    def merge_batch(self, batch: DataFrame, batch_id: int, stream: str = "stream") -> None:
        """Merge a batch of terminal rows (keys, source_sequence, event_digest, is_deleted, payload) of a stream."""
        for left in reversed(range(ROUNDS)):
            try:
                return self._merge_once(batch, batch_id, stream)
            except VersionConflict:  # another writer was first: merge into its version
                if not left:
                    raise

    def _merge_once(self, batch: DataFrame, batch_id: int, stream: str) -> None:
        current = self.state.current()
        mark = f"stream-{stream}"
        if current is not None and self.state.marks(current).get(mark, -1) >= batch_id:
            return
        if not cdc.conflicting_keys(batch, [*self.keys, "source_sequence"]).isEmpty():
            raise cdc.ContractError("SAME_SNAPSHOT_CONFLICT")
        source = cdc.latest(cdc.collapse(batch, [*self.keys, "source_sequence"]), self.keys)
        target = self.state.read(current) if current is not None else None
        if target is None:
            self.state.write(source, None, marks={mark: batch_id})
            return
        if not cdc.same_sequence_conflicts(target, source, self.keys).isEmpty():
            raise cdc.ContractError("EQUAL_SEQUENCE_CONFLICT")
        self.state.write(cdc.merge(target.select(*source.columns), source, self.keys), current, marks={mark: batch_id})

    def run(self, stream: DataFrame, checkpoint: str):
        """Fold all that is available now and stop.  The stream is known by its checkpoint: another one starts anew."""

        def fold(batch: DataFrame, batch_id: int) -> None:
            self.merge_batch(batch, batch_id, self._identity(checkpoint))

        query = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return self.state.read()

    def _identity(self, checkpoint: str) -> str:
        rows = self.spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).collect()
        return json.loads(rows[0][0])["id"]
