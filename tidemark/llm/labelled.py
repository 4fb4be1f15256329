"""Bounded samples of labelled documents for training."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.runtime import lowest

#: Training texts are no longer than this many characters; longer documents are scored, not learnt from.
MOST_CHARS = 200_000
#: Characters of training texts of each label, at most: what a task holds of them.
MOST_TOTAL = 12_000_000


def held_out(mod: int, remainder: int) -> Column:
    """Whether crc32 of the id as text falls on the remainder that labels are not learnt from; a null id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == remainder, F.lit(False))


def train(fit, docs: DataFrame, labels: DataFrame, label: str, mod: int, remainder: int, most: dict[int, int]):
    """fit(texts, labels) of at most most[y] documents with each label, none of them held out, less near copies among them.

    Documents are taken in the order of a hash of their ids, while their texts fit into MOST_TOTAL characters a
    label.  The model is trained in a task, on a sample bounded so, and only the model comes to the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(~held_out(mod, remainder)).groupBy("doc_id").agg(F.max("y").alias("y"))
    parts = [lowest(known.where(F.col("y") == y), F.xxhash64("doc_id"), n, "doc_id") for y, n in most.items()]
    ids = parts[0]
    for p in parts[1:]:
        ids = ids.union(p)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length("text") <= MOST_CHARS)
    rows = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).coalesce(1)
    rows = rows.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")

    def run(batches):
        own, room = [], {y: MOST_TOTAL for y in most}
        for b in batches:
            for doc, y, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if len(text) <= room[y]:
                    room[y] -= len(text)
                    own.append((doc, y, text))
        own.sort(key=lambda r: r[0])
        model = fit(*without_copies([t for _, _, t in own], [y for _, y, _ in own]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    row = rows.mapInArrow(run, "model binary").first()
    return pickle.loads(row[0]) if row else fit([], [])


def without_copies(texts: list[str], y: list[int], width: int = 5, share: float = 0.3) -> tuple[list[str], list[int]]:
    """Leave out texts of which more than ``share`` of the shingles were in a text before; copies
    would make the words of one text look like the mark of its label."""
    seen: set[int] = set()
    keep = []
    for lo, hi, buf, off in K.text_slices(pa.array(texts, pa.large_string())):
        w = K.split_words(buf, off, K.SPACED_FOLDED)
        h, at = K.windows(w, width)
        cut = np.searchsorted(at, w.rows)
        for i in range(hi - lo):
            own = h[cut[i] : cut[i + 1]]
            own = set(own[own % np.uint64(8) == 0].tolist())  # an eighth of the shingles tells
            if not own or len(own & seen) <= share * len(own):
                keep.append(lo + i)
            seen |= own
    return [texts[i] for i in keep], [y[i] for i in keep]
