"""Connected components of an edge table, as joins and aggregates only."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import Stored

#: A key with more rows than this is hot, unless that many keys could be: then one with this share of all rows.
HOT_ROWS, HOT_SHARE = 1000, 10_000
#: Nodes whose labels are broadcast, 16 bytes each; those of larger graphs are joined by shuffle.
BROADCAST_NODES = 500_000


def join_hot(rows: DataFrame, keyed: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """rows joined with ``keyed``, which has a row a key and the number ``n`` of rows with it.

    Keys with very many rows are broadcast, so their rows stay where they are; they are fewer than
    HOT_SHARE by the way they are chosen.  The others are joined by shuffle.
    """
    on = [on] if isinstance(on, str) else on
    total, most = keyed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    least = max(HOT_ROWS, total // HOT_SHARE)
    if most <= least:
        return rows.join(keyed, on, how)
    keyed = keyed.withColumn("hot", F.col("n") > least)
    hot = keyed.where("hot").drop("hot")
    marked = rows.join(F.broadcast(hot.select(*on, F.lit(True).alias("hot"))), on, "left")
    out = marked.where("hot").drop("hot").join(F.broadcast(hot), on, how)
    return out.unionByName(marked.where("hot is null").drop("hot").join(keyed.where("not hot").drop("hot"), on, how))


def _contract(batches):
    """Replace a partition's edges by a star to the smallest node of each of its components."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            a, c = find(u), find(v)
            if a != c:
                up[max(a, c)] = min(a, c)
    star = [(find(x), x) for x in up]
    star = [(r, x) for r, x in star if r != x]
    yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in star], pa.int64()), pa.array([x for _, x in star], pa.int64())], names=["u", "v"])


def components(store: Stored, edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for edges (u long, v long); the label is the smallest node that is reachable.

    Each partition's edges, of the size that adaptive execution gives a partition, are contracted
    first.  Each round takes the smallest label among neighbours and then the label's own
    label, so paths shrink geometrically; rounds end when nothing changes.  Labels of up to BROADCAST_NODES
    nodes are broadcast; of more, only those of nodes with very many neighbours and those that very many
    nodes have (``join_hot``).  Every round is a written table, so lost executors cost one round at most.
    """
    pairs = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    pairs = store.put(f"{name}-edges", pairs.mapInArrow(_contract, "u long, v long").distinct())
    both = pairs.union(pairs.select("v", "u"))
    degree = both.groupBy(F.col("v").alias("node")).agg(F.count("*").alias("n"), F.min("u").alias("least"))
    labels = store.put(f"{name}-0", degree.select("node", F.least("node", "least").alias("label"), F.col("n").alias("degree")))
    small = labels.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    ends = both.select("u", F.col("v").alias("node"))
    step = 0
    while True:
        step += 1
        if small:
            near = ends.join(F.broadcast(labels.select("node", "label")), "node")
        else:
            near = join_hot(ends, labels.select("node", "label", F.col("degree").alias("n")), "node")
        near = near.groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        own = F.broadcast(labels) if small else labels
        low = near.join(own, "node").select("node", "degree", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        ups = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        if small:
            new = low.join(F.broadcast(ups), "low", "left")
        else:
            low = store.put(f"{name}-low-{step}", low)
            new = join_hot(low, low.groupBy("low").agg(F.count("*").alias("n")).join(ups, "low", "left"), "low")
        new = store.put(f"{name}-{step}", new.select("node", "degree", "old", F.least("low", F.coalesce("up", "low")).alias("label")))
        still = new.where("label <> old").isEmpty()
        store.drop(f"{name}-{step - 1}", f"{name}-low-{step}")
        labels = new.select("node", "label", "degree")
        if still:
            store.drop(f"{name}-edges")
            return labels.select("node", "label")
