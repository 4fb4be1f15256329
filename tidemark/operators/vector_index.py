"""A stored inverted-file layout of vectors: trained centroids and files by partition.

The vectors lie in folders ``pid=<n>`` of a versioned table, so a query reads the partitions
that it probes and nothing else.  Centroids are a small table beside them, named by the
digest of what they were trained with; a layout whose dimension, metric and version of the
method are those asked for is used again, else it is trained anew.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import layout, maintenance, search
from tidemark.sources.versions import VersionedTable

METHOD = 1
#: Probes: the least, those of a query whose least don't hold k vectors, and the most one may ask for.
PROBES, WIDER, CEILING = 8, 32, 64


class VectorIndexError(ValueError):
    pass


def generation(config: dict) -> str:
    """The name of what centroids were trained with."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def reusable(held: dict | None, dimension: int, metric: str) -> bool:
    """Whether stored centroids serve for these parameters; how many partitions they are doesn't matter."""
    return bool(held) and all(held.get(k) == v for k, v in (("dimension", dimension), ("metric", metric), ("method", METHOD)))


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.table = spark, path.rstrip("/"), VersionedTable(spark, path)

    def build(self, vectors: DataFrame, dimension: int, metric: str = "l2", partitions: int | None = None, rebuild: bool = False, files: list[str] = (), centroids: DataFrame | None = None) -> int:
        """Place vectors (record_id, vector, ...) by the given centroids (pid, centroid), or by stored ones, which are
        trained if there are none that serve."""
        base = self.table.current()
        held = self.table.marks(base).get("config") if base else None
        rows = vectors.count()
        if centroids is not None:
            held = {"dimension": dimension, "metric": metric, "method": METHOD, "partitions": centroids.count(), "rows": rows}
            self.save_centroids(held, centroids)
        elif rebuild or not reusable(held, dimension, metric) or layout.retrain(rows, held["rows"]):
            wanted = layout.trainable_partitions(partitions or layout.partition_count(rows), rows, 1 if partitions else 256)
            held = {"dimension": dimension, "metric": metric, "method": METHOD, "partitions": wanted, "rows": rows}
            self.save_centroids(held, maintenance.train_centroids(vectors.where(F.size("vector") == dimension), wanted))
        placed = search.placed(vectors.where(F.col("vector").isNull() | (F.size("vector") == dimension)), self.load_centroids(held), metric)
        placed = placed.repartition(held["partitions"] + 1, "pid").sortWithinPartitions("pid", "record_id")
        return self.table.write(placed, base, ("pid",), {"config": held, "rows": rows, "files": sorted(files)})

    def save_centroids(self, config: dict, centroids: DataFrame) -> str:
        path = f"{self.path}/centroids-{generation(config)}"
        centroids.coalesce(1).write.mode("overwrite").parquet(path)
        return path

    def load_centroids(self, config: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/centroids-{generation(config)}")

    def config(self) -> dict:
        base = self.table.current()
        if base is None:
            raise VectorIndexError("no index")
        return self.table.marks(base)["config"]

    def covered(self, files: list[str]) -> bool:
        base = self.table.current()
        return base is not None and set(files) <= set(self.table.marks(base)["files"])

    def probes(self, queries: DataFrame, probes: int) -> DataFrame:
        """(query_id, pid) of each query's nearest partitions."""
        config = self.config()
        c = self.load_centroids(config).select(F.col("pid").alias("record_id"), F.col("centroid").alias("vector"))
        return search.knn(c, queries, probes, config["metric"]).select("query_id", F.col("record_id").alias("pid"))

    def _probed(self, queries: DataFrame, k: int, probes: int, live) -> DataFrame:
        config = self.config()
        near = self.probes(queries, min(probes, config["partitions"]))
        pids = [r[0] for r in near.select("pid").distinct().collect()]  # partitions of the index, which prune the scan
        rows = self.table.read().where(F.col("pid").isin(pids))
        rows = rows if live is None else rows.where(live)
        return search.knn_probed(rows.select("pid", "record_id", "vector"), queries, near, len(pids), k, config["metric"])

    def query(self, queries: DataFrame, k: int, probes: int | None = None, bypass: bool = False, fast_search: bool | None = None, files: list[str] | None = None, live=None) -> DataFrame:
        """(query_id, record_id, distance, rank) of each query's k nearest vectors.

        Probes are between PROBES and CEILING; without a number, queries whose partitions hold fewer than k live
        vectors probe WIDER ones.  ``bypass`` compares all vectors.  ``fast_search`` looks at indexed rows only even
        if ``files`` of the source are not covered; False asks for covered files, and None is True where there is
        an index.  Distances are of the vectors themselves, so there is nothing to refine.
        """
        if fast_search is None:
            fast_search = self.table.current() is not None
        if not fast_search and files is not None and not self.covered(files):
            raise VectorIndexError("source files are not covered by the index")
        if bypass:
            rows = self.table.read()
            return search.knn(rows, queries, k, self.config()["metric"], live)
        if probes is not None and probes > CEILING:
            raise VectorIndexError(f"at most {CEILING} probes")
        hits = self._probed(queries, k, max(PROBES, probes or PROBES), live)
        if probes is not None or self.config()["partitions"] <= PROBES:
            return hits
        full = hits.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
        short = queries.join(full, "query_id", "left_anti")
        if short.isEmpty():
            return hits
        return hits.join(full, "query_id", "left_semi").unionByName(self._probed(short, k, WIDER, live))
