"""A stored text index: postings in term buckets, with document lengths and corpus statistics.

A version of the index is a set of folders (the first a full build, the others deltas) of rows
(bucket, term, record_ids, dls, ends, positions), partitioned by bucket and sorted by term, so a
query reads the buckets and row groups of its terms only.  A row has the postings of a term in
one batch of documents: their ids and lengths, all their positions one after another, and where
those of each document end.  So no row is made for a token, and few for the frequent terms.
How many buckets there are follows the size of the first build.  They, statistics of the corpus
and the source files that the index covers are marks of the version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import search
from tidemark.sources.versions import VersionedTable

#: Bytes of text whose postings make a bucket, about, and buckets at least and at most.
BUCKET_BYTES, FEWEST, MOST = 120_000_000, 32, 65_536
#: Deltas beyond which they are merged, and terms that one query may have.
MOST_DELTAS, MOST_TERMS = 4, 4096


class IndexCoverageError(RuntimeError):
    """The index covers source files that are gone, or not all that are there."""


def _bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _packer():
    """Rows (record_id, toks) to a row a term and batch: (term, record_ids, dls, ends, positions).

    Self-contained, so that executors need not have this package."""
    import numpy as np
    import pyarrow as pa

    def pack(batches):
        for b in batches:
            ids, flat = b.column(0), b.column(1).flatten()
            if not len(flat):
                continue
            offsets = b.column(1).offsets.to_numpy().astype(np.int64)
            dl = np.diff(offsets)
            words = flat.dictionary_encode()
            code = words.indices.to_numpy()
            order = np.argsort(code, kind="stable")  # documents and positions stay in order within a term
            code = code[order]
            document = np.repeat(np.arange(len(dl)), dl)
            position = (np.arange(len(flat)) - (offsets[:-1] - offsets[0])[document])[order]
            document = document[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(code) != 0) | (np.diff(document) != 0)]))  # tokens that begin a posting
            own = document[first]
            term = np.flatnonzero(np.concatenate([[True], np.diff(code[first]) != 0]))  # postings that begin a term
            count = np.diff(np.append(term, len(first)))
            end = np.append(first[1:], len(flat)) - np.repeat(first[term], count)
            lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
            by_posting = np.append(term, len(first))
            yield pa.RecordBatch.from_arrays(
                [
                    words.dictionary.take(pa.array(code[first[term]])),
                    lists(by_posting, ids.take(pa.array(own))),
                    lists(by_posting, pa.array(dl[own], pa.int32())),
                    lists(by_posting, pa.array(end, pa.int32())),
                    lists(np.append(first[term], len(flat)), pa.array(position, pa.int32())),
                ],
                names=["term", "record_ids", "dls", "ends", "positions"],
            )

    return pack


class TextIndex:
    def __init__(self, spark: SparkSession, path: str, column: str = "text"):
        self.spark, self.table, self.column = spark, VersionedTable(spark, path), column

    def _postings(self, docs: DataFrame, buckets: int) -> DataFrame:
        kind = docs.schema["record_id"].dataType.simpleString()
        toks = docs.select("record_id", T.tokens(F.col(self.column)).alias("toks"))
        rows = toks.mapInArrow(_packer(), f"term string, record_ids array<{kind}>, dls array<int>, ends array<int>, positions array<int>")
        return rows.withColumn("bucket", _bucket("term", buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket", "term")

    def _buckets(self, docs: DataFrame) -> int:
        size = docs.agg(F.coalesce(F.sum(F.octet_length(self.column)), F.lit(0))).first()[0]
        return min(MOST, max(FEWEST, size // BUCKET_BYTES))

    def _staged(self, docs: DataFrame, buckets: int) -> tuple[str, dict]:
        """A folder of postings, and the number of documents and of tokens, which the postings know."""
        folder = self.table.stage(self._postings(docs, buckets), ("bucket",))
        ends = self.spark.read.schema("ends array<int>").parquet(f"{self.table.path}/{folder}")
        return folder, {"n": docs.count(), "tokens": ends.agg(F.coalesce(F.sum(F.element_at("ends", -1)), F.lit(0))).first()[0]}

    def build(self, docs: DataFrame, files: list[str] = ()) -> int:
        """Index all documents (record_id, text) anew."""
        base, buckets = self.table.current(), self._buckets(docs)
        folder, counts = self._staged(docs, buckets)
        return self.table.publish([folder], base, counts | {"files": sorted(files), "buckets": buckets})

    def add(self, docs: DataFrame, files: list[str] = ()) -> int:
        """Index more documents as a delta; record ids must be new."""
        base = self.table.current()
        if base is None:
            return self.build(docs, files)
        held = self.table.marks(base)
        folder, more = self._staged(docs, held["buckets"])
        marks = {"n": held["n"] + more["n"], "tokens": held["tokens"] + more["tokens"], "files": sorted({*held["files"], *files})}
        return self.table.publish([*self.table.folders(base), folder], base, marks)

    def deltas(self) -> int:
        base = self.table.current()
        return 0 if base is None else len(self.table.folders(base)) - 1

    def merge_deltas(self) -> int | None:
        """Rewrite the postings as one folder if there are more than MOST_DELTAS deltas."""
        if self.deltas() <= MOST_DELTAS:
            return None
        base = self.table.current()
        rows = self.table.read(base).repartition(self.table.marks(base)["buckets"], "bucket").sortWithinPartitions("bucket", "term")
        return self.table.write(rows, base, ("bucket",))

    def swap(self, docs: DataFrame, files: list[str], live: set[str]) -> int:
        """Replace the index by a new build of ``files``, unless one of them has gone while it was built."""
        base = self.table.current()
        buckets = self._buckets(docs)
        folder, counts = self._staged(docs, buckets)
        if gone := set(files) - live:
            self.table._fs.delete(self.table._path(f"{self.table.path}/{folder}"), True)
            raise IndexCoverageError(f"gone since the build: {sorted(gone)}")
        return self.table.publish([folder], base, counts | {"files": sorted(files), "buckets": buckets})

    def covered(self, files: list[str]) -> bool:
        """Whether the served version covers all these source files."""
        base = self.table.current()
        return base is not None and set(files) <= set(self.table.marks(base)["files"])

    def _rows(self, terms: list[str]) -> DataFrame:
        """The stored rows of the terms, read from their buckets only."""
        wanted = sorted(set(terms))
        if len(wanted) > MOST_TERMS:
            raise ValueError(f"more than {MOST_TERMS} terms")
        base = self.table.current()
        own = _bucket("term", self.table.marks(base)["buckets"])
        buckets = [r[0] for r in self.spark.createDataFrame([(t,) for t in wanted], "term string").select(own).distinct().collect()] if wanted else []
        return self.table.read(base).where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted))

    def hits(self, terms: list[str], positions: bool = True) -> DataFrame:
        """(record_id, dl, term, tf, positions) of the terms; without positions, those are not read."""

        def posting(record_id, i):
            start = F.when(i > 0, F.get("ends", i - 1)).otherwise(0)
            tf = F.get("ends", i) - start
            places = [F.slice("positions", start + 1, tf).alias("positions")] if positions else []
            return F.struct(record_id.alias("record_id"), F.get("dls", i).alias("dl"), tf.cast("long").alias("tf"), *places)

        rows = self._rows(terms).select("term", F.explode(F.transform("record_ids", posting)).alias("p"))
        return rows.select("p.record_id", "p.dl", "term", "p.tf", *["p.positions"] * positions)

    def scores(self, terms: DataFrame) -> DataFrame:
        """(query_id, record_id, score, matched): BM25 of rows (query_id, term), as ``search.bm25_scores`` over the documents."""
        terms = terms.select("query_id", "term").distinct()
        known = [r[0] for r in terms.select("term").distinct().limit(MOST_TERMS + 1).collect()]
        marks = self.table.marks()
        mean = marks["tokens"] / marks["n"] if marks["n"] and marks["tokens"] else 1.0
        df = self._rows(known).groupBy("term").agg(F.sum(F.size("record_ids")).alias("df"))
        return search.score_postings(self.hits(known, False), df, terms, F.lit(marks["n"]), F.lit(mean))

    def bm25(self, terms: DataFrame, k: int, operator: str = "or") -> DataFrame:
        """The k best documents of each query, as ``search.bm25``."""
        return search.once_a_set(terms, lambda own: search.best(self.scores(own), own, k, operator))

    def phrase(self, words: list[str], slop: int = 0) -> DataFrame:
        """(record_id, places) as ``search.phrase``, from the stored positions of the words only."""
        rows = self.hits(words)
        each = rows.groupBy("record_id").agg(*[F.max(F.when(F.col("term") == w, F.col("positions"))).alias(f"p{i}") for i, w in enumerate(words)])
        return search.phrase_places(each.na.drop(subset=[f"p{i}" for i in range(len(words))]), len(words), slop)
