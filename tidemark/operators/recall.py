"""The recall job: captured searches are replayed exactly and the served rankings graded.

Samples are rows (sample_id, query_type, k, result_ids, query_vector, terms, mode): a vector, text
or hybrid search as it was served.  Every sample gets one row with its grades or the reason why it
has none.  Exact legs of all samples of a type are one join each, so a dataset of any size is
scanned once a leg.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import audit, search

#: Candidates that the samples of one chunk keep together, at most.
CHUNK_BUDGET = 20_000
GRADES = ("recall", "ndcg", "mrr")


def chunks_by_k(ks: list[int], budget: int = CHUNK_BUDGET) -> list[list[int]]:
    """Indices of samples in their order, in chunks whose ks add up to the budget at most."""
    out, held = [], 0
    for i, k in enumerate(ks):
        if k > budget:
            raise ValueError("a sample asks for more than a chunk may keep")
        if not out or held + k > budget:
            out.append([])
            held = 0
        out[-1].append(i)
        held += k
    return out


def skip_reason(type_: Column, results: Column, vector: Column, terms: Column) -> Column:
    """Why a sample can't be graded, null if it can."""
    return (
        F.when(results.isNull(), "null_result_ids")
        .when(~F.coalesce(type_.isin("vector", "text", "hybrid"), F.lit(False)), "unknown_type")
        .when(type_.isin("vector", "hybrid") & vector.isNull(), "missing_vector")
        .when(type_.isin("text", "hybrid") & (F.coalesce(F.size(terms), F.lit(0)) < 1), "missing_text")
    )


def _ordered(hits: DataFrame, value: str) -> DataFrame:
    """A leg as one row a query: ids in order of rank, and their scores."""
    rows = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "record_id", F.col(value).alias("score")))).alias("h"))
    return rows.select("query_id", F.transform("h", lambda x: x["record_id"]).alias("ids"), F.transform("h", lambda x: x["score"]).alias("scores"))


def vector_leg(samples: DataFrame, vectors: DataFrame, metric: str) -> DataFrame:
    """(query_id, record_id, score, rank): the exact nearest k of each sample's own k."""
    own = samples.where("query_type in ('vector', 'hybrid')").select(F.col("sample_id").alias("query_id"), F.col("query_vector").alias("vector"), "k")
    most = own.agg(F.max("k")).first()[0] or 1
    hits = search.knn(vectors, own.select("query_id", "vector"), most, metric)
    return hits.join(own.select("query_id", "k"), "query_id").where("rank <= k").select("query_id", "record_id", F.round("distance", 9).alias("score"), "rank")


def text_leg(samples: DataFrame, texts: DataFrame) -> DataFrame:
    """(query_id, record_id, score, rank, matched): the best k by BM25 over the whole corpus, and how many documents have a term."""
    own = samples.where("query_type in ('text', 'hybrid')").select(F.col("sample_id").alias("query_id"), "terms", "k")
    most = own.agg(F.max("k")).first()[0] or 1
    hits = search.bm25_counted(texts, own.select("query_id", F.explode("terms").alias("term")), most)
    return hits.join(own.select("query_id", "k"), "query_id").where("rank <= k").select("query_id", "record_id", "score", "rank", "matched")


def hybrid_leg(samples: DataFrame, vector: DataFrame, text: DataFrame) -> DataFrame:
    """(query_id, record_id, score, rank): both legs fused as each sample's mode says."""
    own = samples.where("query_type = 'hybrid'").select(F.col("sample_id").alias("query_id"), "k", F.coalesce("mode", F.lit("balanced")).alias("mode"))
    most = own.agg(F.max("k")).first()[0] or 1
    out = None
    for mode in search.MODES:
        ids = own.where(F.col("mode") == mode).select("query_id")
        v, t = (leg.join(ids, "query_id", "left_semi") for leg in (vector, text))
        part = search.hybrid(v.withColumnRenamed("score", "distance"), t, mode, most)
        out = part if out is None else out.unionByName(part)
    return out.join(own.select("query_id", "k"), "query_id").where("rank <= k").select("query_id", "record_id", F.round("score", 9).alias("score"), "rank")


def score_samples(samples: DataFrame, vectors: DataFrame, texts: DataFrame, metric: str = "l2") -> DataFrame:
    """(sample_id, query_type, k, candidates, recall, ndcg, mrr, skip) of every sample.

    A sample without candidates is skipped as ``empty_candidate_set``, a hybrid one with an unknown mode as
    ``fusion_replay``.  ``candidates``: live vectors, documents with a term, or fused hits.
    """
    reason = skip_reason(F.col("query_type"), F.col("result_ids"), F.col("query_vector"), F.col("terms"))
    reason = F.coalesce(reason, F.when((F.col("query_type") == "hybrid") & ~F.coalesce(F.col("mode"), F.lit("balanced")).isin(*search.MODES), "fusion_replay"))
    samples = samples.withColumn("reason", reason)
    good = samples.where("reason is null")
    v, t = vector_leg(good, vectors, metric).persist(), text_leg(good, texts).persist()  # k rows a sample, read by several fusions
    of = lambda kind: good.where(F.col("query_type") == kind).select(F.col("sample_id").alias("query_id"))
    legs = [leg.join(of(kind), "query_id", "left_semi") for kind, leg in (("vector", v), ("text", t), ("hybrid", hybrid_leg(good, v, t)))]
    truth = _ordered(legs[0].unionByName(legs[1].drop("matched")).unionByName(legs[2]), "score")
    live = vectors.where("vector is not null").agg(F.count("*").alias("live"))
    matched = legs[1].groupBy("query_id").agg(F.max("matched").alias("matched"))
    rows = samples.join(truth.withColumnRenamed("query_id", "sample_id"), "sample_id", "left").join(matched.withColumnRenamed("query_id", "sample_id"), "sample_id", "left").join(live)
    count = F.when(F.col("query_type") == "vector", F.col("live")).when(F.col("query_type") == "text", F.coalesce("matched", F.lit(0))).otherwise(F.coalesce(F.size("ids"), F.lit(0)))
    rows = rows.withColumn("candidates", F.when(F.col("reason").isNull(), count.cast("long"))).withColumn("skip", F.coalesce("reason", F.when(F.col("candidates") == 0, "empty_candidate_set")))
    grades = audit.grades(F.coalesce("ids", F.array().cast("array<bigint>")), F.col("result_ids"), F.col("k"), F.col("candidates"))
    return rows.select("sample_id", "query_type", "k", "candidates", *[F.when(F.col("skip").isNull(), F.round(g, 9)).alias(n) for n, g in zip(GRADES, grades, strict=True)], "skip")
