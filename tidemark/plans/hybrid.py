"""Hybrid search: two legs over one version, each filtered before it is ranked, then fused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.functions.predicates import MAX_K, check_k, serving_predicate
from tidemark.operators import search


def hybrid_search(vectors: DataFrame, texts: DataFrame, queries: DataFrame, terms: DataFrame, k: int, mode: str = "balanced", metric: str = "cosine", filter_node: dict | None = None, window: Column | None = None, leg_k: int | None = None) -> DataFrame:
    """(query_id, record_id, score, rank).  A leg has 2k rows unless ``leg_k`` says otherwise."""
    legs = min(2 * check_k(k), MAX_K) if leg_k is None else leg_k
    guard = lambda df: df.where(serving_predicate(filter_node, df.columns, window))
    vector_leg = search.knn(guard(vectors), queries, legs, metric)
    text_leg = search.bm25(guard(texts), terms, legs)
    return search.hybrid(vector_leg, text_leg, mode, k)
