"""Queries over vectors and texts: filters, nearest neighbours, BM25, fusion and their audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import vectors as V
from tidemark.functions.predicates import compile_filter, projection, serving_predicate
from tidemark.operators import audit, layout, maintenance, search
from tidemark.plans.hybrid import hybrid_search as hybrid_plan
from tidemark.plans.text_query import compile_text_query
from tidemark.sources import tables
from tidemark.sources.tables import sql

#: The index search: trained partitions, and the surveyed floor of probes (V08).
PARTITIONS, PROBES = 10, 8

FILTERS = {
    "filter_compare": ({"op": "and", "children": [{"op": "compare", "column": "n_chars", "cmp": "ge", "value": 500}, {"op": "compare", "column": "lang", "cmp": "ne", "value": "en"}]}, "n_chars >= 500 AND lang <> 'en'"),
    "filter_in": ({"op": "in", "column": "lang", "values": ["fr", "es"]}, "lang IN ('fr', 'es')"),
    "filter_not_in": ({"op": "in", "column": "source", "values": ["src0", "src1"], "negated": True}, "source NOT IN ('src0', 'src1')"),
    "filter_between": ({"op": "between", "column": "n_chars", "low": 1000, "high": 2000}, "n_chars BETWEEN 1000 AND 2000"),
    "filter_not_or": ({"op": "not", "child": {"op": "or", "children": [{"op": "compare", "column": "lang", "cmp": "eq", "value": "en"}, {"op": "compare", "column": "n_chars", "cmp": "lt", "value": 300}]}}, "NOT (lang = 'en' OR n_chars < 300)"),
    "null_predicates": ({"op": "and", "children": [{"op": "is_not_null", "column": "text"}, {"op": "not", "child": {"op": "is_null", "column": "source"}}]}, "text IS NOT NULL AND source IS NOT NULL"),
}


def _filter(node):
    def run(spark, sf):
        d = tables.texts(spark, sf)
        return d.where(compile_filter(node, d.columns)).select("record_id", "lang", "n_chars")

    return run


def default_projection(spark, sf):
    d = tables.texts(spark, sf)
    return d.where(serving_predicate(None, d.columns)).select(*projection(d.columns, [], "record_id", "is_deleted", set())).groupBy("lang", "source").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest"))


def _knn(metric, **more):
    def run(spark, sf):
        v = tables.vectors(spark, sf)
        live = more["live"](v) if more else None
        hits = search.knn(v, tables.vector_queries(spark, sf), 5, metric, live)
        return hits.select("query_id", "record_id", F.round("distance", 9).alias("distance"), "rank")

    return run


def candidates_seen(spark, sf):
    v = tables.vectors(spark, sf)
    return v.agg(F.count_if(F.col("vector").isNotNull()).alias("candidates"), F.count_if(~V.finite(F.col("vector"))).alias("not_finite"), V.wrong_size(F.col("vector"), 64).alias("wrong_size"))


def normalised_rows(spark, sf):
    v = tables.vectors(spark, sf)
    return v.select("record_id", F.round(V.norm(F.col("vector")), 6).alias("norm"), F.round(V.norm(V.normalised(F.col("vector"))), 6).alias("unit"))


def centroid_assign(spark, sf):
    return search.nearest_centroid(tables.vectors(spark, sf), tables.centroids(spark, sf))


def partition_histogram(spark, sf):
    return layout.histogram(centroid_assign(spark, sf))


def salted_partitions(spark, sf):
    placed = centroid_assign(spark, sf)
    return layout.salted(placed, layout.histogram(placed), 40).select("record_id", "pid", "salt")


def ivf_probe(spark, sf):
    return search.ivf_knn(tables.vectors(spark, sf), tables.centroids(spark, sf), tables.vector_queries(spark, sf), 5, PROBES).select("query_id", "record_id", F.round("distance", 9).alias("distance"), "rank")


def ivf_search(spark, sf):
    v = tables.vectors(spark, sf)
    hits = search.ivf_knn(v, maintenance.train_centroids(v, PARTITIONS), tables.vector_queries(spark, sf), 5, PROBES)
    return hits.select("query_id", "record_id", F.round("distance", 9).alias("distance"), "rank")


def ivf_recall(spark, sf):
    """Mean recall of ivf_search against the exact scan, over the whole query set."""
    truth = search.knn(tables.vectors(spark, sf), tables.vector_queries(spark, sf), 5, "l2")
    got = ivf_search(spark, sf)
    lists = lambda h, name: h.groupBy("query_id").agg(F.collect_set("record_id").alias(name))
    each = lists(truth, "t").join(lists(got, "g"), "query_id", "left").select(F.size(F.array_intersect("t", F.coalesce("g", F.array().cast("array<bigint>")))) / F.size("t"))
    return each.toDF("recall").agg(F.round(F.avg("recall"), 9).alias("recall"))


def token_freq(spark, sf):
    """Occurrences and document frequency of every term."""
    return search.postings(tables.texts(spark, sf)).groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("df"))


def corpus_stats(spark, sf):
    return search.corpus_stats(tables.texts(spark, sf)).select("n", F.round("avgdl", 9).alias("avgdl"))


def _bm25(operator):
    def run(spark, sf):
        return search.bm25(tables.texts(spark, sf), tables.terms(spark, sf), 10, operator).select("query_id", "record_id", "score", "rank")

    return run


def bm25_multi_boost(spark, sf):
    d = tables.texts(spark, sf).withColumn("tag", F.concat_ws(" ", "lang", "source"))
    terms = spark.createDataFrame([(1, "fr"), (1, "license"), (2, "src3"), (2, "under")], "query_id long, term string")
    scores = search.multi_match(d, terms, {"text": 1.0, "tag": 2.5}).select("query_id", "record_id", F.round("score", 9).alias("score"))
    return search.top_k(scores, 10, F.desc("score")).select("query_id", "record_id", "score", "rank")


def phrase(spark, sf):
    return search.phrase(tables.texts(spark, sf), ["under", "the"])


def phrase_slop(spark, sf):
    return search.phrase(tables.texts(spark, sf), ["licensed", "the", "license"], 3)


def fuzzy_match(spark, sf):
    vocabulary = search.postings(tables.texts(spark, sf)).select("term").distinct()
    terms = spark.createDataFrame([(1, "lisense"), (2, "reservd")], "query_id long, term string")
    return search.fuzzy_terms(vocabulary, terms, 2, 2)


def _clauses(spark, sf):
    d = tables.texts(spark, sf)
    one = lambda *ts: search.bm25_scores(d, spark.createDataFrame([(1, t) for t in ts], "query_id long, term string"))
    return one("license"), one("version", "mit"), one("rights")


def boolean_query(spark, sf):
    must, should, without = _clauses(spark, sf)
    return search.boolean({"must": must, "should": should, "must_not": without}).select("query_id", "record_id", F.round("score", 9).alias("score"))


def boost_query(spark, sf):
    must, should, _ = _clauses(spark, sf)
    return search.boost(must, should).select("query_id", "record_id", F.round("score", 9).alias("score"))


def _legs(spark, sf, k):
    queries = tables.vector_queries(spark, sf)
    return search.knn(tables.vectors(spark, sf), queries, k, "l2"), search.bm25(tables.texts(spark, sf), tables.terms(spark, sf), k)


def text_query_tree(spark, sf):
    m = lambda q: {"match": {"query": q}}
    tree = {"boolean": {"must": [m("license")], "should": [m("version mit")], "must_not": [m("rights")]}}
    return compile_text_query(tables.texts(spark, sf), tree).select("query_id", "record_id", F.round("score", 9).alias("score"))


def text_query_nodes(spark, sf):
    """A tree with a phrase, a boost, a multi_match and an ``and`` of two terms."""
    tree = {"boolean": {
        "must": [{"match": {"query": "under license", "operator": "and", "boost": 2.0}}],
        "should": [{"boost": {"positive": {"match": {"query": "version"}}, "negative": {"match": {"query": "mit"}}, "factor": 0.25}}, {"multi_match": {"query": "fr apache", "columns": {"text": 1.0, "lang": 3.0}}}],
        "must_not": [{"phrase": {"query": "the license", "slop": 0}}],
    }}
    return compile_text_query(tables.texts(spark, sf), tree).select("query_id", "record_id", F.round("score", 9).alias("score"))


def centroid_assign_metrics(spark, sf):
    """The nearest centroid by each metric."""
    v, c = tables.vectors(spark, sf), tables.centroids(spark, sf)
    parts = [search.nearest_centroid(v, c, m).groupBy("pid").agg(F.count("*").alias("n"), F.sum("record_id").alias("ids")).withColumn("metric", F.lit(m)) for m in ("cosine", "dot")]
    return parts[0].unionByName(parts[1])


def hits_missing(spark, sf):
    """Queries that lose hits when copies of a record count once."""
    return search.underfilled(dedup_hits(spark, sf), tables.vector_queries(spark, sf), 6)


def rrf(spark, sf):
    return search.rrf(list(_legs(spark, sf, 20)), 10)


def weighted_fusion(spark, sf):
    v, t = _legs(spark, sf, 20)
    v = v.withColumn("distance", F.round("distance", 9))
    return search.hybrid(v, t, "semantic", 10).select("query_id", "record_id", F.round("score", 9).alias("score"), "rank")


def hybrid_modes(spark, sf):
    v, t = _legs(spark, sf, 20)
    v = v.withColumn("distance", F.round("distance", 9))
    parts = [search.hybrid(v, t, m, 10).select(F.lit(m).alias("mode"), "query_id", "record_id", F.round("score", 9).alias("score")) for m in ("semantic", "lexical", "balanced")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def hybrid_search(spark, sf):
    queries = tables.vector_queries(spark, sf)
    return hybrid_plan(tables.vectors(spark, sf), tables.texts(spark, sf), queries, tables.terms(spark, sf), 10)


def dedup_hits(spark, sf):
    v = tables.vectors(spark, sf)
    hits = search.knn(v, tables.vector_queries(spark, sf), 6, "l2").select("query_id", (F.col("record_id") % 50).alias("record_id"), F.round("distance", 9).alias("score"))
    return search.best_per_record(hits, True)


def _audit(spark, sf):
    v, q = tables.vectors(spark, sf), tables.vector_queries(spark, sf)
    ids = lambda h: h.groupBy("query_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "record_id"))), lambda x: x["record_id"]).alias("ids"))
    served = ids(search.knn(v, q, 10, "l2", F.col("record_id") % 4 != 1))
    return audit.ranking_quality(served, ids(search.knn(v, q, 10, "l2")), 10)


def ranking_quality(spark, sf):
    return _audit(spark, sf).select("query_id", *[F.round(c, 9).alias(c) for c in ("recall", "ndcg", "mrr")])


def report_grouping_sets(spark, sf):
    rows = _audit(spark, sf).select("recall", (F.col("query_id") % 3).alias("org"), T.parameter_bucket(F.col("query_id"), "none").alias("probes"))
    return audit.report(rows, "recall", ["org", "probes"])


def param_buckets(spark, sf):
    e = tables.table(spark, sf, "orders").select((F.col("o_orderkey") % 90 - 5).cast("long").alias("x"))
    return e.select(T.parameter_bucket(F.when(F.col("x") != 50, F.col("x")), "default").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


QUERIES = {name: _filter(node) for name, (node, _) in FILTERS.items()}
QUERIES |= {f"knn_{m}": _knn(m) for m in V.METRICS}
_LIVE = lambda v: serving_predicate({"op": "compare", "column": "label", "cmp": "le", "value": 4}, v.columns)
QUERIES |= {"knn_filtered": _knn("l2", live=_LIVE)}
QUERIES |= {"bm25_or": _bm25("or"), "bm25_and": _bm25("and")}
QUERIES |= {f.__name__: f for f in (default_projection, candidates_seen, normalised_rows, centroid_assign, partition_histogram, salted_partitions, ivf_probe, ivf_search, ivf_recall, token_freq, corpus_stats, bm25_multi_boost, phrase, phrase_slop, fuzzy_match, boolean_query, boost_query, text_query_tree, text_query_nodes, centroid_assign_metrics, hits_missing, rrf, weighted_fusion, hybrid_modes, hybrid_search, dedup_hits, ranking_quality, report_grouping_sets, param_buckets)}

_DIST = {
    "l2": "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))",
    "dot": "-list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1] * z[2]))",
    "hamming": "CAST(len(list_filter(list_zip({0}, {1}), lambda z: z[1] <> z[2])) AS DOUBLE)",
}
_NORM = "sqrt(list_sum(list_transform({0}, lambda z: z * z)))"
_DIST["cosine"] = "CASE WHEN " + _NORM + " * " + _NORM.replace("{0}", "{1}") + " > 0 THEN 1.0 + (" + _DIST["dot"] + ") / (" + _NORM + " * " + _NORM.replace("{0}", "{1}") + ") ELSE 1.0 END"


def _knn_sql(metric, k=5, where="true", queries="q"):
    return f"""SELECT query_id, record_id, round(distance, 9) AS distance, rank FROM (
  SELECT query_id, record_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, record_id) AS rank
  FROM (SELECT q.query_id, v.record_id, {_DIST[metric].format('v.vector', 'q.vector')} AS distance FROM v, {queries} q WHERE {where})) WHERE rank <= {k}"""


_PLACED = f"""SELECT record_id, arg_min(pid, (d, pid)) AS pid FROM (SELECT v.record_id, c.pid, {_DIST['l2'].format('v.vector', 'c.centroid')} AS d FROM v, c) GROUP BY record_id"""


def _bm25_sql(toks="toks", terms="terms", weight="1.0"):
    return f"""SELECT query_id, record_id, {weight} * sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS score, count(*) AS matched
  FROM (SELECT record_id, len(toks) AS dl, term, len(list_filter(toks, lambda z: z = term)) AS tf FROM {toks}, (SELECT DISTINCT term FROM {terms}) WHERE list_contains(toks, term)) a
  JOIN (SELECT term, count(*) AS df FROM {toks}, (SELECT DISTINCT term FROM {terms}) WHERE list_contains(toks, term) GROUP BY term) b USING (term)
  JOIN {terms} USING (term), (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM {toks}) GROUP BY query_id, record_id"""


def _top(body, k=10, digits=9):
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, record_id) AS rank FROM (SELECT query_id, record_id, round(score, {digits}) AS score FROM ({body}))) WHERE rank <= {k}"


_AND = f"SELECT x.* FROM ({_bm25_sql()}) x JOIN (SELECT query_id, count(*) AS need FROM terms GROUP BY query_id) USING (query_id) WHERE matched = need"
_TAG = ", tagtoks AS (SELECT record_id, regexp_extract_all(lower(lang || ' ' || source), '[\\p{L}\\p{M}\\p{N}_]+') AS toks FROM d), mt AS (SELECT CAST(query_id AS BIGINT) AS query_id, term FROM (VALUES (1, 'fr'), (1, 'license'), (2, 'src3'), (2, 'under')) AS t(query_id, term))"
_LEGS = f""",, vl AS ({_knn_sql('l2', 20)}), tl AS ({_top(_bm25_sql(), 20)})"""
_LEG_VIEWS = ("v", "q", "toks", "terms")


def _weighted_sql(w):
    return f"""SELECT query_id, record_id, sum(x) AS score FROM (
  SELECT query_id, record_id, {w}::DOUBLE * CASE WHEN max(distance) OVER p = min(distance) OVER p THEN 1.0 ELSE (max(distance) OVER p - distance) / (max(distance) OVER p - min(distance) OVER p) END AS x FROM vl WINDOW p AS (PARTITION BY query_id)
  UNION ALL SELECT query_id, record_id, (1 - {w}::DOUBLE) * CASE WHEN max(score) OVER p = min(score) OVER p THEN 1.0 ELSE (score - min(score) OVER p) / (max(score) OVER p - min(score) OVER p) END FROM tl WINDOW p AS (PARTITION BY query_id)) GROUP BY query_id, record_id"""


_RRF = "SELECT query_id, record_id, sum(1.0::DOUBLE / (60 + rank)) AS score FROM (SELECT query_id, record_id, rank FROM vl UNION ALL SELECT query_id, record_id, rank FROM tl) GROUP BY query_id, record_id"
_ONE = "(SELECT CAST(1 AS BIGINT) AS query_id, unnest([{0}]) AS term)"
_MUST, _SHOULD, _NOT = (_bm25_sql(terms=_ONE.format(t)) for t in ("'license'", "'version', 'mit'", "'rights'"))
_LISTS = f""",, served AS (SELECT query_id, list(record_id ORDER BY rank) AS got FROM ({_knn_sql('l2', 10, 'v.record_id % 4 <> 1')}) GROUP BY query_id), truth AS (SELECT query_id, list(record_id ORDER BY rank) AS t FROM ({_knn_sql('l2', 10)}) GROUP BY query_id),
graded AS (SELECT query_id, len(list_intersect(t, got)) / least(10, len(t)) AS recall,
  list_sum(list_transform(range(1, len(got) + 1), lambda i: CASE WHEN list_position(t, got[i]) > 0 THEN len(t) - list_position(t, got[i]) + 1 ELSE 0 END / log2(i + 1))) / list_sum(list_transform(range(1, len(t) + 1), lambda i: (len(t) - i + 1) / log2(i + 1))) AS ndcg,
  CASE WHEN list_position(got, t[1]) > 0 THEN 1.0::DOUBLE / list_position(got, t[1]) ELSE 0 END AS mrr FROM served JOIN truth USING (query_id))"""
_BUCKET = "CASE WHEN {0} IS NULL THEN '{1}' WHEN {0} <= 0 THEN 'nonpositive' WHEN {0} = 1 THEN '1' WHEN {0} = 2 THEN '2' WHEN {0} <= 4 THEN '3-4' WHEN {0} <= 8 THEN '5-8' WHEN {0} <= 16 THEN '9-16' WHEN {0} <= 32 THEN '17-32' WHEN {0} <= 64 THEN '33-64' ELSE '65+' END"

ORACLES = {name: sql(f"SELECT record_id, lang, n_chars FROM d WHERE {where}", "d") for name, (_, where) in FILTERS.items()}
ORACLES |= {f"knn_{m}": sql(_knn_sql(m), "v", "q") for m in V.METRICS}
ORACLES |= {
    "default_projection": sql("SELECT lang, source, count(*) AS n, max(n_chars) AS longest FROM d WHERE NOT is_deleted GROUP BY ALL", "d"),
    "knn_filtered": sql(_knn_sql("l2", 5, "NOT v.is_deleted AND v.label <= 4"), "v", "q"),
    "candidates_seen": sql("SELECT count(vector) AS candidates, count(*) FILTER (len(list_filter(vector, lambda z: isnan(z) OR isinf(z))) > 0) AS not_finite, count(*) FILTER (len(vector) <> 64) AS wrong_size FROM v", "v"),
    "normalised_rows": sql(f"SELECT record_id, round({_NORM.format('vector')}, 6) AS norm, round(sqrt(list_sum(list_transform(vector, lambda z: (z / greatest({_NORM.format('vector')}, 1e-12)) * (z / greatest({_NORM.format('vector')}, 1e-12))))), 6) AS unit FROM v", "v"),
    "centroid_assign": sql(_PLACED, "v", "c"),
    "partition_histogram": sql(f"SELECT pid, count(*) AS n FROM ({_PLACED}) GROUP BY pid", "v", "c"),
    "salted_partitions": sql(f",, pl AS ({_PLACED}), h AS (SELECT pid, CAST(ceil(count(*) / 40) AS INTEGER) AS salts FROM pl GROUP BY pid) SELECT record_id, pid, CAST(CAST('0x' || substr(sha256(CAST(record_id AS VARCHAR)), 1, 8) AS BIGINT) % salts AS INTEGER) AS salt FROM pl JOIN h USING (pid)", "v", "c"),
    "ivf_probe": sql(f""",, pl AS ({_PLACED}), near AS (SELECT query_id, pid FROM (SELECT q.query_id, c.pid, {_DIST['l2'].format('c.centroid', 'q.vector')} AS dd FROM q, c) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY dd, pid) <= 8)
SELECT query_id, record_id, round(dd, 9) AS distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dd, record_id) AS rank FROM (SELECT q.query_id, v.record_id, {_DIST['l2'].format('v.vector', 'q.vector')} AS dd FROM near JOIN q USING (query_id) JOIN pl USING (pid) JOIN v ON v.record_id = pl.record_id)) WHERE rank <= 5""", "v", "q", "c"),
    "token_freq": sql("SELECT term, count(*) AS n, count(DISTINCT record_id) AS df FROM (SELECT record_id, unnest(toks) AS term FROM toks) GROUP BY term", "toks"),
    "corpus_stats": sql("SELECT count(*) AS n, round(avg(len(toks)), 9) AS avgdl FROM toks", "toks"),
    "bm25_or": sql(_top(_bm25_sql()), "toks", "terms"),
    "bm25_and": sql(_top(_AND), "toks", "terms"),
    "bm25_multi_boost": sql(",," + _TAG + " " + _top(f"SELECT query_id, record_id, sum(score) AS score FROM ({_bm25_sql(terms='mt')} UNION ALL {_bm25_sql('tagtoks', 'mt', '2.5::DOUBLE')}) GROUP BY query_id, record_id"), "d", "toks").replace(",\n, tagtoks", ",\ntagtoks"),
    "phrase": sql("SELECT record_id, CAST(len(list_filter(range(1, len(toks)), lambda i: toks[i] = 'under' AND toks[i + 1] = 'the')) AS INTEGER) AS places FROM toks WHERE places > 0", "toks"),
    "phrase_slop": sql("""SELECT record_id, CAST(len(list_filter(range(1, len(toks) + 1), lambda i: toks[i] = 'licensed' AND list_position(toks[i + 1:], 'the') > 0
  AND list_position(toks[i + list_position(toks[i + 1:], 'the') + 1:], 'license') > 0 AND list_position(toks[i + 1:], 'the') + list_position(toks[i + list_position(toks[i + 1:], 'the') + 1:], 'license') + 1 - 3 <= 3)) AS INTEGER) AS places FROM toks WHERE places > 0""", "toks"),
    "fuzzy_match": sql("SELECT DISTINCT CAST(query_id AS BIGINT) AS query_id, term FROM (SELECT DISTINCT unnest(toks) AS term FROM toks), (VALUES (1, 'lisense'), (2, 'reservd')) AS t(query_id, wanted) WHERE levenshtein(term, wanted) <= 2 AND term[1:2] = wanted[1:2]", "toks"),
    "boolean_query": sql(f"SELECT m.query_id, m.record_id, round(m.score + coalesce(s.score, 0), 9) AS score FROM ({_MUST}) m LEFT JOIN ({_SHOULD}) s USING (query_id, record_id) ANTI JOIN ({_NOT}) x USING (query_id, record_id)", "toks"),
    "boost_query": sql(f"SELECT m.query_id, m.record_id, round(CASE WHEN s.record_id IS NULL THEN m.score ELSE m.score * 0.5::DOUBLE END, 9) AS score FROM ({_MUST}) m LEFT JOIN ({_SHOULD}) s USING (query_id, record_id)", "toks"),
    "rrf": sql(_LEGS + _top(_RRF, 10, 12), *_LEG_VIEWS),
    "weighted_fusion": sql(_LEGS + f" SELECT query_id, record_id, round(score, 9) AS score, rank FROM ({_top(_weighted_sql(0.8), 10, 12)})", *_LEG_VIEWS),
    "hybrid_modes": sql(_LEGS + " UNION ALL ".join(f" SELECT '{m}' AS mode, query_id, record_id, round(score, 9) AS score FROM ({_top(b, 10, 12)})" for m, b in (("semantic", _weighted_sql(0.8)), ("lexical", _weighted_sql(0.2)), ("balanced", _RRF))), *_LEG_VIEWS),
    "hybrid_search": sql(f""",, vl AS ({_knn_sql('cosine', 20, 'NOT v.is_deleted')}), lt AS (SELECT * FROM toks WHERE record_id % 11 <> 5), tl AS ({_top(_bm25_sql('lt'), 20)}) {_top(_RRF, 10, 12)}""", *_LEG_VIEWS),
    "dedup_hits": sql(f"SELECT query_id, record_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score, record_id) AS rank FROM (SELECT query_id, record_id % 50 AS record_id, min(distance) AS score FROM ({_knn_sql('l2', 6)}) GROUP BY ALL)", "v", "q"),
    "ranking_quality": sql(_LISTS + " SELECT query_id, round(recall, 9) AS recall, round(ndcg, 9) AS ndcg, round(mrr, 9) AS mrr FROM graded", "v", "q"),
    "report_grouping_sets": sql(_LISTS + f""", g AS (SELECT recall, query_id % 3 AS org, {_BUCKET.format('query_id', 'none')} AS probes FROM graded)
SELECT CASE grouping(org, probes) WHEN 1 THEN 'org' WHEN 2 THEN 'probes' ELSE 'overall' END AS level, coalesce(CAST(org AS VARCHAR), probes, 'all') AS bucket, count(recall) AS n, round(avg(recall), 9) AS mean, round(quantile_cont(recall, 0.5), 9) AS p50, round(quantile_cont(recall, 0.95), 9) AS p95
FROM g GROUP BY GROUPING SETS ((), (org), (probes))""", "v", "q"),
    "param_buckets": f"SELECT {_BUCKET.format('x', 'default')} AS bucket, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 90 - 5 <> 50 THEN o_orderkey % 90 - 5 END AS x FROM orders) GROUP BY 1",
}
ORACLES["text_query_tree"] = ORACLES["boolean_query"]
_NODES = {"must": _bm25_sql(terms=_ONE.format("'under', 'license'")), "positive": _bm25_sql(terms=_ONE.format("'version'")), "negative": _bm25_sql(terms=_ONE.format("'mit'"))}
ORACLES["text_query_nodes"] = sql(f""",, lt AS (SELECT record_id, regexp_extract_all(lower(coalesce(lang, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+') AS toks FROM d),
a AS (SELECT query_id, record_id, 2.0::DOUBLE * score AS score FROM ({_NODES['must']}) WHERE matched = 2), b AS (SELECT p.query_id, p.record_id, CASE WHEN n.record_id IS NULL THEN p.score ELSE p.score * 0.25::DOUBLE END AS score FROM ({_NODES['positive']}) p LEFT JOIN ({_NODES['negative']}) n USING (query_id, record_id)),
mm AS (SELECT query_id, record_id, score FROM ({_bm25_sql(terms=_ONE.format("'fr', 'apache'"))}) UNION ALL SELECT query_id, record_id, score FROM ({_bm25_sql('lt', _ONE.format("'fr', 'apache'"), '3.0::DOUBLE')})),
s AS (SELECT query_id, record_id, sum(score) AS score FROM (SELECT * FROM b UNION ALL SELECT * FROM mm) GROUP BY ALL), x AS (SELECT record_id FROM toks WHERE len(list_filter(range(1, len(toks)), lambda i: toks[i] = 'the' AND toks[i + 1] = 'license')) > 0)
SELECT a.query_id, a.record_id, round(a.score + coalesce(s.score, 0), 9) AS score FROM a LEFT JOIN s USING (query_id, record_id) ANTI JOIN x USING (record_id)""", "d", "toks")
ORACLES["centroid_assign_metrics"] = " UNION ALL ".join(
    "SELECT pid, count(*) AS n, CAST(sum(record_id) AS BIGINT) AS ids, '" + m + "' AS metric FROM (" + sql(f"SELECT record_id, arg_min(pid, (d, pid)) AS pid FROM (SELECT v.record_id, c.pid, {_DIST[m].format('v.vector', 'c.centroid')} AS d FROM v, c) GROUP BY record_id", "v", "c") + ") GROUP BY pid"
    for m in ("cosine", "dot")
)
ORACLES["hits_missing"] = "SELECT query_id, 6 - count(*) AS missing FROM (" + ORACLES["dedup_hits"] + ") GROUP BY query_id HAVING count(*) < 6"
