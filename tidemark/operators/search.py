"""Retrieval: exact nearest neighbours, BM25, phrase, fuzzy and boolean text queries, rank fusion.

Queries are tables, so one plan answers a batch.  Ranks always end in the record id,
which makes every cut deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import vectors as V
from tidemark.functions.predicates import check_k
from tidemark.operators import nearest

RRF_K = 60
#: Rows of a query set that meet a chunk of vectors at once, and that are broadcast at most.
QUERY_BLOCK = 1_000
K1, B = 1.2, 0.75
#: Distinct terms of a batch of queries, at most.
MOST_TERMS = 4096
#: Weight of the vector leg by mode; None fuses by reciprocal ranks.
MODES = {"balanced": None, "semantic": 0.8, "lexical": 0.2}


def top_k(rows: DataFrame, k: int, score: Column, by: str = "query_id", key: str = "record_id") -> DataFrame:
    """The first k rows of each query by (score, key), with their rank."""
    w = Window.partitionBy(by).orderBy(score, F.col(key))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= check_k(k)).withColumn("rank", F.col("rank").cast("long"))


def checked_distance(metric: str, a: Column, b: Column) -> Column:
    """The distance; vectors of different dimensions are an error when the row is computed."""
    return F.when(F.size(a) == F.size(b), V.distance(metric, a, b)).otherwise(F.raise_error(F.lit("vectors of different dimensions")).cast("double"))


def knn(vectors: DataFrame, queries: DataFrame, k: int, metric: str, live: Column | None = None) -> DataFrame:
    """(query_id, record_id, distance, rank) of each query's k nearest vectors.

    Null vectors are passed over.  Every vector is compared with all queries, as an exact scan must, in array code: chunks
    of vectors are dealt evenly and meet blocks of QUERY_BLOCK queries, of which one is broadcast, and more meet each
    part of the vectors in a task of their own.  Each task keeps k rows a query, so little is shuffled."""
    V.check_metric(metric)
    rows = vectors if live is None else vectors.where(live)
    spread = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    chunks = nearest.chunks(rows.where("vector is not null").select(F.lit(0).cast("long").alias("key"), "record_id", "vector")).repartition(spread)
    wanted = queries.select(F.lit(0).cast("long").alias("key"), "query_id", "vector")
    parts = -(-queries.count() // QUERY_BLOCK)
    if parts <= 1:
        pairs = chunks.drop("key").join(F.broadcast(nearest.blocks(wanted.repartition(1), QUERY_BLOCK).drop("key")))
    else:
        pairs = chunks.drop("key").join(nearest.blocks(wanted.repartition(parts, "query_id"), QUERY_BLOCK).drop("key").hint("shuffle_replicate_nl"))
    return top_k(nearest.scan(pairs, check_k(k), metric), k, F.col("distance"))


def knn_probed(vectors: DataFrame, queries: DataFrame, probed: DataFrame, partitions: int, k: int, metric: str) -> DataFrame:
    """As ``knn``, each query over the vectors (pid, record_id, vector) of those of the partitions that probed(query_id, pid) names for it.

    Vectors and queries meet by partition, packed as in ``knn``; the chunks of a partition are dealt over tasks where there
    are fewer partitions than those."""
    V.check_metric(metric)
    spread = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    together = lambda rows: rows.repartition(spread, "key").sortWithinPartitions("key")
    slots = max(1, spread // max(1, partitions))
    chunks = nearest.chunks(together(vectors.where("vector is not null").select(F.col("pid").cast("long").alias("key"), "record_id", "vector")))
    chunks = chunks.withColumn("slot", F.pmod(F.monotonically_increasing_id(), F.lit(slots)).cast("int"))
    wanted = probed.join(queries.select("query_id", "vector"), "query_id").select(F.col("pid").cast("long").alias("key"), "query_id", "vector")
    blocks = nearest.blocks(together(wanted), QUERY_BLOCK).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    pairs = chunks.repartition(spread, "key", "slot").join(blocks.repartition(spread, "key", "slot").hint("merge"), ["key", "slot"])
    return top_k(nearest.scan(pairs, check_k(k), metric), k, F.col("distance"))


def placed(vectors: DataFrame, centroids: DataFrame, metric: str = "l2") -> DataFrame:
    """Vectors with all their columns and ``pid``: the centroid with the least (distance, pid); null vectors get the last partition.

    Centroids are a model of at most ``layout.MOST`` rows, sent as one array; no pair becomes a row."""
    all_ = centroids.agg(F.sort_array(F.collect_list(F.struct("pid", "centroid"))).alias("cs"))
    rows = vectors.join(F.broadcast(all_))
    best = F.array_min(F.transform("cs", lambda c: F.struct(checked_distance(metric, F.col("vector"), c["centroid"]).alias("d"), c["pid"].alias("pid"))))
    return rows.withColumn("pid", F.coalesce(F.when(F.col("vector").isNotNull(), best["pid"]), F.size("cs").cast("long"))).drop("cs")


def nearest_centroid(vectors: DataFrame, centroids: DataFrame, metric: str = "l2") -> DataFrame:
    """(record_id, pid) of ``placed``."""
    return placed(vectors, centroids, metric).select("record_id", "pid")


def ivf_knn(vectors: DataFrame, centroids: DataFrame, queries: DataFrame, k: int, probes: int, metric: str = "l2") -> DataFrame:
    """As ``knn`` over the vectors of each query's nearest partitions only; recall can be below 1.

    The partitions are worked out here; ``vector_index`` keeps them."""
    near = knn(centroids.select(F.col("pid").alias("record_id"), F.col("centroid").alias("vector")), queries, probes, metric)
    return knn_probed(placed(vectors.select("record_id", "vector"), centroids, metric), queries, near.select("query_id", F.col("record_id").alias("pid")), centroids.count(), k, metric)


def postings(docs: DataFrame, text: str = "text") -> DataFrame:
    """(record_id, term, tf) of each document."""
    return docs.select("record_id", F.explode(T.tokens(F.col(text))).alias("term")).groupBy("record_id", "term").agg(F.count("*").alias("tf"))


def corpus_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: n documents and their mean length; a null text is an empty document."""
    return docs.agg(F.count("*").alias("n"), F.coalesce(F.avg(F.size(T.tokens(F.col(text)))), F.lit(1.0)).alias("avgdl"))


def score_postings(tf: DataFrame, df: DataFrame, terms: DataFrame, n: Column, avgdl: Column) -> DataFrame:
    """(query_id, record_id, score, matched): BM25 of rows (query_id, term) over the postings (record_id, dl, term, tf) of
    their terms, which df(term, df) documents have, in a corpus of n documents of mean length avgdl.

    Terms are joined null-safe: the filter that goes with a plain join would reach the scan on one side only, and keep
    postings and their counts from sharing it."""
    wanted = df.join(terms.withColumnRenamed("term", "_term"), F.col("term").eqNullSafe(F.col("_term"))).select("_term", "df", "query_id")
    rows = tf.join(wanted, F.col("term").eqNullSafe(F.col("_term")))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))
    return rows.withColumn("part", part).groupBy("query_id", "record_id").agg(F.sum("part").alias("score"), F.count("*").alias("matched"))


def bm25_scores(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(query_id, record_id, score, matched): BM25 of rows (query_id, term) over all documents.

    Terms of a query count once.  One scan makes the postings of query terms, and one row a task of the
    corpus statistics; only these are shuffled.  ``text_index`` keeps postings of all terms."""
    terms = terms.select("query_id", "term").distinct()
    wanted = sorted(r[0] for r in terms.select("term").distinct().limit(MOST_TERMS + 1).collect() if r[0] is not None)
    if len(wanted) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    toks = docs.select("record_id", T.tokens(F.col(text)).alias("toks"))
    toks = toks.select("record_id", F.size("toks").alias("dl"), F.filter("toks", lambda t: t.isin(wanted)).alias("own"))
    # a row an occurrence, and one of each document's length, which add up to one a task: both from one scan
    entry = lambda t, i, dl, n: F.struct(t.alias("term"), i.alias("record_id"), dl.alias("dl"), n.alias("length"))
    none = lambda kind: F.lit(None).cast(kind)
    key = docs.schema["record_id"].dataType.simpleString()
    length = F.array(entry(none("string"), none(key), none("int"), F.col("dl").cast("long")))
    rows = toks.select(F.explode(F.concat(F.transform("own", lambda t: entry(t, F.col("record_id"), F.col("dl"), none("bigint"))), length)).alias("e"))
    rows = rows.groupBy("e.term", "e.record_id", "e.dl").agg(F.count("*").alias("tf"), F.sum("e.length").alias("tokens"))
    stats = rows.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("n"), F.sum("tokens").alias("tokens"))  # a row a query term, and the lengths'
    totals = stats.where("tokens is not null").select("n", F.when(F.col("tokens") > 0, F.col("tokens") / F.col("n")).otherwise(1.0).alias("avgdl"))
    tf = rows.where("tokens is null").select("record_id", "dl", "term", "tf").join(F.broadcast(totals))  # one row
    df = stats.where("tokens is null and n > 0").select("term", "df")  # n, as in all readers of rows, so that they share its shuffle
    return score_postings(tf, df, terms, F.col("n"), F.col("avgdl"))


def same_terms(terms: DataFrame) -> DataFrame:
    """(query_id, same): each query with the least id among those that ask for the same terms."""
    own = terms.select("query_id", "term").distinct().groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term"))).alias("own"))
    return own.join(own.groupBy("own").agg(F.min("query_id").alias("same")), "own").select("query_id", "same")


def once_a_set(terms: DataFrame, answer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows (query_id, ...) that ``answer`` gives for terms (query_id, term), worked out once for queries that ask for the
    same terms: documents are scored once a set of terms, however many queries there are."""
    same = same_terms(terms)
    firsts = terms.join(same.where("query_id = same").select("query_id"), "query_id", "left_semi")
    rows = answer(firsts)
    return same.join(rows.withColumnRenamed("query_id", "same"), "same").select(*rows.columns)


def best(scores: DataFrame, terms: DataFrame, k: int, operator: str = "or", digits: int = 9) -> DataFrame:
    """The k best documents of each query; ``and`` asks for all its terms."""
    if operator == "and":
        need = terms.select("query_id", "term").distinct().groupBy("query_id").agg(F.count("*").alias("need"))
        scores = scores.join(need, "query_id").where("matched = need")
    scores = scores.select("query_id", "record_id", F.round("score", digits).alias("score"))
    return top_k(scores, k, F.desc("score"))


def bm25(docs: DataFrame, terms: DataFrame, k: int, operator: str = "or", text: str = "text", digits: int = 9) -> DataFrame:
    """The k best documents of each query by BM25 over all documents."""
    return once_a_set(terms, lambda own: best(bm25_scores(docs, own, text), own, k, operator, digits))


def bm25_counted(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """As ``bm25``, with ``matched``: how many documents have any of the query's terms."""

    def answer(own: DataFrame) -> DataFrame:
        scores = bm25_scores(docs, own)
        n = scores.groupBy("query_id").agg(F.count("score").alias("matched"))  # of scores, so that both read one shuffle
        return best(scores, own, k).join(n, "query_id")

    return once_a_set(terms, answer)


def phrase(docs: DataFrame, words: list[str], slop: int = 0, text: str = "text") -> DataFrame:
    """(record_id, places) of documents where the words stand in order, with at most ``slop`` words between them in all."""
    toks = docs.select("record_id", T.tokens(F.col(text)).alias("toks"))

    def at(word: str) -> Column:
        return F.filter(F.transform("toks", lambda t, i: F.when(t == word, i)), lambda i: i.isNotNull())

    rows = toks.select("record_id", *[at(w).alias(f"p{n}") for n, w in enumerate(words)])
    for n in range(len(words)):
        rows = rows.where(F.size(f"p{n}") > 0)
    return phrase_places(rows, len(words), slop)


def phrase_places(rows: DataFrame, words: int, slop: int) -> DataFrame:
    """(record_id, places) for rows (record_id, p0, p1, ...) with the places of each word of a phrase, ascending."""

    def after(places: str, end: Column) -> Column:
        return F.array_min(F.filter(places, lambda x: x > end))

    def fits(i: Column) -> Column:
        # the place of each next word is the first after the one before
        end = i
        for n in range(1, words):
            end = after(f"p{n}", end)
        return F.coalesce((end - i + 1 - words) <= slop, F.lit(False))

    return rows.select("record_id", F.size(F.filter("p0", fits)).alias("places")).where("places > 0")


def fuzzy_terms(vocabulary: DataFrame, terms: DataFrame, distance: int, prefix: int = 0) -> DataFrame:
    """(query_id, term) of vocabulary terms within an edit distance of a query term that begin alike."""
    if terms.limit(MOST_TERMS + 1).count() > MOST_TERMS:  # they are broadcast
        raise ValueError(f"more than {MOST_TERMS} terms")
    t = terms.select("query_id", F.col("term").alias("wanted"))
    near = F.levenshtein("term", "wanted") <= distance
    near = near & (F.abs(F.length("term") - F.length("wanted")) <= distance)
    if prefix:
        near = near & (F.substring("term", 1, prefix) == F.substring("wanted", 1, prefix))
    return vocabulary.select("term").distinct().join(F.broadcast(t), near).select("query_id", "term").distinct()


def boolean(scores: dict[str, DataFrame | None]) -> DataFrame:
    """must (inner), should (adds) and must_not (drops) over clause scores (query_id, record_id, score)."""
    must, should, without = (scores.get(x) for x in ("must", "should", "must_not"))
    keys = ["query_id", "record_id"]
    if must is None and should is None:
        raise ValueError("a boolean query needs must or should")
    out = (must if must is not None else should).select(*keys, "score")
    if must is not None and should is not None:
        out = out.join(should.select(*keys, F.col("score").alias("more")), keys, "left").select(*keys, (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
    return out if without is None else out.join(without.select(*keys), keys, "left_anti")


def boost(positive: DataFrame, negative: DataFrame, factor: float = 0.5) -> DataFrame:
    """Positive hits, those that are negative hits too multiplied down."""
    keys = ["query_id", "record_id"]
    n = negative.select(*keys, F.lit(True).alias("hit")).distinct()
    return positive.join(n, keys, "left").select(*keys, F.when(F.col("hit"), F.col("score") * factor).otherwise(F.col("score")).alias("score"))


def multi_match(docs: DataFrame, terms: DataFrame, boosts: dict[str, float]) -> DataFrame:
    """(query_id, record_id, score): BM25 of each column times its boost, added up."""
    out = None
    for column, weight in boosts.items():
        part = bm25_scores(docs, terms, column).select("query_id", "record_id", (F.col("score") * weight).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("query_id", "record_id").agg(F.sum("score").alias("score"))


def underfilled(hits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, missing) of queries that have fewer than k hits."""
    n = hits.groupBy("query_id").agg(F.count("*").alias("n"))
    return queries.select("query_id").join(n, "query_id", "left").select("query_id", (k - F.coalesce("n", F.lit(0))).alias("missing")).where("missing > 0")


def best_per_record(hits: DataFrame, ascending: bool) -> DataFrame:
    """One hit a record, the best, ranked anew; ``underfilled`` tells which queries lost hits by it."""
    agg = F.min("score") if ascending else F.max("score")
    best = hits.groupBy("query_id", "record_id").agg(agg.alias("score"))
    order = F.asc("score") if ascending else F.desc("score")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "record_id")).cast("long"))


def rrf(legs: list[DataFrame], k: int, constant: int = RRF_K, digits: int = 12) -> DataFrame:
    """Reciprocal rank fusion of legs (query_id, record_id, rank)."""
    rows = legs[0].select("query_id", "record_id", "rank")
    for leg in legs[1:]:
        rows = rows.unionByName(leg.select("query_id", "record_id", "rank"))
    fused = rows.groupBy("query_id", "record_id").agg(F.round(F.sum(1.0 / (constant + F.col("rank"))), digits).alias("score"))
    return top_k(fused, k, F.desc("score"))


def normalised_leg(leg: DataFrame, ascending: bool) -> DataFrame:
    """Scores scaled to 0..1 within a query, 1 for the best; a leg of equal scores is all 1."""
    w = Window.partitionBy("query_id")
    low, high = F.min("score").over(w), F.max("score").over(w)
    unit = (high - F.col("score") if ascending else F.col("score") - low) / (high - low)
    return leg.select("query_id", "record_id", F.when(high == low, 1.0).otherwise(unit).alias("norm"))


def weighted(vector_leg: DataFrame, text_leg: DataFrame, weight: float, k: int, digits: int = 12) -> DataFrame:
    """weight * vector + (1 - weight) * text over normalised legs (query_id, record_id, score); an absent leg is 0."""
    v = normalised_leg(vector_leg, True).withColumn("norm", F.col("norm") * weight)
    t = normalised_leg(text_leg, False).withColumn("norm", F.col("norm") * (1 - weight))
    fused = v.unionByName(t).groupBy("query_id", "record_id").agg(F.round(F.sum("norm"), digits).alias("score"))
    return top_k(fused, k, F.desc("score"))


def hybrid(vector_leg: DataFrame, text_leg: DataFrame, mode: str, k: int) -> DataFrame:
    """Fuse a distance leg and a score leg as the mode says."""
    if MODES[mode] is None:
        return rrf([vector_leg, text_leg], k)
    return weighted(vector_leg.select("query_id", "record_id", F.col("distance").alias("score")), text_leg, MODES[mode], k)
