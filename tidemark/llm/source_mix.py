"""Mixing sources to target weights by Pareto order sampling.

A source's target fixes how many of its words are wanted.  A document's multiplicity, how
often it is wanted on average, grows with the binary digits of its size, up to ``most``, at a
rate that makes the source's words meet its target.  The whole copies in it are certain; the
rest is the document's inclusion probability in a sample of fixed size in words, drawn by
Pareto order sampling: documents are ranked by the odds of a uniform number (a hash of the
id, so reruns agree) over the odds of inclusion, and the lowest ranks are taken until their
words meet what is left of the target.

Multiplicities only depend on source and digits, so they come from a table of a few rows a
source.  The cut of a source is found without sorting the source in one task: words are
summed over narrow bands of the rank, and only the band that holds the cut is ranked row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import join_hot
from tidemark.llm.runtime import Stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Rows that a band of the rank holds on average, and bands of a source at most.
BAND_ROWS, BANDS = 1000, 1 << 20
#: Rows of a table with a row a source and size class that are broadcast at most, about 100 bytes each.
BROADCAST_ROWS = 50_000
_UNIT = float(1 << 52)


def size_of(text: str | Column) -> Column:
    """The number of words [^\\x20\\x09-\\x0D]+ ; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def uniform(id_col: str) -> Column:
    """A number in (0, 1) that only depends on the id."""
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("|mix")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(_UNIT)


def _key(source: Column) -> Column:
    """A name of a source that null has too, and no other."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def _bits(size: Column) -> Column:
    """The binary digits of a size, none of 0."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def _joined(rows: DataFrame, keyed: DataFrame, on: list[str]) -> DataFrame:
    """Rows with the columns of their key's row in a stored table, which has the number ``n`` of rows with it.

    Up to BROADCAST_ROWS rows are broadcast, so that a source that has most rows stays where it is
    read; beyond that only those of hot keys are."""
    if keyed.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keyed), on)
    return join_hot(rows, keyed, on)


def _turns(sources: DataFrame, store: Stored, turns: int) -> DataFrame:
    """Sources with their place in code-point order, null last, modulo ``turns``; no task holds them all."""
    rows = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    rows = store.put("ordered", rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")))
    lead = rows.groupBy("part").agg(F.count("*").alias("rows"))  # a row a partition
    lead = lead.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("lead"))
    return rows.join(F.broadcast(lead), "part").withColumn("turn", F.pmod(F.col("lead") + F.col("place"), F.lit(turns))).drop("part", "place", "lead")


def source_targets(sources: DataFrame, store: Stored, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, ..., target) for rows (source, source_size, ...), one a source.

    Sources in code-point order, null last, take the weights in turn.  Targets are the
    least of ``most`` times the source's size and a common level times its weight, with
    the level at which they sum to ``share`` times all sizes.
    """
    turn = F.col("turn").cast("int") + 1
    s = _turns(sources, store, len(weights)).withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), turn)).drop("turn")
    s = store.put("weighed", s.withColumn("ratio", F.lit(float(most)) * F.col("source_size") / F.col("w")))
    kinds = s.groupBy("ratio").agg(F.sum("source_size").alias("size"), F.sum("w").alias("w"))  # a row a size, however many sources
    rank = Window.orderBy("ratio")
    before = F.coalesce(F.sum("size").over(rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(rank.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("size").over(Window.partitionBy())
    kinds = kinds.select("ratio", ((F.lit(share) * total - F.lit(float(most)) * before) / rest).alias("level"))
    level = kinds.where("level <= ratio").agg(F.min(F.struct("ratio", "level")).getField("level")).first()[0]
    target = F.lit(float(most)) * F.col("source_size")
    return s.drop("ratio").withColumn("target", F.least(target, F.lit(level) * F.col("w")) if level is not None else target).drop("w")


def _odds(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds."""
    return (u / (1 - u)) / (p / (1 - p))


def source_plan(store: Stored, sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """What is taken of each size class of each source: (key, bits, n, source_size, target, copies, p, all, cut, least).

    ``copies`` of each document are certain.  One more is taken of documents with p > 0 whose rank is not above
    ``cut``, or, if that is null, below ``least``, or of all if ``all``.  sized: (key, source, size, bits, u).
    """
    kinds = store.put("kinds", sized.groupBy("key", "bits").agg(F.max("source").alias("source"), F.count("*").alias("n"), F.sum("size").alias("words")))
    sources = kinds.groupBy("key").agg(F.max("source").alias("source"), F.sum("words").alias("source_size"))
    targets = store.put("targets", source_targets(sources, store, weights, share, most).drop("source"))
    kinds = kinds.drop("source").join(targets, "key")
    down = Window.partitionBy("key").orderBy(F.desc("bits"))  # at most 64 rows a source
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight = F.sum(F.col("bits") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    kinds = kinds.withColumn("rate", F.when(weight > 0, (F.col("target") - F.lit(float(most)) * above) / weight))
    rate = F.first(F.when(F.col("rate") * F.col("bits") <= float(most), F.col("rate")), ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    times = F.when(F.col("bits") > 0, F.least(F.lit(float(most)), F.coalesce(rate, F.lit(float(most))) * F.col("bits"))).otherwise(0.0)
    kinds = kinds.withColumn("times", times).withColumn("copies", F.floor("times")).withColumn("p", F.col("times") - F.col("copies"))
    kinds = kinds.withColumn("rest", F.col("target") - F.sum(F.col("copies") * F.col("words")).over(Window.partitionBy("key")))
    kinds = kinds.withColumn("bands", F.least(F.lit(BANDS), F.ceil(F.sum(F.when(F.col("p") > 0, F.col("n"))).over(Window.partitionBy("key")) / BAND_ROWS)))
    kinds = store.put("plan", kinds.select("key", "bits", "n", "source_size", "target", "copies", "p", "rest", "bands"))
    open_ = kinds.where("p > 0 and rest > 0").select("key", "bits", "n", "p", "rest", "bands")
    ranked = _joined(sized.select("key", "bits", "size", "u"), open_, ["key", "bits"]).withColumn("rank", _odds(F.col("u"), F.col("p")))
    ranked = ranked.withColumn("band", F.floor(F.col("bands") * (F.col("rank") / (1 + F.col("rank")))))
    bands = ranked.groupBy("key", "band").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("key").orderBy("band")  # at most BANDS rows a source
    bands = bands.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    held = bands.where("before + words > rest").groupBy("key").agg(F.min(F.struct("band", "before")).alias("b"))
    counts = open_.groupBy("key").agg(F.sum("n").alias("n"))
    held = store.put("held", held.select("key", F.col("b.band").alias("cut_band"), F.col("b.before").alias("before")).join(counts, "key"))
    inside = _joined(ranked.drop("n"), held, ["key"]).where("band = cut_band")
    inside = inside.groupBy("key", "rank").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    inside = inside.withColumn("start", F.col("before") + F.sum("words").over(Window.partitionBy("key").orderBy("rank")) - F.col("words"))
    # the rank at the cut is taken if that comes nearer to the target; if nothing of the band is, the cut lies just below it
    cut = inside.groupBy("key").agg(F.max(F.when(F.expr("start + words / 2.0D <= rest"), F.col("rank"))).alias("cut"), F.min("rank").alias("least"))
    out = kinds.join(cut, "key", "left")
    every = (F.col("p") > 0) & (F.col("rest") > 0) & F.col("least").isNull()
    p = F.when(F.col("rest") > 0, F.col("p")).otherwise(0.0)
    out = store.put("cuts", out.select("key", "bits", "n", "source_size", "target", "copies", p.alias("p"), every.alias("all"), "cut", "least"))
    store.drop("kinds", "ordered", "weighed", "targets", "plan", "held")
    return out


def _taken() -> Column:
    """How often a row is taken, by the columns of its row of ``source_plan``."""
    rank = _odds(F.col("u"), F.col("p"))
    below = F.when(F.col("cut").isNotNull(), rank <= F.col("cut")).otherwise(rank < F.col("least"))
    extra = F.when(F.col("p") <= 0, F.lit(0)).when(F.col("all"), F.lit(1)).otherwise(below.cast("int"))
    return (F.col("copies") + extra).cast("int")


def _sized(rows: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    rows = rows.withColumns({"source": F.col(source).cast("string"), "size": size_of(text), "u": uniform(id_col)})
    return rows.withColumns({"key": _key(F.col("source")), "bits": _bits(F.col("size"))})


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """What a mix to target weights takes of each document.

    Returns a row for each input row: doc_id, size, source_size, target, taken, inclusion (the
    probability of the last copy).  Null and empty texts have size 0 and are never taken.  Null is
    a source, after all others.  Rows with one id (null is an id too) and equally many digits of size in
    one source have one rank and are taken together.  An empty table gives no rows.  Columns besides
    doc_id, text and source are not looked at, whatever their names.
    """
    store = Stored(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").alias("of"))
    sized = store.put("sized", _sized(rows, "doc_id", "text", "of").select("doc_id", "key", "source", "size", "bits", "u"))
    out = _joined(sized, source_plan(store, sized, weights, share, most), ["key", "bits"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * _taken()).cast("long").alias("taken"), F.col("p").alias("inclusion"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs, whatever their names.

    Nulls, ties and repeated rows are as in ``mix_sources``; rows without words go, an empty table stays empty.
    """
    store = Stored(docs.sparkSession)
    own = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    rows = _sized(docs.toDF(*own.values()), own["doc_id"], own["text"], own["source"])
    sized = store.put("sized", rows.select("key", "source", "size", "bits", "u"))
    plan = source_plan(store, sized, weights, share, most)
    store.drop("sized")
    taken = _joined(rows, plan, ["key", "bits"]).withColumn("times", _taken()).where("times > 0")
    taken = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return taken.select(*[F.col(n).alias(c) for c, n in own.items()])


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 in turn and 150 % of all words over all documents."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, size, u, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS bits
  FROM (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|mix'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM documents
  )
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source
), r AS (
  SELECT *, 2.0::DOUBLE * source_size / w AS ratio FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1) * w) AS target FROM l
), kinds AS (
  SELECT z.source, z.bits, any_value(t.source_size) AS source_size, any_value(t.target) AS target, CAST(sum(z.size) AS BIGINT) AS words
  FROM sized z JOIN t ON z.source IS NOT DISTINCT FROM t.source GROUP BY z.source, z.bits
), rates AS (
  SELECT *, (target - 2.0::DOUBLE * coalesce(sum(words) OVER (PARTITION BY source ORDER BY bits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / nullif(sum(bits * words) OVER (PARTITION BY source ORDER BY bits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS rate
  FROM kinds
), chosen AS (
  SELECT source, arg_max(rate, bits) AS rate FROM rates WHERE rate * bits <= 2 GROUP BY source
), times AS (
  SELECT k.*, CASE WHEN k.bits > 0 THEN least(2.0::DOUBLE, coalesce(c.rate, 2.0::DOUBLE) * k.bits) ELSE 0.0::DOUBLE END AS times
  FROM kinds k LEFT JOIN chosen c ON k.source IS NOT DISTINCT FROM c.source
), plan AS (
  SELECT *, floor(times) AS copies, times - floor(times) AS p, target - sum(floor(times) * words) OVER (PARTITION BY source) AS rest FROM times
), rows AS (
  SELECT z.doc_id, z.size, z.u, p.source, p.source_size, p.target, p.copies, p.rest, CASE WHEN p.rest > 0 THEN p.p ELSE 0.0::DOUBLE END AS p
  FROM sized z JOIN plan p ON z.source IS NOT DISTINCT FROM p.source AND z.bits = p.bits
), ranked AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM rows
), cum AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY source, rank) AS peers
  FROM ranked WHERE rank IS NOT NULL
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, p AS inclusion,
       CAST(size * (copies + CASE WHEN upto - peers + peers / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM cum
UNION ALL
SELECT doc_id, CAST(size AS BIGINT), source_size, target, p, CAST(size * copies AS BIGINT) FROM ranked WHERE rank IS NULL
"""
