"""Grading served rankings against exact ones, and reports over the grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grades(true: Column, got: Column, k: Column, candidates: Column) -> tuple[Column, Column, Column]:
    """(recall, ndcg, mrr) of served ids against the true ones, both best first, for one row.

    recall counts hits of the true first k; ndcg grades by true rank and counts a record served
    twice once; mrr looks for the true first."""
    true, got = F.slice(true, F.lit(1), k), F.slice(F.array_distinct(got), F.lit(1), k)
    n = F.size(true)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
    grade = F.transform(got, lambda x, i: F.when(F.array_position(true, x) > 0, (n - F.array_position(true, x) + 1).cast("double")).otherwise(0.0) / F.log2(i + F.lit(2.0)))
    ideal = F.transform(true, lambda _, i: (n - i).cast("double") / F.log2(i + F.lit(2.0)))
    first = F.array_position(got, F.try_element_at(true, F.lit(1)))
    some = n > 0
    return (
        F.when(some, F.size(F.array_intersect(true, got)) / F.least(k, candidates)),
        F.when(some, total(grade) / total(ideal)),
        F.when(some, F.when(first > 0, 1.0 / first).otherwise(0.0)),
    )


def ranking_quality(served: DataFrame, truth: DataFrame, k: int, digits: int = 12) -> DataFrame:
    """(query_id, candidates, recall, ndcg, mrr, skip) for lists served(query_id, ids) and truth(query_id, ids).

    See ``grades``; a query without candidates is skipped."""
    rows = truth.select("query_id", F.col("ids").alias("true"), F.size("ids").alias("candidates")).join(served.select("query_id", F.col("ids").alias("got")), "query_id")
    found = grades(F.col("true"), F.col("got"), F.lit(k), F.col("candidates"))
    named = [F.round(g, digits).alias(name) for name, g in zip(("recall", "ndcg", "mrr"), found, strict=True)]
    return rows.select("query_id", "candidates", *named, F.when(F.size("true") == 0, "empty_candidate_set").alias("skip"))


def report(scores: DataFrame, measure: str, groups: list[str], digits: int = 9) -> DataFrame:
    """Count, mean, median and 95th percentile of a measure overall and by each group, in one pass over grouping sets."""
    level = F.lit("overall")
    for i, g in enumerate(groups):
        level = F.when(F.grouping_id() == (1 << len(groups)) - 1 - (1 << (len(groups) - 1 - i)), g).otherwise(level)
    label = F.coalesce(*[F.col(g).cast("string") for g in groups], F.lit("all"))
    numbers = [F.count(measure).alias("n"), *(F.round(f, digits).alias(a) for f, a in ((F.avg(measure), "mean"), (F.percentile(measure, 0.5), "p50"), (F.percentile(measure, 0.95), "p95")))]
    found = scores.groupingSets([[], *[[g] for g in groups]], *groups).agg(level.alias("level"), *numbers)
    return found.select("level", label.alias("bucket"), "n", "mean", "p50", "p95")


def differences(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, problem, columns): keys that only one side has (missing, unexpected), or both with other values, and of which
    columns.  Keys and values are compared with null equal to null; a key twice on a side is compared with all of the other's."""
    values = [c for c in expected.columns if c not in keys]
    e = expected.select(*[F.col(k).alias(f"e_{k}") for k in keys], F.struct(*values, F.lit(True).alias("_there")).alias("e"))
    a = actual.select(*[F.col(k).alias(f"a_{k}") for k in keys], F.struct(*values, F.lit(True).alias("_there")).alias("a"))
    on = [F.col(f"e_{k}").eqNullSafe(F.col(f"a_{k}")) for k in keys]
    rows = e.join(a, on, "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}")), c) for c in values])) if values else F.array().cast("array<string>")
    problem = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "unexpected").when(F.size(changed) > 0, "changed")
    columns = F.when(problem == "changed", F.array_join(changed, ","))
    named = [F.when(F.col("e").isNull(), F.col(f"a_{k}")).otherwise(F.col(f"e_{k}")).alias(k) for k in keys]
    return rows.select(*named, problem.alias("problem"), columns.alias("columns")).where("problem is not null")


def sampled(rows: DataFrame, order: str, by: str, rate: float) -> DataFrame:
    """Every 1/rate-th row of each group, evenly: the n-th is taken when floor(n * rate) grows."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return rows.withColumn("_n", n).where(F.floor(F.col("_n") * rate) > F.floor((F.col("_n") - 1) * rate)).drop("_n")
