import os
import sys

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]
import pytest  # noqa: E402
from oracle import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, name):
    compare(spark, connect(SF), registry.QUERIES[name], registry.ORACLES[name], SF)


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, SF).collect()
        assert rows and list(rows[0].asDict()) == columns, name
        docs = spark.createDataFrame(rows, docs.schema)
        assert name in ("mixing", "toxicity") or len(rows) < n
        n = len(rows)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).orderBy("start").collect()
    assert len(out) == n and [r.start for r in out] == [sum(x.n_tokens for x in out[:i]) for i in range(n)]


def test_run(spark):
    assert set(corpus_pipeline.run(spark, SF).columns) == {"doc_id", "start", "n_tokens", "ids_crc32"}


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, sources and texts, one id twice, a row three times, blanks, and columns with names that operators use."""
    t = " ".join(f"w{i}" for i in range(50))
    rows = [(None, t, None), (None, None, "s"), (7, t, "s"), (7, "other words of its own here", "s"), (3, t + " more", "s"), (3, t + " more", "s"), (3, t + " more", "s"), (4, "", "s"), (5, " \n\t ", None), (6, "word " * 20_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'en' as lang", "1L as n_chars")
    for c in ("key", "bits", "u", "copy", "times", "shingles", "__hi", "__c0", "score", "hit", "part", "start"):
        df = df.selectExpr("*", f"'clash' as `{c}`")
    return df


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_and_empty_tables(spark, odd, name, stage):
    out = stage(spark, odd, SF)
    got = sorted(((r.doc_id, r.text) for r in out.collect()) if name != "tokens" else ((r.doc_id, r.n_tokens > 1) for r in out.collect()), key=str)
    t = " ".join(f"w{i}" for i in range(50))
    every = [(r.doc_id, r.text) for r in odd.collect()]
    if name == "tokens":
        assert got == sorted(((d, bool(x)) for d, x in every), key=str)
        assert stage(spark, odd.limit(0), SF).count() == 0
        return
    assert out.columns == odd.columns and stage(spark, odd.limit(0), SF).count() == 0
    if name in ("toxicity", "decontamination"):
        assert got == sorted(every, key=str)
    elif name == "near_duplicates":
        assert got == sorted([(3, t + " more"), (7, "other words of its own here"), (None, None), (4, ""), (5, " \n\t "), (6, "word " * 20_000)], key=str)
    else:
        assert set(got) <= {x for x in every if (x[1] or "").strip()}
        assert all(got.count(x) <= 2 * every.count(x) for x in set(got))


def test_stages_are_those_of_a_brute_force_version(spark):
    """The second, third and fourth stage on what the first keeps, each held against its definition."""
    import helpers as H

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = H.components(rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, (n, c) in want.items() if not n or i == c)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [(r.doc_id, r.text) for r in kept]
    clean = corpus_pipeline.decontamination(spark, spark.createDataFrame(kept, docs.schema), SF).collect()
    dirty = {i for i, x in H.contamination(left, items).items() if x[4]}
    assert sorted(r.doc_id for r in clean) == sorted(i for i, _ in left if i not in dirty)
    mixed = corpus_pipeline.mixing(spark, spark.createDataFrame(clean, docs.schema), SF).collect()
    size = {r.doc_id: len(H.SPACED.findall(r.text or "")) for r in clean}
    of = {r.doc_id: r.source for r in clean}
    total, taken = {}, {}
    for i, n in size.items():
        total[of[i]] = total.get(of[i], 0) + n
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id]
    weights = {s: (5, 2, 1)[j % 3] for j, s in enumerate(sorted(total))}
    target, open_, rest = {}, set(total), 1.5 * sum(total.values())
    while True:
        level = rest / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * total[s]}
        if not over:
            break
        for s in over:
            target[s] = 2 * total[s]
            rest -= target[s]
        open_ -= over
    target |= {s: level * weights[s] for s in open_}
    assert all(abs(taken.get(s, 0) - target[s]) <= max(n for i, n in size.items() if of[i] == s) for s in total)
