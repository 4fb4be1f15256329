import hashlib
import random
import struct
import time
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import digest as D
from tidemark.functions import predicates as P
from tidemark.functions import vectors as V
from tidemark.operators import cdc, layout, lineage, search
from tidemark.plans.spec import DatasetSpec, Field, Index, SpecError, default_spec
from tidemark.sources.vecfiles import encode_bin, encode_vecs, read_bin, read_vecs
from tidemark.sources.versions import VersionConflict, VersionedTable, discover
from tidemark.streaming.fold import StreamFold

STATE = "k string, source_sequence long, event_digest string, is_deleted boolean, x string"


def state(spark, rows):
    return spark.createDataFrame(rows, STATE)


def test_merge_is_the_fold_of_a_dict_and_replays_change_nothing(spark):
    rng = random.Random(7)
    target, want = state(spark, []), {}
    for batch in range(3):
        rows = {}
        for _ in range(40):
            k, seq = f"k{rng.randrange(25)}", rng.randrange(100)
            rows[k] = (k, seq, f"{k}-{seq}", rng.random() < 0.2, f"x{seq}")
        for k, r in rows.items():
            if k not in want or want[k][1] < r[1]:
                want[k] = r
        source = state(spark, list(rows.values()))
        target = spark.createDataFrame(cdc.merge(target, source, ["k"]).collect(), STATE)
        assert cdc.advancing(target, source, ["k"]).isEmpty()
        assert cdc.unreconciled(target, source, ["k"]).isEmpty()
        assert cdc.same_sequence_conflicts(target, source, ["k"]).isEmpty()
    assert {tuple(r) for r in target.collect()} == set(want.values())


def test_tombstone_keeps_its_sequence(spark):
    a = state(spark, [("k", 5, "d5", True, None)])
    old, new = state(spark, [("k", 4, "d4", False, "x")]), state(spark, [("k", 6, "d6", False, "y")])
    assert cdc.merge(a, old, ["k"]).first().is_deleted
    assert not cdc.merge(a, new, ["k"]).first().is_deleted


@pytest.mark.parametrize("op", ["\tinsert", "remove", "", None])
def test_unknown_operations(spark, op):
    df = spark.createDataFrame([(op,)], "op string")
    assert not df.select(cdc.valid_operation(F.col("op"))).first()[0]
    with pytest.raises(Exception, match="unknown operation"):
        df.select(cdc.normalise_operation(F.col("op"))).collect()


def test_operation_names_are_trimmed_and_folded(spark):
    df = spark.createDataFrame([(" Insert ",), ("D",), ("u",)], "op string")
    assert [r[0] for r in df.select(cdc.normalise_operation(F.col("op"))).collect()] == ["upsert", "delete", "upsert"]


def test_retention_keeps_rows_without_a_time(spark):
    rows = spark.createDataFrame([(None, False), (1, False), (99, False), (1, True), (60, True)], "us long, is_deleted boolean")
    kept = cdc.retained(rows, F.col("us"), 100, 10, 50).collect()
    assert {tuple(r) for r in kept} == {(None, False), (99, False), (60, True)}
    assert cdc.retained(rows, F.col("us"), 100, 10, None).where("is_deleted").count() == 2


def test_rebuild_reports_conflicting_ties(spark):
    got = cdc.rebuild(state(spark, [("a", 1, "p", False, ""), ("a", 2, "q", False, ""), ("a", 2, "r", False, ""), ("b", 2, "s", True, ""), ("b", 2, "s", True, "")]), ["k"]).collect()
    assert {(r.k, r.n_digests) for r in got} == {("a", 2), ("b", 1)}


def test_event_digest_bytes(spark):
    ts = datetime(1969, 12, 31, 23, 59, 59, 999999)
    df = spark.createDataFrame([("t", "n", "ö", "kéy", ts, None, "", 7, [1.5, -2.0])], "a string, b string, c string, k string, ts timestamp_ntz, n string, e string, i long, v array<double>")
    fields = {"é": (F.col("e"), "string"), "n": (F.col("n"), "string"), "i": (F.col("i"), "long"), "v": (F.col("v"), "list")}
    got = df.select(D.event_digest(("a", "b", "c"), "k", F.lit("upsert"), "ts", fields)).first()[0]
    text = lambda s: struct.pack(">Q", len(s.encode())) + s.encode()
    values = {"é": b"s" + text(""), "n": b"n", "i": b"i" + struct.pack(">q", 7), "v": b"l" + struct.pack(">Q", 2) + b"f" + struct.pack(">d", 1.5) + b"f" + struct.pack(">d", -2.0)}
    body = D.EVENT_HEADER.encode() + b"".join(map(text, ("t", "n", "ö", "kéy", "upsert"))) + struct.pack(">q", -1) + b"m" + struct.pack(">Q", 4)
    for k in sorted(values, key=str.encode):
        body += text(k) + values[k]
    assert got == hashlib.sha256(body).hexdigest()


def test_filters_reject_what_is_not_allowed():
    ok = {"op": "compare", "column": "a", "cmp": "eq", "value": 1}
    for bad in ({"op": "compare", "column": "a; drop", "cmp": "eq", "value": 1}, {"op": "compare", "column": "b", "cmp": "eq", "value": 1}, {"op": "in", "column": "a", "values": []}, {"op": "and", "children": []}, {"op": "compare", "column": "a", "cmp": "eq", "value": float("nan")}, {"op": "like"}):
        with pytest.raises(P.FilterError):
            P.compile_filter(bad, ["a"])
    deep = ok
    for _ in range(P.MAX_DEPTH + 1):
        deep = {"op": "not", "child": deep}
    with pytest.raises(P.FilterError):
        P.compile_filter(deep, ["a"])
    for bad_k in (0, P.MAX_K + 1):
        with pytest.raises(P.FilterError):
            P.check_k(bad_k)
    with pytest.raises(P.FilterError):
        P.projection(["k", "a"], ["k"], "k", "dead", set())


def test_not_in_with_null_is_null(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "a string")
    assert [r.a for r in df.where(P.compile_filter({"op": "in", "column": "a", "values": ["x"], "negated": True}, ["a"])).collect()] == ["y"]


def test_distances_at_the_edges(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    got = df.select(*[V.distance(m, F.col("a"), F.col("b")) for m in V.METRICS]).first()
    assert list(got) == [5.0, 1.0, 0.0, 2.0]
    assert not spark.createDataFrame([([1.0, float("inf")],)], "a array<double>").select(V.finite(F.col("a"))).first()[0]


def test_fusion_golden_numbers(spark):
    leg = lambda ids: spark.createDataFrame([(1, i, r + 1) for r, i in enumerate(ids)], "query_id long, record_id long, rank int")
    got = {r.record_id: r.score for r in search.rrf([leg([1, 2]), leg([2, 3])], 10).collect()}
    assert got == {2: round(1 / 62 + 1 / 61, 12), 1: round(1 / 61, 12), 3: round(1 / 62, 12)}
    scored = lambda rows: spark.createDataFrame([(1, i, s) for i, s in rows], "query_id long, record_id long, score double")
    got = {r.record_id: r.score for r in search.weighted(scored([(1, 0.0), (2, 1.0)]), scored([(3, 5.0), (2, 1.0)]), 0.6, 10).collect()}
    assert got == {1: 0.6, 3: 0.4, 2: 0.0}
    assert {r.norm for r in search.normalised_leg(scored([(1, 3.0), (2, 3.0)]), True).collect()} == {1.0}


def test_nearest_centroid_takes_the_lowest_of_equals_and_null_goes_last(spark):
    v = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "record_id long, vector array<double>")
    c = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0])], "pid long, centroid array<double>")
    assert dict(map(tuple, search.nearest_centroid(v, c).collect())) == {1: 0, 2: 2}


def test_packing_against_its_definition():
    assert layout.pack([0, 3, 3, 9, 0, 2, 4], 6) == [(1, 2, 0, 1), (3, 3, 0, 2), (3, 3, 1, 2), (5, 6, 0, 1)]
    rng = random.Random(1)
    for _ in range(200):
        h = [rng.randrange(8) for _ in range(12)]
        out = layout.pack(h, 5)
        assert sum(sum(h[a : b + 1]) for a, b, s, _ in out if s == 0) == sum(h)
        assert all(n > 1 or sum(h[a : b + 1]) <= 5 for a, b, _, n in out)
    with pytest.raises(ValueError):
        layout.pack([1], 0)
    assert (layout.partition_count(100), layout.partition_count(10**6)) == (16, 122)


def test_lineage_walk():
    chain = {1: (None, 1), 2: (1, 2), 3: (2, 5)}
    assert lineage.walk(chain, 3, 1) == [2, 3]
    for bad, head in (({1: (2, 1), 2: (1, 2)}, 2), ({2: (1, 2)}, 2), ({1: (None, 5), 2: (1, 5)}, 2)):
        with pytest.raises(lineage.LineageError):
            lineage.walk(bad, head, None)


def test_bounded_collect(spark):
    assert len(lineage.bounded(spark.range(5), 5)) == 5
    with pytest.raises(lineage.LineageError):
        lineage.bounded(spark.range(6), 5)


def test_spec_rules():
    s = default_spec()
    assert s.digest() == default_spec().digest() != default_spec(64).digest()
    assert [i.kind for i in s.index_targets()] == ["IVF", "BTREE", "INVERTED"]
    for bad in (lambda: default_spec(12), lambda: DatasetSpec(s.fields[1:]), lambda: DatasetSpec(s.fields + (Field("text", "TEXT", "string"),)), lambda: DatasetSpec(s.fields, (Index("i", "IVF", "text"),))):
        with pytest.raises(SpecError):
            bad()


def test_versions_are_immutable_and_guarded(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.read() is None
    t.write(spark.range(3), None)
    t.write(spark.range(4), 1)
    assert (t.read().count(), t.read(1).count(), t.read(9)) == (4, 3, None)
    with pytest.raises(VersionConflict):
        t.write(spark.range(5), 1)
    assert t.clean(1) == [] and t.clean(1, now=time.time() + 7 * 3600) == [1] and t.versions() == [2]
    with pytest.raises(ValueError):
        t.clean(1, horizon=60)


def test_versions_share_folders_and_keep_marks_and_tags(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.write(spark.range(3), None, marks={"a": 1})
    t.append(spark.range(3, 5), 1, marks={"b": 2})
    assert t.marks() == {"a": 1, "b": 2} and t.marks(1) == {"a": 1} and sorted(r.id for r in t.read().collect()) == list(range(5))
    t.tag("served", 1)
    t.tag("served", 2)
    t.tag("held", 1)
    assert t.tags() == {"served": 2, "held": 1}
    with pytest.raises(ValueError):
        t.tag("served", 9)
    late = time.time() + 7 * 3600
    assert t.clean(1, now=late) == []  # tagged
    t.tag("held", 2)
    assert t.clean(1, now=late) == [1] and t.read().count() == 5  # its folder belongs to version 2 too
    t.stage(spark.range(1))
    assert t.remove_orphans() == [] and len(t.remove_orphans(now=late)) == 1 and t.read().count() == 5
    assert discover(spark, f"file://{tmp_path}") == [f"file://{tmp_path}/t"]


def test_one_of_two_writers_publishes(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.write(spark.range(1), None)
    a, b = t.stage(spark.range(2)), t.stage(spark.range(3))
    assert t.read().count() == 1  # staged rows, and those of a writer that stopped, are not seen
    assert t._claim(2, '{"folders": ["%s"], "marks": {}}' % a) and not t._claim(2, "{}")
    with pytest.raises(VersionConflict):
        t.publish([b], 1)
    assert t.read().count() == 2 and t.versions() == [1, 2] and t.folders(2) == [a]


def test_vector_files(spark, tmp_path):
    rng = np.random.default_rng(0)
    f, u = rng.normal(size=(10, 8)).astype(np.float32), rng.integers(0, 255, (10, 8)).astype(np.uint8)
    (tmp_path / "a.fvecs").write_bytes(encode_vecs(f))
    (tmp_path / "a.u8bin").write_bytes(encode_bin(u))
    got = read_vecs(spark, f"file://{tmp_path}/a.fvecs", 8, start=2, count=3).orderBy("position").collect()
    assert [r.position for r in got] == [2, 3, 4] and np.allclose([r.vector for r in got], f[2:5])
    got = read_bin(spark, f"file://{tmp_path}/a.u8bin", "uint8", 7).orderBy("position").collect()
    assert [r.vector for r in got] == u[7:].astype(int).tolist()


def test_retry_delay_is_capped_and_repeats():
    a = layout.retry_delay(3, "w", 1.0, 60.0)
    assert a == layout.retry_delay(3, "w", 1.0, 60.0) and 0 <= a <= 4
    assert layout.retry_delay(50, "w", 1.0, 60.0) <= 60


def test_a_vector_of_another_dimension_is_an_error(spark):
    v = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0])], "record_id long, vector array<double>")
    q = spark.createDataFrame([(1, [0.0, 0.0])], "query_id long, vector array<double>")
    with pytest.raises(Exception, match="different dimensions"):
        search.knn(v, q, 2, "l2").collect()


def test_stream_batches_are_known_by_stream_and_number(spark, tmp_path):
    fold = StreamFold(spark, f"file://{tmp_path}/s", ["k"])
    keys = lambda: {r.k for r in fold.state.read().collect()}
    fold.merge_batch(state(spark, [("a", 1, "d1", False, "x")]), 0, "one")
    base = fold.state.current()
    fold.state.write(fold.state.read().coalesce(1), base)  # a compaction between two batches
    fold.merge_batch(state(spark, [("b", 2, "d2", False, "x")]), 1, "one")
    assert keys() == {"a", "b"}
    before = fold.state.current()
    fold.merge_batch(state(spark, [("c", 3, "d3", False, "x")]), 1, "one")  # a replay of batch 1
    assert fold.state.current() == before
    fold.merge_batch(state(spark, [("c", 3, "d3", False, "x")]), 0, "two")  # a new checkpoint over old state
    assert keys() == {"a", "b", "c"} and fold.state.marks() == {"stream-one": 1, "stream-two": 0}


def test_a_batch_that_loses_to_another_writer_is_merged_again(spark, tmp_path, monkeypatch):
    fold = StreamFold(spark, f"file://{tmp_path}/s", ["k"])
    fold.merge_batch(state(spark, [("a", 1, "d1", False, "x")]), 0)
    stage, done = VersionedTable.stage, []

    def late(self, rows, partition_by=()):
        out = stage(self, rows, partition_by)
        if not done:
            done.append(1)
            self.write(self.read().coalesce(1), self.current())
        return out

    monkeypatch.setattr(VersionedTable, "stage", late)
    fold.merge_batch(state(spark, [("b", 2, "d2", False, "x")]), 1)
    assert {r.k for r in fold.state.read().collect()} == {"a", "b"} and fold.state.versions() == [1, 2, 3]


def test_documents_are_scored_once_a_set_of_terms(spark):
    docs = spark.createDataFrame([(i, f"common word{i % 3} {'rare ' * (i % 4)}") for i in range(40)] + [(40, None)], "record_id long, text string")
    asked = {0: ["common", "rare"], 1: ["word1"], 2: ["rare", "common", "rare"], 3: ["absent"], 4: ["word1", None], 5: ["word1"]}
    terms = spark.createDataFrame([(q, t) for q, ts in asked.items() for t in ts], "query_id long, term string")
    assert dict(map(tuple, search.same_terms(terms).collect())) == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4, 5: 1}
    rows = lambda df: sorted(map(tuple, df.collect()))
    for operator in ("or", "and"):
        got = search.bm25(docs, terms, 5, operator)
        assert rows(got) == rows(search.best(search.bm25_scores(docs, terms), terms, 5, operator))
        assert {r.query_id for r in got.collect()} == ({0, 1, 2, 4, 5} if operator == "or" else {0, 1, 2, 5})
    counted = {r.query_id: r.matched for r in search.bm25_counted(docs, terms, 5).collect()}
    assert counted == {0: 40, 1: 13, 2: 40, 4: 13, 5: 13}


def test_bm25_reads_the_documents_once(spark, tmp_path):
    spark.range(50).selectExpr("id as record_id", "concat('common word', id % 3) as text").write.parquet(f"file://{tmp_path}/d")
    docs = spark.read.parquet(f"file://{tmp_path}/d")
    terms = spark.createDataFrame([(q, f"word{q % 3}") for q in range(30)], "query_id long, term string")
    for df in (search.bm25(docs, terms, 5), search.bm25_counted(docs, terms, 5)):
        assert len(df.collect()) == 150
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan parquet") == 1
