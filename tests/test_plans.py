import gzip
import struct

import numpy as np
import pytest

from tidemark.plans.spec import SpecError, check_checkpoint, check_partitions
from tidemark.plans.text_query import TextQueryError, compile_text_query, field_clauses
from tidemark.sources import samples, scans
from tidemark.sources.artifacts import ArtifactConflict, Artifacts, identity
from tidemark.sources.vecfiles import convert_bvecs, encode_bin


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "the quick brown fox", "a"), (2, "a quick red fox jumps", "fox"), (3, "slow brown bear", None), (4, None, "fox bear"), (5, "", "")], "record_id long, text string, tag string")


def ids(df):
    return [r.record_id for r in df.orderBy("record_id").collect()]


def test_tree_nodes(docs):
    m = lambda q, **more: {"match": {"query": q, **more}}
    assert ids(compile_text_query(docs, m("quick bear"))) == [1, 2, 3]
    assert ids(compile_text_query(docs, m("quick brown", operator="and"))) == [1]
    assert ids(compile_text_query(docs, m("quikc", fuzziness=2, prefix_length=1))) == [1, 2]
    assert ids(compile_text_query(docs, m("fox", column="tag"))) == [2, 4]
    assert ids(compile_text_query(docs, {"multi_match": {"query": "fox", "columns": {"text": 1.0, "tag": 2.0}}})) == [1, 2, 4]
    assert ids(compile_text_query(docs, {"phrase": {"query": "quick fox", "slop": 0}})) == []
    assert ids(compile_text_query(docs, {"phrase": {"query": "quick fox", "slop": 1}})) == [1, 2]
    assert ids(compile_text_query(docs, {"boolean": {"must": [m("fox")], "must_not": [m("red")], "should": [m("brown")]}})) == [1]
    got = {r.record_id: r.score for r in compile_text_query(docs, {"boost": {"positive": m("fox"), "negative": m("red")}}).collect()}
    plain = {r.record_id: r.score for r in compile_text_query(docs, m("fox")).collect()}
    assert got[1] == plain[1] and got[2] == plain[2] * 0.5
    for bad in ({"match": {"query": "..."}}, {"boolean": {}}, {"boolean": {"must_not": [m("a")]}}, {"other": {}}, {}):
        with pytest.raises(TextQueryError):
            compile_text_query(docs, bad)
    deep = m("fox")
    for _ in range(40):
        deep = {"boolean": {"must": [deep]}}
    with pytest.raises(TextQueryError):
        compile_text_query(docs, deep)


def test_samples_say_why_they_are_skipped(spark):
    raw = ['{"sample_id":"a","k":2,"query_vector":[1],"result_ids":[1,2],"captured_at_unix_ms":5}', "{broken", '{"sample_id":"b","k":0}', '{"sample_id":"c","k":1,"query_type":"text"}', '{"sample_id":"d","k":1}', '{"sample_id":"e","k":1,"query_type":"graph"}', None]
    parsed = samples.parse(spark.createDataFrame([(r,) for r in raw], "attributes string"))
    assert {r.reason: r.n for r in samples.reasons(parsed).collect()} == {"ok": 2, "unparsable": 2, "bad_k": 1, "missing_vector": 1, "unknown_type": 1}
    assert samples.between(parsed, 0, 6, 10).count() == 1 and samples.between(parsed, 6, 9, 10).count() == 0


def test_artifacts_are_written_once(spark, tmp_path):
    a = Artifacts(spark, f"file://{tmp_path}/a")
    assert a.put("m.json", {"b": 1, "a": "é"}) == a.put("m.json", {"a": "é", "b": 1})
    assert a.get("m.json") == {"a": "é", "b": 1} and a.get("none") is None
    with pytest.raises(ArtifactConflict):
        a.put("m.json", {"a": 2})
    assert a.complete("r", 3, "x") and not a.complete("r", 3, "x") and not a.complete("r", 2, "y") and a.complete("r", 4, "z")
    with pytest.raises(ArtifactConflict):
        a.complete("r", 3, "other")
    assert identity("a", "b") == identity("a", "b") != identity("ab", "")


def test_clauses_that_can_be_replayed():
    both = ["text", "tag"]
    assert field_clauses({"match": {"query": "A b a", "operator": "and", "boost": 2}}, both) == [("text", ["a", "b"], "and", 2.0)]
    assert field_clauses({"multi_match": {"query": "x", "columns": {"text": 1, "tag": 3}}}, both) == [("text", ["x"], "or", 1.0), ("tag", ["x"], "or", 3.0)]
    for bad in ({"phrase": {"query": "a"}}, {"match": {"query": "a", "fuzziness": 1}}, {"match": {"query": ""}}, {"match": {"query": "a", "column": "none"}}, {"multi_match": {"query": "a"}}, {}):
        with pytest.raises(TextQueryError):
            field_clauses(bad, both)


def test_contracts_of_tables():
    check_partitions([("tenant_id", "identity")], [("tenant_id", "identity")])
    with pytest.raises(SpecError):
        check_partitions([("tenant_id", "identity"), ("day", "day")], [("day", "day"), ("tenant_id", "identity")])
    mark = {"table_uuid": "u", "spec_id": 1, "schema_digest": "d"}
    check_checkpoint("u", 1, "d", mark)
    for bad in (("v", 1, "d"), ("u", 2, "d"), ("u", 1, "e")):
        with pytest.raises(SpecError):
            check_checkpoint(*bad, mark)


def test_source_layout_is_checked(spark, tmp_path):
    rows = spark.createDataFrame([("t", "n", "o", 1, "r", 1)], "tenant_id string, namespace string, org_id string, window_seq long, record_id string, source_sequence long")
    scans.write_source(rows, f"file://{tmp_path}/a")
    scans.check_partitioning(rows, f"file://{tmp_path}/a")
    rows.write.partitionBy("tenant_id").parquet(f"file://{tmp_path}/b")
    with pytest.raises(ValueError):
        scans.check_partitioning(rows, f"file://{tmp_path}/b")
    files = scans.fragments(spark.range(100).repartition(5).transform(lambda d: (d.write.parquet(f"file://{tmp_path}/c"), spark.read.parquet(f"file://{tmp_path}/c"))[1]))
    assert sorted(r.shard for r in scans.round_robin(files, 2).collect()) == [0, 0, 0, 1, 1]


def test_gzipped_vectors_are_converted_and_gone_on_with(tmp_path):
    a = np.random.default_rng(0).integers(0, 255, (50, 8)).astype(np.uint8)
    raw = b"".join(struct.pack("<i", 8) + r.tobytes() for r in a)
    with gzip.open(tmp_path / "x.gz", "wb") as f:
        f.write(raw)
    target = str(tmp_path / "x.u8bin")
    assert convert_bvecs(str(tmp_path / "x.gz"), target, 8, rows=20, block=7) == 20
    with open(target, "ab") as f:
        f.write(b"cut")  # an unfinished row
    assert convert_bvecs(str(tmp_path / "x.gz"), target, 8, block=7) == 50
    assert (tmp_path / "x.u8bin").read_bytes() == encode_bin(a)
    with pytest.raises(ValueError):
        convert_bvecs(str(tmp_path / "x.gz"), str(tmp_path / "y"), 12)
