import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import helpers as H  # noqa: E402

from tidemark.llm import crf, decontaminate, kernel, labelled, license_scan, ngram_join, phrase_dedup, pii, quality_crf, rule_forest, source_mix, token_output, toxic_crf  # noqa: E402

LABELS = "doc_id long, quality int, toxic int, score string"


@pytest.fixture(scope="module")
def rows():
    return H.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return H.awkward(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], H.SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, an id twice with different texts, and a row twice."""
    t = " ".join(f"w{i}" for i in range(50))
    return spark.createDataFrame([(None, t, None, None, 1), (None, None, None, None, 0), (7, t, "en", "s", 1), (7, "other words here", "en", "s", 1), (3, t + " more", "en", "s", 1), (3, t + " more", "en", "s", 1)], H.SCHEMA)


def by_id(df, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in df.collect()}


# kernel


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_words_are_those_of_the_pattern(most):
    texts = ["a b  c\n\nd", "", None, "Größe x y", "  ", "ab ab\x0babc", "x" * 50, "A-b_C9 é,ö"]
    for values, pattern, fold in ((kernel.SPACED, H.SPACED, False), (kernel.SPACED_FOLDED, H.SPACED, True), (kernel.ALNUM_FOLDED, H.ALNUM, True)):
        seen = {}
        for lo, hi, buf, off in kernel.text_slices(pa.array(texts), most):
            w = kernel.split_words(buf, off, values)
            for i in range(lo, hi):
                a, b = w.rows[i - lo : i - lo + 2]
                want = pattern.findall((texts[i] or "").translate(H.LOWER) if fold else texts[i] or "")
                got = [bytes(buf[x:y]).decode() for x, y in zip(w.starts[a:b], w.ends[a:b])]
                assert [g.translate(H.LOWER) if fold else g for g in got] == want
                for word, h in zip(want, w.hashes[a:b].tolist()):
                    assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 10, 35])
def test_window_hashes_tell_sequences_apart(k):
    h = np.random.default_rng(0).integers(0, 1 << 63, 3).astype(np.uint64)[np.random.default_rng(k).integers(0, 3, 4000)]
    got, name = kernel.window_hashes(h, k).tolist(), {}
    assert len(got) == len(h) - k + 1
    for i, x in enumerate(got):
        assert name.setdefault(tuple(h[i : i + k].tolist()), x) == x
    assert len(set(name.values())) == len(name)


def test_words_that_a_polynomial_confuses():
    """Thue-Morse words and their complements, and words that differ in one place."""
    texts = [x for n in range(3, 13) for x in H.thue_morse(1 << n)] + ["x" * n for n in range(1, 200)] + ["x" * 70 + c + "x" * 70 for c in "abc"]
    for cut in (kernel.SPACED, kernel.SPACED_FOLDED, kernel.ALNUM_FOLDED):
        for seed in (kernel.SEED, kernel.SECOND_SEED):
            names = set()
            for _, _, buf, off in kernel.text_slices(pa.array(texts)):
                w = kernel.split_words(buf, off, cut)
                names |= set(kernel.hash_spans(buf, w.starts, w.ends, seed).tolist())
            assert len(names) == len(texts)


def test_same_spans():
    a, b = (np.frombuffer(x, np.uint8) for x in (b"abcdefgh" * 20 + b"q", b"abcdefgh" * 20 + b"z"))
    starts, size = np.array([0, 0, 160, 3, 8, 0]), np.array([0, 160, 1, 5, 153, 161])
    assert kernel.same_spans(a, starts, b, starts, size).tolist() == [True, True, False, True, False, False]


def test_slices_of_an_array_with_an_offset():
    a = pa.array(["skip", "a b", None, "c"]).slice(1)
    got = [(lo, hi, bytes(buf)) for lo, hi, buf, _ in kernel.text_slices(a)]
    assert got == [(0, 3, b"a bc")]


# 1


def test_join_against_all_pairs(rows, docs):
    assert by_id(ngram_join.ngram_jaccard_join(docs), "n_shingles", "component_id") == H.components(rows)


def test_join_with_many_regions(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = H.corpus(11)
    assert by_id(ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, H.SCHEMA)), "n_shingles", "component_id") == H.components(rows)


def test_no_plan_of_the_join_holds_all_levels_of_cuts(spark, monkeypatch):
    """What the driver plans and runs at once is bounded, however many levels there are."""
    from tidemark.llm.runtime import Stored

    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    exchanges, put = {}, Stored.put

    def counted(store, name, df):
        exchanges[name] = df._jdf.queryExecution().executedPlan().toString().count("Exchange")
        return put(store, name, df)

    monkeypatch.setattr(Stored, "put", counted)
    rows = H.corpus(11)
    assert by_id(ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, H.SCHEMA)), "n_shingles", "component_id") == H.components(rows)
    assert "pivots-0" in exchanges and max(exchanges.values()) <= 16, exchanges


@pytest.mark.parametrize("seed, own", [(1, 25), (2, 12), (3, 40), (4, 5)])
def test_regions_give_all_links(seed, own):
    """Clusters around several centres, with links inside and sets between them: cuts, windows and exact joins."""
    rng = np.random.default_rng(seed)
    new = lambda n: rng.integers(0, 1 << 60, n).astype(np.uint64)
    core = new(60)
    centres = [np.concatenate([core, new(60)]) for _ in range(6)]
    sets = [np.unique(np.concatenate([rng.choice(centres[rng.integers(6)], 105, replace=False), new(rng.integers(0, own))])) for _ in range(160)]
    region = ngram_join._Region(sets, [None] * 160, 75)
    region.join(np.arange(160), np.zeros(0, np.int64))
    want = ngram_join._Forest(160)
    for a in range(160):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                want.join(a, b)
    assert region.cuts > 1 and [region.forest.find(i) for i in range(160)] == [want.find(i) for i in range(160)]


def test_common_shingles_reach_a_shard_once_a_block(spark, monkeypatch):
    """Small blocks, shards and hot keys everywhere change nothing."""
    from tidemark.llm import components

    for module, name, n in ((ngram_join, "GATHER", 300), (ngram_join, "SHARD_SHINGLES", 500), (ngram_join, "BLOCK_SHINGLES", 300), (components, "HOT_ROWS", 1), (components, "HOT_SHARE", 1 << 40), (components, "BROADCAST_NODES", 0)):
        monkeypatch.setattr(module, name, n)
    rows = [r for r in H.corpus(3) if len(r[1] or "") < 50_000]
    docs = spark.createDataFrame(rows, H.SCHEMA)
    want = H.components(rows)
    assert by_id(ngram_join.ngram_jaccard_join(docs), "n_shingles", "component_id") == want
    assert sorted(r.doc_id for r in ngram_join.without_near_duplicates(docs).collect()) == sorted(i for i, (n, c) in want.items() if not n or i == c)


@pytest.mark.parametrize("nodes", [0, 1 << 20])
def test_components_of_chains_stars_and_rings(spark, monkeypatch, nodes):
    from tidemark.llm import components
    from tidemark.llm.runtime import Stored

    monkeypatch.setattr(components, "BROADCAST_NODES", nodes)
    monkeypatch.setattr(components, "HOT_ROWS", 5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(300 + i, 300 + (i + 1) % 9) for i in range(9)] + [(50, 50), (1, 2), (2, 1)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(7)
    got = {r.node: r.label for r in components.components(Stored(spark), df, "t").collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(200, 240))} | {300 + i: 300 for i in range(9)} | {1: 1, 2: 1}


def test_a_template_of_many_documents_connects_nothing(spark, monkeypatch):
    """Documents that share four fifths of a template are no near duplicates, and blocks of them are no one family."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 900)
    rng, frame = random.Random(6), H.words(random.Random(7), 100)
    rows = [(i, " ".join([*frame, *H.words(rng, 24)]), "en", "s", 1) for i in range(120)] + [(200 + i, " ".join([*frame, *H.words(random.Random(1000 + i // 2), 24), "end" * (i % 2 + 1)]), "en", "s", 1) for i in range(6)]
    seen = []
    orig = ngram_join._region_join
    monkeypatch.setattr(ngram_join, "_region_join", lambda store, family, sets, percent: seen.append(family.groupBy("label").count().agg({"count": "max"}).first()[0]) or orig(store, family, sets, percent))
    got = by_id(ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, H.SCHEMA)), "n_shingles", "component_id")
    assert got == H.components(rows) and len({c for _, c in got.values()}) == 123
    assert seen[0] < 70  # not all 126


def test_near_duplicates_with_the_operators_own_names(spark, rows):
    docs = spark.createDataFrame(rows, H.SCHEMA)
    for c in ("k_n", "k_hi", "k_lo", "k_id", "__k_n", "__hi", "__lo", "__words", "__k_id", "__c0"):
        docs = docs.withColumn(c, F.lit("clash"))
    kept = ngram_join.without_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("`__words` = 'clash'").count() == sum(not n or i == c for i, (n, c) in H.components(rows).items())


def test_join_of_odd_and_empty_tables(odd, empty):
    got = sorted((tuple(r) for r in ngram_join.ngram_jaccard_join(odd).collect()), key=str)
    assert got == sorted([(None, 46, 3), (None, 0, None), (7, 46, 3), (7, 1, 7), (3, 47, 3), (3, 47, 3)], key=str)
    assert ngram_join.ngram_jaccard_join(empty).count() == 0


def test_one_document_of_each_group_stays(rows, docs, odd, empty):
    want = H.components(rows)
    kept = ngram_join.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (n, c) in want.items() if not n or i == c)
    assert sorted(((r.doc_id, r.text) for r in ngram_join.without_near_duplicates(odd).collect()), key=str) == sorted([(None, None), (7, "other words here"), (3, odd.where("doc_id = 3").first().text)], key=str)
    assert ngram_join.without_near_duplicates(empty).count() == 0


# 2


@pytest.mark.parametrize("chunk", [2000, 1 << 22])
def test_phrases_against_all_windows(rows, docs, monkeypatch, chunk):
    monkeypatch.setattr(phrase_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(phrase_dedup, "PATTERN_WINDOWS", 10)
    assert by_id(phrase_dedup.remove_repeated_phrases(docs), "n_words", "n_removed", "kept_sha256") == H.phrases(rows)


def test_kept_text_and_odd_tables(spark, odd, empty):
    assert phrase_dedup.remove_repeated_phrases(empty).count() == 0
    got = {(r.doc_id, r.n_words): r.n_removed for r in phrase_dedup.remove_repeated_phrases(odd).collect()}
    assert got == {(None, 50): 50, (None, 0): 0, (7, 50): 50, (7, 3): 0, (3, 51): 51}
    long = "x" * 1000
    t = " ".join([long] * 40)
    rows = [(1, f"a {t} b", None, None, 1), (2, f"c {t}", None, None, 1)]
    assert {r.doc_id: r.kept for r in phrase_dedup.remove_repeated_phrases(spark.createDataFrame(rows, H.SCHEMA)).collect()} == {1: "a b", 2: "c"}


# 3


def test_license_base_and_templates(spark, rows, docs, empty):
    digest = lambda d: license_scan.license_digest(license_scan.scan_licenses(d))
    more = [
        (1, "Released under the MIT license. And the MIT License; CC-BY", None, None, 1),
        (2, "x Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without any restriction y", None, None, 1),
        (3, None, None, None, 0), (4, "all\nrights reserved", None, None, 1), (5, "cc", None, None, 0), (5, "Licensed under CC BY-NC 4.0.", None, None, 0),
        (6, "rights reserved all here", None, None, 0), (7, "released under the license of MIT", None, None, 0),
    ]
    for r in digest(spark.createDataFrame(more[:4], H.SCHEMA)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == H.license_base(dict((m[0], m[1]) for m in more)[r.doc_id])
    got = [(r.doc_id, r.labels) for r in digest(spark.createDataFrame(more, H.SCHEMA)).collect()]
    assert sorted(got) == [(1, "cc-by,mit"), (2, "mit"), (3, ""), (4, "all-rights-reserved"), (5, ""), (5, "cc-by,cc-by-nc"), (6, ""), (7, "")]
    for r in digest(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == H.license_base(rows[r.doc_id][1]) and 0 <= r.score <= 1
    assert digest(empty).count() == 0


@pytest.fixture(scope="module")
def notices():
    """Texts around notices, whole, cut, shuffled, twice, and with words put in or left out."""
    rng, out = random.Random(21), []
    for i in range(260):
        label, name, text = rng.choice(license_scan.TEMPLATES)
        w = text.split()
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            w[rng.randrange(len(w))] = rng.choice(("", "ka", "the"))
        if i % 7 == 0:
            rng.shuffle(w)
        if i % 5 == 0:
            w = w + H.words(rng, rng.randint(0, 30)) + text.split()
        out.append((i, " ".join([*H.words(rng, rng.randint(0, 20)), *w, *H.words(rng, rng.randint(0, 20))]), "en", "s", 1))
    return out


def test_blocks_labels_and_score_against_all_blocks(spark, notices):
    found = license_scan.license_digest(license_scan.scan_licenses(spark.createDataFrame(notices, H.SCHEMA))).collect()
    text, labels = dict((r[0], r[1]) for r in notices), 0
    for r in found:
        want = H.license_blocks(text[r.doc_id], license_scan.TEMPLATES, license_scan.THRESHOLD, license_scan.SLACK)
        assert [(b.label, b.template, b.start, b.end, round(b.containment, 9), b.in_order) for b in r.blocks] == want
        base = set(filter(None, H.license_base(text[r.doc_id])[4].split(",")))
        assert r.labels == ",".join(sorted(base | {x[0] for x in want if x[5]}))
        assert r.score == pytest.approx(1.0 if base else max((x[4] for x in want if x[5]), default=0.0))
        labels += bool(r.labels)
    assert 100 < labels < 260


def test_templates_from_a_table(spark):
    table = spark.createDataFrame([("own", "a", "one two three four"), ("none", "b", None), ("blank", "c", "...")], "label string, name string, text string")
    docs = spark.createDataFrame([(1, "zero one two three four five"), (2, "four three two one")], "doc_id long, text string")
    got = license_scan.license_digest(license_scan.scan_licenses(docs, table)).orderBy("doc_id").collect()
    assert [(r.labels, [(b.start, b.end, b.in_order) for b in r.blocks]) for r in got] == [("own", [(1, 5, True)]), ("", [(0, 4, False)])]


# 4


def test_targets_and_words_taken(spark, docs, empty):
    got = source_mix.mix_sources(docs).collect()
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        by.setdefault((r.source_size, r.target), []).append(r)
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-6 * total
    for (size, target), own in by.items():
        assert target <= 2 * size and abs(sum(r.taken for r in own) - target) <= max(r["size"] for r in own)
    again = source_mix.mix_sources(docs).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    assert source_mix.mix_sources(empty).count() == 0
    taken = source_mix.mixed_documents(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r.taken // r["size"] for r in got if r["size"])


def test_mixing_odd_rows(odd):
    got = source_mix.mix_sources(odd).collect()
    assert len(got) == 6 and all(r.taken <= 2 * r["size"] for r in got)


def test_inclusion_differs_and_words_are_near_the_target(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(1, 300)), "en", "abc"[i % 3], 1) for i in range(3000)]
    got = source_mix.mix_sources(spark.createDataFrame(rows, H.SCHEMA)).collect()
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), own in by.items():
        assert abs(sum(r.taken for r in own) - target) <= 150
        partial = [r for r in own if 0 < r.inclusion < 1]
        if target < 2 * size:
            assert len({round(r.inclusion, 6) for r in partial}) > 3
            for low, high in ((1, 63), (64, 127), (128, 300)):
                some = [r for r in partial if low <= r["size"] <= high and r.taken <= r["size"]]
                if len(some) > 200 and all(r.taken in (0, r["size"]) for r in some):
                    assert abs(sum(r.taken > 0 for r in some) / len(some) - sum(r.inclusion for r in some) / len(some)) < 0.1


def test_bands_of_one_row_and_hot_sources_change_nothing(docs, monkeypatch):
    from tidemark.llm import components

    want = by_id(source_mix.mix_sources(docs), "taken")
    monkeypatch.setattr(source_mix, "BROADCAST_ROWS", 0)
    assert by_id(source_mix.mix_sources(docs), "taken") == want
    monkeypatch.setattr(components, "HOT_ROWS", 2)
    monkeypatch.setattr(components, "HOT_SHARE", 1 << 40)
    assert by_id(source_mix.mix_sources(docs), "taken") == want
    assert source_mix.mixed_documents(docs).count() == sum(r.taken // r["size"] for r in source_mix.mix_sources(docs).collect() if r["size"])
    monkeypatch.setattr(source_mix, "BAND_ROWS", 1)
    assert by_id(source_mix.mix_sources(docs), "taken") == want


def test_mixing_with_the_operators_own_names(spark, docs):
    odd = docs
    for c in ("__size", "__u", "__times", "__copy", "key", "bits", "copies", "p", "cut", "all", "times", "copy", "__c0"):
        odd = odd.withColumn(c, F.lit("clash"))
    taken = source_mix.mixed_documents(odd)
    assert taken.columns == odd.columns and taken.count() == source_mix.mixed_documents(docs).count()


# 5


def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_is_the_tokenizer(monkeypatch):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        enc = token_output.Encoder(f.read())
    rng, t = random.Random(1), _tokenizer()
    parts = [" ", "\n", "  ", "\t", "a", "É", "1", "'s", "'", "don't", "_", "<|endoftext|>", "!", "ー", " ", "\x00", "½", "á", "\r\n", ".", "\x1c", "\x85", "…", "×", "a,", "b.", "-", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    texts += ["hello <|endoftext|> world", "<|endoftext", "|>", *H.thue_morse(2048), *(" ".join(H.thue_morse(n)) for n in (8, 16, 32, 64))]
    for cache in (1 << 12, 50):
        monkeypatch.setattr(token_output, "CACHE", cache)
        enc._empty()
        got = []
        for _, _, buf, off in kernel.text_slices(pa.array(texts), 4000):
            ids, ends = enc.encode(buf, off)
            got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        assert got == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_tokenizer_that_must_not_be_cut_sees_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        enc = token_output.Encoder(f.read())
    texts = ["Hello, World  it's", "", "ÀÉ n\u0303 <|endoftext|> x", " a\tb "]
    ids, ends = enc.encode(*next(kernel.text_slices(pa.array(texts)))[2:])
    assert not enc.cuts and [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("samples, kind", [([], "raw"), ([b"ab"] * 5, "raw"), ([b"\1\0" * 2000] * 100, None), ([np.random.default_rng(i).integers(0, 300, 900).astype("<u2").tobytes() for i in range(400)], "trained")])
def test_there_is_always_a_dictionary(samples, kind):
    import zstandard

    data, got = token_output.train_dictionary(samples, 2)
    assert data and got == (kind or got)
    d = zstandard.ZstdCompressionDict(data)
    for x in [b"", b"xy", *samples[:3]]:
        assert zstandard.ZstdDecompressor(dict_data=d).decompress(zstandard.ZstdCompressor(dict_data=d).compress(x)) == x


def test_dictionary_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(token_output, "SAMPLE_DOCS", 50)
    docs = spark.range(5000).selectExpr("if(id % 3 = 0, null, id) doc_id", "concat('text ', id) text")
    assert token_output._sample(docs).count() == 50
    assert token_output._sample(docs.limit(30)).count() == 30


def test_token_files_round_trip(spark, rows, docs, odd, empty, tmp_path):
    t, path = _tokenizer(), f"file://{tmp_path}/tokens"
    token_output.write_tokens(docs, path)
    got, start = by_id(token_output.read_tokens(spark, path), "start", "n_tokens", "ids_crc32"), 0
    for i, text, *_ in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    some = {r.doc_id: list(r.ids) for r in token_output.fetch_tokens(spark, path, [3, 0]).collect()}
    assert some == {3: t.encode("one", add_special_tokens=False).ids + [2], 0: [2]}
    path = f"file://{tmp_path}/odd"
    token_output.write_tokens(odd, path)
    assert sorted(len(r.ids) for r in token_output.fetch_tokens(spark, path, [None, 3, 99]).collect()) == sorted([1, *(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in odd.where("doc_id is null and text is not null or doc_id = 3").collect())])
    assert token_output.token_store(empty).count() == 0
    assert [r.doc_id for r in token_output.token_store(odd).orderBy("start").collect()] == [None, None, 3, 3, 7, 7]


# 6


def test_rules_against_their_definition(spark, rows, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(0, 60, 3)] + [(None, 1, 1, "")], LABELS)
    got = rule_forest.quality_rules(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        want = H.rules(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)
    assert rule_forest.quality_rules(empty, labels.limit(0)).count() == 0


@pytest.mark.parametrize("labelled", [300, 20])
def test_splits_range_over_rows_outside_the_sample(spark, monkeypatch, labelled):
    monkeypatch.setattr(rule_forest, "SAMPLE_ROWS", 40)
    monkeypatch.setattr(rule_forest, "LABELLED_ROWS", 300)
    seen, grow = [], rule_forest.grow
    monkeypatch.setattr(rule_forest, "grow", lambda x, everything: seen.append(everything) or grow(x, everything))
    rng = random.Random(3)
    texts = ["\n".join(" ".join(H.words(rng, 6)) for _ in range(8)) for _ in range(600)]
    texts[599] = "\n".join([*texts[599].split("\n"), *texts[599].split("\n")[:4:2]])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], H.SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(labelled)], LABELS)
    score = by_id(rule_forest.quality_rules(docs, labels), "n_dup_lines", "base_failed", "anomaly")
    assert score[599][:2] == (2, False) and score[599][2] > max(a for i, (_, _, a) in score.items() if i != 599)
    buf = [x for _, _, b, off in kernel.text_slices(pa.array(texts, pa.large_string())) for x in [rule_forest.statistics(b, off)]]
    every = rule_forest.features({n: np.concatenate([x[j] for x in buf]) for j, n in enumerate(rule_forest.STATS + rule_forest.EXTRA)})
    assert (seen[0].min(0) == every.min(0)).all() and (seen[0].max(0) == every.max(0)).all()
    assert len(rule_forest.box(spark.createDataFrame([], rule_forest._DDL))) == 0


def test_forest_finds_what_lies_where_no_row_was():
    rng = np.random.default_rng(0)
    good = np.column_stack([rng.normal(5, 1, 500), np.zeros(500)])
    odd = np.column_stack([rng.normal(5, 1, 30), np.ones(30)])
    both = np.concatenate([good, odd])
    forest = rule_forest.grow(good, both)
    assert forest.scores(odd).min() > np.quantile(forest.scores(good), 0.95)
    s = forest.scores(both)
    assert rule_forest.calibrate(s, np.arange(530) < 500) <= s[500:].max()


def test_verdicts_against_paths_walked_one_by_one(spark, monkeypatch):
    """anomaly and kept of each row, from the grown trees and the threshold."""
    seen = {}
    grow, calibrate = rule_forest.grow, rule_forest.calibrate

    def keep_forest(x, everything):
        seen["forest"] = grow(x, everything)
        return seen["forest"]

    def keep_split(scores, good):
        seen["judged"] = len(good)
        return calibrate(scores, good)

    monkeypatch.setattr(rule_forest, "grow", keep_forest)
    monkeypatch.setattr(rule_forest, "calibrate", keep_split)
    rng = random.Random(5)
    texts = ["\n".join(" ".join(H.words(rng, 6)) for _ in range(8)) if i % 10 else " ".join("#$%" + w.upper() for w in H.words(rng, 40)) for i in range(700)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], H.SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 10 != 0), 0, "x") for i in range(700)], LABELS)
    got = rule_forest.quality_rules(docs, labels).collect()
    forest = seen["forest"]
    assert 300 < seen["judged"] < 400 and np.isfinite(forest.threshold)  # one half of the labels calibrates
    columns = rule_forest.STATS + rule_forest.EXTRA
    for r in got:
        t = texts[r.doc_id].encode()
        x = rule_forest.features(dict(zip(columns, rule_forest.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)])), strict=True)))[0]
        total = 0.0
        for feature, cut, length in zip(forest.feature, forest.cut, forest.length, strict=True):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + (2 if x[feature[node]] >= cut[node] else 1)
            total += length[node]
        score = 2.0 ** (-total / len(forest.feature) / rule_forest._expected(rule_forest.TREE_ROWS))
        assert r.anomaly == pytest.approx(score) and r.kept == (not r.base_failed and score < forest.threshold)
    assert sum(r.kept for r in got if r.doc_id % 10) >= 0.99 * 630 and not any(r.kept for r in got if r.doc_id % 10 == 0)


def test_forest_and_threshold_come_from_all_labelled_rows(spark, monkeypatch):
    """More than 20,000 labelled rows: every good one of a half is counted in the trees, every one of the other calibrates."""
    seen = {}
    grow, calibrate = rule_forest.grow, rule_forest.calibrate

    def keep_forest(x, everything):
        forest = grow(x, everything)
        seen.update(forest=forest, grown=len(x) if isinstance(x, np.ndarray) else x.count())
        return forest

    def keep_split(scores, good):
        seen.update(judged=len(good), good=int(good.sum()), threshold=calibrate(scores, good))
        return seen["threshold"]

    monkeypatch.setattr(rule_forest, "grow", keep_forest)
    monkeypatch.setattr(rule_forest, "calibrate", keep_split)
    rng = random.Random(8)
    texts = [" ".join(H.words(rng, 24)) if i % 10 or i % 40 == 0 else " ".join("#" * rng.randint(0, 2) + w for w in H.words(rng, 24)) for i in range(24_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], H.SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 10 != 0), 0, "x") for i in range(24_000)], LABELS)
    got = rule_forest.quality_rules(docs, labels).where("not base_failed").toPandas()
    half, good = np.array([zlib.crc32(str(i).encode()) % 2 for i in got["doc_id"]]), got["doc_id"].to_numpy() % 10 != 0
    assert seen["grown"] == (good & (half == 0)).sum()
    assert (seen["judged"], seen["good"]) == ((half == 1).sum(), (good & (half == 1)).sum())
    assert np.isfinite(seen["threshold"]) and seen["threshold"] == calibrate(got["anomaly"].to_numpy()[half == 1], good[half == 1])
    columns = rule_forest.STATS + rule_forest.EXTRA
    buf = [x for _, _, b, off in kernel.text_slices(pa.array([texts[i] for i in got["doc_id"]], pa.large_string())) for x in [rule_forest.statistics(b, off)]]
    x = rule_forest.features({n: np.concatenate([y[j] for y in buf]) for j, n in enumerate(columns)})
    alone = grow(x[good & (half == 0)], x)
    assert all((getattr(alone, a) == getattr(seen["forest"], a)).all() for a in ("feature", "cut", "length"))


def test_tree_paths_end_where_the_rows_do():
    """Lengths of the trees from rows counted one by one."""
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (700, 3))
    forest = rule_forest.grow(x, x)
    for feature, cut, length in list(zip(forest.feature, forest.cut, forest.length, strict=True))[:5]:
        todo = [(0, 0, x)]
        while todo:
            node, depth, own = todo.pop()
            share = len(own) * rule_forest.TREE_ROWS / 700
            if share <= 1 or depth == rule_forest.DEPTH:
                assert feature[node] == -1 and length[node] == pytest.approx(depth + rule_forest._expected(share))
            else:
                left = own[:, feature[node]] < cut[node]
                todo += [(2 * node + 1, depth + 1, own[left]), (2 * node + 2, depth + 1, own[~left])]


@pytest.mark.parametrize("lost", [0.001, 0.05, 0.4])
@pytest.mark.parametrize("ties", [False, True])
def test_gathered_scores_calibrate_as_all_scores(spark, monkeypatch, lost, ties):
    monkeypatch.setattr(rule_forest, "LOST", lost)
    rng = np.random.default_rng(4)
    for n_good, n_bad in ((2000, 300), (700, 1), (1, 50), (300, 0), (0, 40), (0, 0)):
        scores = np.concatenate([rng.uniform(0.3, 0.62, n_good), rng.uniform(0.4, 0.8, n_bad)])
        scores = np.round(scores, 2) if ties else scores
        good = np.arange(n_good + n_bad) < n_good
        table = spark.createDataFrame(list(zip(scores.tolist(), good.astype(int).tolist(), strict=True)), "score double, y int")
        few, kinds = rule_forest.gather(table)
        assert (len(kinds), kinds.sum()) == (n_good + n_bad, n_good)
        best, want = 0.0, np.inf
        for c in np.unique(scores[~good]) if n_good else ():
            dropped, caught = (scores[good] >= c).mean(), (scores[~good] >= c).mean()
            if dropped <= lost and caught - dropped > best:
                best, want = caught - dropped, c
        if np.isfinite(want):
            want = (want + scores[scores < want].max()) / 2
        assert rule_forest.calibrate(few, kinds) == rule_forest.calibrate(scores, good) == want


# 7


@pytest.mark.parametrize("block", [3, 500_000])
def test_contamination_against_all_windows(spark, rows, docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    w = rows[10][1].split()
    items = [(1, " ".join(w[5:40])), (2, "One, TWO!"), (3, None), (4, "..."), (12, " ".join(w[30:42]).upper()), (5, "absent words of an item that no document has at all here"), (None, " ".join(rows[45][1].split()[:10])), (12, " ".join(w[5:15]))]
    if block == 3:
        items = items[:5]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.decontaminate(docs, bench)
    assert by_id(got, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == H.contamination(rows, items)
    clean = decontaminate.without_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, x in H.contamination(rows, items).items() if not x[4]]


def test_contamination_of_odd_and_empty_tables(spark, docs, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.decontaminate(docs, none).collect())
    bench = spark.createDataFrame([(1, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9")], "item_id long, text string")
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert sorted(((r.doc_id, r.n_hit) for r in decontaminate.decontaminate(odd, bench).collect()), key=str) == sorted([(None, 10), (None, 0), (7, 10), (7, 0), (3, 10), (3, 10)], key=str)


# 8


def test_base_spans_against_the_patterns():
    rng = random.Random(3)
    parts = ["a", "b@", "@", "c.d", "12", "3", "4111111111111111", "1.2.3.4", "300.1", ".", " ", "-", "+1 (555) 123-4567", "+", "é", "\n", "(", ")", "a@b.co", "%"]
    for _ in range(8000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 10)))
        assert sorted((k, a, b) for k, a, b, ok in pii.looked_at(t) if ok) == sorted(tuple(x.split(":")[:1]) + tuple(map(int, x.split(":")[1:])) for x in H.personal(t)[1].split(",") if x)
    assert pii.looked_at("9" * 200_000 + "@" + "a" * 200_000)[0][0] == "card"


def test_personal_data_table(spark, empty):
    rng = random.Random(4)
    texts = [None, "", "mail me: jo@site.example.org or +1 (555) 123-4567", "host 10.0.0.300 and 10.0.0.1", "card 4111 1111 1111 1111, not 4111 1111 1111 1112"]
    texts += [f"call 555 {rng.randint(100, 999)}, at u{i}@mail{i}.example.com, ip {i}.2.3.4, no {rng.randint(10**15, 10**16)}" for i in range(60)]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    for r in pii.find_personal_data(df).collect():
        n, base = H.personal(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == n and r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert pii.find_personal_data(empty).count() == 0


@pytest.fixture(scope="module")
def personal_rows():
    rng, texts = random.Random(8), []
    for i in range(400):
        w = H.words(rng, 30)
        real = i % 4 == 0
        before, span, after = pii.injected(rng, pii.KINDS[i // 4 % 6], real) if i % 2 == 0 else ("", "", "")
        texts.append((i, " ".join(w[:15]) + f" {before}{span}{after} " + " ".join(w[15:]), span, real))
    return texts


def test_added_spans_are_the_proposals_above_their_kinds_threshold(spark, personal_rows):
    docs = spark.createDataFrame([(i, t, "c", 0) for i, t, _, _ in personal_rows], "doc_id long, text string, spans string, n_spans int")
    model = pii.fit(pii.corpus_snippets(docs))
    text = {i: t for i, t, _, _ in personal_rows}
    for r in pii.find_personal_data(docs).collect():
        t = text[r.doc_id]
        base = {(k, a, b) for k, a, b, ok in pii.looked_at(t) if ok}
        want = base | {(k, a, b) for k, a, b in pii.proposals(t) if not any(x <= a and b <= y for _, x, y in base) and model.trees[k].scores(np.array([pii.features(t, k, a, b)]))[0] >= model.threshold[k]}
        assert {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)} == want and r.n_spans == len(want)


def test_personal_data_is_found_and_look_alikes_are_left(spark, personal_rows):
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in personal_rows], "doc_id long, text string")
    found = by_id(pii.find_personal_data(docs), "n_spans", "n_email", "n_ip", "n_card", "n_phone")
    real = [i for i, _, _, y in personal_rows if y]
    clean = [i for i, _, _, y in personal_rows if not y and not any(found[i][1:])]
    assert sum(found[i][0] > 0 for i in real) >= 0.95 * len(real) and sum(found[i][0] > 0 for i in clean) <= 0.02 * len(clean)


@pytest.mark.parametrize("kind", pii.KINDS)
def test_recall_of_each_kind(kind):
    model = pii.fit([])
    x, y = pii._examples([], kind, 1234)
    p = model.trees[kind].scores(x) >= model.threshold[kind]
    assert p[y == 1].mean() >= 0.95 and p[y == 0].mean() <= 0.02


# 9 and 10


def test_field_against_all_labelings():
    import itertools

    rng = np.random.default_rng(0)
    u, first, t = rng.normal(0, 2, 9), np.array([1, 0, 0, 0, 1, 0, 0, 0, 0], bool), np.exp(rng.normal(0, 1, (2, 2)))
    total, m, pairs = 0.0, np.zeros(9), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=9):
        s = np.exp(np.dot(u, y)) * np.prod([t[y[i - 1], y[i]] for i in range(1, 9) if not first[i]])
        total, m = total + s, m + s * np.array(y)
        for i in range(1, 9):
            if not first[i]:
                pairs[y[i - 1], y[i]] += s
    p = crf.forward_backward(u, first, t)
    assert np.allclose(m / total, p.marginal) and np.allclose(pairs / total, crf.pair_counts(u, first, t, p))


@pytest.fixture(scope="module")
def judged(spark):
    """Texts with bad words or bad lines, and their labels."""
    rng, rows, labels = random.Random(9), [], []
    for i in range(400):
        w = H.words(rng, rng.randint(20, 60))
        toxic, bad = i % 4 == 0, i % 3 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["grukkel", "grukkin", "zompf"])
        lines = [" ".join(w[j : j + 10]) for j in range(0, len(w), 10)]
        if bad:
            lines = [x.replace(" ", "%%% ") + " $$$" for x in lines]
        rows.append((i, "\n".join(lines), "en", "s", 1))
        labels.append((i, int(not bad), int(toxic), "z"))
    return H.awkward(spark, rows + [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (None, "plain words", "en", "s", 0)]), spark.createDataFrame(labels + [(None, 1, 1, ""), (3, None, None, "")], LABELS), labels


@pytest.mark.parametrize("operator, column, held", [(toxic_crf.toxicity, 2, lambda i: zlib.crc32(str(i).encode()) % 3 == 1), (quality_crf.quality, 1, lambda i: zlib.crc32(str(i).encode()) % 4 == 2)])
def test_held_out_accuracy(spark, judged, empty, operator, column, held):
    docs, labels, truth = judged
    got = operator(docs, labels).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].held_out == held(i) for i in range(400)) and by[None].held_out is False
    mine = [t for t in truth if held(t[0])]
    assert sum(by[t[0]].predicted == t[column] for t in mine) >= 0.95 * len(mine)
    assert operator(empty, labels.limit(0)).count() == 0
    one = operator(docs, labels.where("doc_id is null"))  # nothing to learn from
    assert len({round(r.score, 9) for r in one.collect()}) == 1


def test_toxic_spans_and_filter(judged):
    docs, labels, truth = judged
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in toxic_crf.toxicity(docs, labels).where("predicted = 1").collect():
        assert all(any(s in text[r.doc_id][a:b] for s in ("grukk", "zompf")) for a, b in r.spans) and r.spans
    kept = toxic_crf.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i, _, t, _ in truth if not t} | {1000, 1001, None}


def test_features_that_share_a_slot_are_all_learnt():
    rng = np.random.default_rng(0)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 62, 5000).astype(np.uint64) << np.uint64(1), (np.arange(2000).astype(np.uint64) << np.uint64(44)) + np.uint64(7), (np.arange(2000).astype(np.uint64) << np.uint64(44)) + np.uint64(9)]))
    f = toxic_crf.Features(rng.permutation(keys))
    assert f.find(keys).tolist() == list(range(len(keys))) and len(f.more) >= 1500
    assert (f.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == f.n).all()


def test_labels_of_held_out_rows_change_nothing(judged):
    docs, labels, _ = judged
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert by_id(toxic_crf.toxicity(docs, labels), "score") == by_id(toxic_crf.toxicity(docs, flipped), "score")


def test_toxicity_learns_from_its_whole_sample(spark):
    rng = random.Random(11)
    docs = spark.createDataFrame([(i, " ".join(H.words(rng, 20)), "en", "s", 1) for i in range(3_600)], H.SCHEMA)
    labels = spark.createDataFrame([(i, 0, int(i < 1_200), "x") for i in range(3_600)], LABELS)
    seen = labelled.train(lambda texts, y: (sum(y), len(y)), docs, labels, "toxic", 10**9, -1, toxic_crf.SAMPLE)
    assert seen == (1_000, 3_000) and toxic_crf.CLEAN_CHAINS >= 400


@pytest.mark.parametrize("n", [20, 128, 129, 5_000, 1_000_000])
def test_long_secrets_are_proposed_whole(n):
    token = ("aB3_x-9Z" * (n // 8 + 1))[:n]
    assert pii.proposals(f"token = {token}.") == [("secret", 8, 8 + n)]
    assert len(pii.features(f"token = {token}.", "secret", 8, 8 + n)) == len(pii.features("x", "email", 0, 1))
