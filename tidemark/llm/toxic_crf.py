"""Toxicity: a linear-chain conditional random field over words.

The labels are of documents, so words are labelled first: a word, or its first
characters, is toxic if its share among toxic documents stands out against the
others by a likelihood-ratio test.  The field is trained on those labelled tokens
with features of the word, its ends and its neighbours; forward-backward marginals
give the toxic spans, and their expected number, calibrated on the training
documents, the document's score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import crf, labelled
from tidemark.llm import kernel as K
from tidemark.llm.runtime import ship, table

U64 = np.uint64
#: Training documents of each label at most.
SAMPLE = {1: 1000, 0: 2000}
#: Documents without toxic tokens that the field itself is trained on.
CLEAN_CHAINS = 400
THRESHOLD = 0.7
AFFIXES = (4, 5, 6)
#: Lower marginals say nothing, however many a long text has.
LEAST_MARGINAL = 0.1
#: A feature is learnt if so many training documents have it.
FEATURE_DOCS = 10
_SLOT_BITS = 20
_SLOTS = [U64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_FLOOR = 1e-4


class Features:
    """Learnt features by 64-bit key: one a slot of a table, and those whose slot is taken in a sorted list."""

    def __init__(self, keys: np.ndarray):
        keys = np.unique(keys)
        slot = (keys >> U64(64 - _SLOT_BITS)).astype(np.int64)
        _, first = np.unique(slot, return_index=True)
        self.n = len(keys)
        self.at = np.full(1 << _SLOT_BITS, self.n, np.int32)
        self.key = np.zeros(1 << _SLOT_BITS, U64)
        self.at[slot[first]], self.key[slot[first]] = first, keys[first]
        rest = np.ones(len(keys), bool)
        rest[first] = False
        self.more, self.more_at = keys[rest], np.flatnonzero(rest).astype(np.int32)
        self.shared = np.zeros(1 << _SLOT_BITS, bool)
        self.shared[slot[rest]] = True

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Feature numbers; self.n for keys that are not learnt."""
        slot = (keys >> U64(64 - _SLOT_BITS)).astype(np.int64)
        same = self.key[slot] == keys
        out = np.where(same, self.at[slot], np.int32(self.n))
        look = np.flatnonzero(self.shared[slot] & ~same)
        if len(look):
            k = np.searchsorted(self.more, keys[look])
            k[k == len(self.more)] = 0
            out[look] = np.where(self.more[k] == keys[look], self.more_at[k], np.int32(self.n))
        return out


@dataclass
class Model:
    features: Features
    weights: np.ndarray
    bias: float
    factors: np.ndarray
    slope: float
    offset: float


def _first(rows: np.ndarray, n: int) -> np.ndarray:
    first = np.zeros(n + 1, bool)
    first[rows[:-1]] = True
    return first[:n]


def _keys(buf: np.ndarray, w: K.Words) -> list[np.ndarray]:
    return [w.hashes, *K.affixes(buf, w, K.ALNUM_FOLDED, AFFIXES)]


def _features(keys: list[np.ndarray], first: np.ndarray) -> list[np.ndarray]:
    """Feature keys of each word: itself, its beginnings, and the words at both sides."""
    before = np.where(first, U64(0), np.append(U64(0), keys[0][:-1])) if len(first) else keys[0]
    after = np.append(np.where(first[1:], U64(0), keys[0][1:]), U64(0)) if len(first) else keys[0]
    return [K.mix(k * s) for k, s in zip((*keys, before, after), _SLOTS, strict=True)]


def _stands_out(n1: np.ndarray, n0: np.ndarray, all1: int, all0: int) -> np.ndarray:
    """Likelihood-ratio test of document counts, one-sided, with a rate ten times as high."""
    n = n1 + n0
    e1 = n * all1 / (all1 + all0)
    e0 = n - e1
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (n1 * np.log(n1 / e1) + np.where(n0 > 0, n0 * np.log(n0 / e0), 0))
    tested = n1 >= 4
    return tested & (g >= 8 + 2 * np.log(tested.sum() + 1)) & (n1 / all1 >= 10 * n0 / all0)


def fit(texts: list[str], y: list[int]) -> Model:
    y = np.array(y, np.int64)
    all1, all0 = int(y.sum()), int(len(y) - y.sum())
    prior = (all1 + 0.5) / (len(y) + 1)
    flat = Model(Features(np.zeros(0, U64)), np.zeros(1), -crf._CLIP, np.ones((2, 2)), 0.0, float(np.log(prior / (1 - prior))))
    if not all1 or not all0:
        return flat
    parts = []
    for lo, hi, buf, off in K.text_slices(pa.array(texts, pa.large_string())):
        w = K.split_words(buf, off, K.ALNUM_FOLDED)
        parts.append((_keys(buf, w), w.rows, lo, hi))
    counts = np.concatenate([np.diff(rows) for _, rows, _, _ in parts])
    doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    if not len(doc):
        return flat
    toxic = np.zeros(len(doc), bool)
    for j in range(1 + len(AFFIXES)):
        names, at, pair = _by_document(np.concatenate([keys[j] for keys, *_ in parts]), doc, len(counts))
        word = pair // len(counts)
        n1 = np.bincount(word, y[pair % len(counts)], len(names))
        n0 = np.bincount(word, minlength=len(names)) - n1
        toxic |= _stands_out(n1, n0, all1, all0)[at]
    toxic &= y[doc] == 1
    if not toxic.any():
        return flat
    use = y == 1
    use[np.flatnonzero(y == 0)[:CLEAN_CHAINS]] = True
    keep = use[doc]
    own, labels = doc[keep], toxic[keep].astype(np.int64)
    first = np.append(True, own[1:] != own[:-1])
    keyed = _features([np.concatenate([keys[j] for keys, *_ in parts])[keep] for j in range(1 + len(AFFIXES))], first)
    chosen = []
    for k in keyed:
        names, _, pair = _by_document(k, own, len(counts))
        chosen.append(names[np.bincount(pair // len(counts), minlength=len(names)) >= FEATURE_DOCS])
    features = Features(np.concatenate(chosen))
    feats = [features.find(keyed.pop(0)) for _ in range(len(_SLOTS))]
    for f in feats:
        f[f == features.n] = features.n + 1  # what isn't learnt has a weight of its own, left out below
    feats.append(np.full(len(own), features.n, np.int32))
    weights, factors = crf.train(feats, None, features.n + 2, labels, first, np.ones(len(labels)), rounds=80, l2=1e-7, rate=0.2, fixed=features.n + 1, bias=features.n)
    model = Model(features, np.append(weights[: features.n], 0.0), float(weights[features.n]), np.exp(factors), 1.0, 0.0)
    expected = []
    for keys, rows, _, _ in parts:
        first = _first(rows, len(keys[0]))
        expected.append(_expected(_marginals(model, (features.find(k) for k in _features(keys, first)), first), rows))
    model.slope, model.offset = crf.platt(np.log(np.concatenate(expected) + _FLOOR), y)
    return model


def _by_document(k: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, each position's key, key * docs + document of each pair that occurs)."""
    names, at = np.unique(k, return_inverse=True)
    pair = np.sort(at * docs + doc)
    return names, at, pair[np.append(True, pair[1:] != pair[:-1])]


def _marginals(model: Model, feats, first: np.ndarray) -> np.ndarray:
    u = np.full(len(first), model.bias)
    for f in feats:
        u += model.weights[f]
    return crf.forward_backward(u, first, model.factors).marginal


def _expected(m: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The expected number of toxic words of each row, over words that have some chance to be one."""
    total = np.concatenate(([0.0], np.cumsum(np.where(m >= LEAST_MARGINAL, m, 0))))
    return np.maximum(total[rows[1:]] - total[rows[:-1]], 0)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("spans", pa.list_(pa.list_(pa.int64())))])
_DDL = "doc_id long, score double, predicted int, spans array<array<long>>"


def _spans(buf: np.ndarray, off: np.ndarray, w: K.Words, row: int, hot: np.ndarray) -> list[list[int]]:
    """Code-point offsets of runs of toxic words (indices ``hot``) of a row."""
    lead = np.cumsum((buf[off[row] : off[row + 1]] & 0xC0) != 0x80)
    run = np.flatnonzero(np.append(True, np.diff(hot) > 1))
    ends = np.append(run[1:], len(hot)) - 1
    at = lambda b: int(lead[b - off[row] - 1]) if b > off[row] else 0
    return [[at(w.starts[hot[a]]), at(w.ends[hot[b]])] for a, b in zip(run, ends, strict=True)]


def _score(shared):
    def run(batches):
        model = shared.value
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for lo, hi, buf, off in K.text_slices(b.column(1)):
                w = K.split_words(buf, off, K.ALNUM_FOLDED)
                first = _first(w.rows, len(w.hashes))
                m = _marginals(model, [model.features.find(k) for k in _features(_keys(buf, w), first)], first)
                score = crf.logistic(model.slope * np.log(_expected(m, w.rows) + _FLOOR) + model.offset)
                hot = np.flatnonzero(m >= 0.5)
                cut = np.searchsorted(hot, w.rows)
                for i in range(hi - lo):
                    own = hot[cut[i] : cut[i + 1]]
                    rows.append((ids[lo + i], float(score[i]), int(score[i] >= THRESHOLD), _spans(buf, off, w, i, own) if len(own) else []))
            yield table(_SCHEMA, rows)

    return run


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 3, remainder: int = 1) -> DataFrame:
    """Score documents for toxicity.

    Labels are learnt from a bounded sample (SAMPLE) of the rows of ``labels`` whose
    crc32(id as text) % mod is not ``remainder``; nothing but the text is an input of a
    score.  Returns a row for each input row: doc_id, held_out, score (0 to 1), predicted
    (1 if score >= 0.7), spans (code-point [start, end) of toxic words).  Null and empty
    texts have the score of no toxic words.  Without labels of both kinds every score is
    the share of toxic labels.  Rows with one id are scored each by its own text.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(labelled.train(fit, docs, labels, label, mod, remainder, SAMPLE))  # 1 MB of weights
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(model), _DDL)
    return rows.select("doc_id", labelled.held_out(mod, remainder).alias("held_out"), "score", "predicted", "spans")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents, learnt from two thirds of the labels."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _keep(shared, text: str):
    def run(batches):
        model = shared.value
        for b in batches:
            keep = []
            for _, _, buf, off in K.text_slices(b.column(b.schema.get_field_index(text))):
                w = K.split_words(buf, off, K.ALNUM_FOLDED)
                first = _first(w.rows, len(w.hashes))
                m = _marginals(model, [model.features.find(k) for k in _features(_keys(buf, w), first)], first)
                keep.append(crf.logistic(model.slope * np.log(_expected(m, w.rows) + _FLOOR) + model.offset) < THRESHOLD)
            yield b.filter(pa.array(np.concatenate(keep))) if keep else b

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 3, remainder: int = 1) -> DataFrame:
    """The rows of docs, with all their columns, that are not predicted toxic.

    Null and empty texts have no toxic words and stay, unless without labels of both kinds the share of
    toxic labels itself is over the threshold.  Rows with one id, and equal rows, are judged each by its own
    text; an empty table stays empty.  Columns can have any names.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(labelled.train(fit, docs, labels, label, mod, remainder, SAMPLE))
    return docs.mapInArrow(_keep(model, "text"), docs.schema)
