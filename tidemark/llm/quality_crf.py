"""Quality classifier: a linear-chain conditional random field over lines.

Each line with a word is good or bad.  Its features are binned statistics of the line
and of the lines beside it.  Lines learn from their document's label, in chains of a few
documents put one after another, so that lines of both kinds are neighbours; forward-backward
marginals, weighted by line length, give a document's mean goodness, which a logistic
fit on the training documents turns into its score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import crf, labelled
from tidemark.llm import kernel as K
from tidemark.llm.rule_forest import _per_row
from tidemark.llm.runtime import ship

U64 = np.uint64
#: Training documents of each label at most.
SAMPLE = {0: 1500, 1: 1500}
#: Documents that make one training chain.
CHAIN = 4
THRESHOLD = 0.7


def _flags(chars) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_UPPER, _LOWER, _DIGIT = _flags(range(65, 91)), _flags(range(97, 123)), _flags(range(48, 58))
_SYMBOL = _flags(b"#*$%&|<>{}[]\\^~=_@+/")
_STOP, _SHOUT = _flags(b".,;:"), _flags(b"!?")
_HIGH = _flags(range(0x80, 0x100))

_SHARES = (0.0, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.6)
#: (name, bin edges) of a line's statistics; a value is in the bin after the last edge below it.
BINS = (
    ("words", (1, 2, 4, 8, 16, 32, 64, 128, 256)),
    ("chars_a_word", (2, 3, 4, 5, 6, 7, 8, 10, 14, 25)),
    ("upper", _SHARES),
    ("digit", _SHARES),
    ("symbol", _SHARES),
    ("stop", _SHARES),
    ("shout", _SHARES),
    ("high", _SHARES),
    ("repeat", _SHARES),
    ("distinct", (0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.97)),
    ("short", (0.05, 0.15, 0.3, 0.45, 0.6, 0.8)),
    ("copies", (0, 1, 2, 4, 8)),
    ("begin", (0, 1)),
    ("end", (0, 1)),
)
#: Statistics whose bins the lines at both sides lend.
BESIDE = ("words", "upper", "symbol", "shout", "repeat", "distinct", "copies")


@dataclass
class Lines:
    stats: dict[str, np.ndarray]
    weight: np.ndarray
    rows: np.ndarray


def line_statistics(buf: np.ndarray, off: np.ndarray) -> Lines:
    """Statistics of the lines with a word, row by row."""
    n_rows = len(off) - 1
    lines = K.split_words(buf, off, K.LINES)
    words = K.split_words(buf, off, K.SPACED)
    of = np.searchsorted(lines.starts, words.starts, "right") - 1
    count = np.bincount(of, minlength=len(lines.starts))
    real = np.flatnonzero(count)
    number = np.cumsum(count > 0) - 1
    of, count = number[of], count[real]
    a, b = lines.starts[real], lines.ends[real]
    row = K.row_ids(lines.rows)[real]
    n = len(real)

    def inside(flags: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(flags[buf])))
        return c[b] - c[a]

    size = np.maximum(b - a, 1)
    upper, lower = inside(_UPPER), inside(_LOWER)
    length = words.ends - words.starts
    h = words.hashes
    same = np.zeros(len(h), bool)
    for lag in (1, 2, 3):
        same[lag:] |= (h[lag:] == h[:-lag]) & (of[lag:] == of[:-lag])
    _, first = np.unique(_per_row(h, of), return_index=True)
    copies = np.zeros(n, np.int64)
    _, inverse, times = np.unique(_per_row(lines.hashes[real], row), return_inverse=True, return_counts=True)
    if n:
        copies = times[inverse] - 1
    head, tail = (buf[a], buf[b - 1]) if n else (np.zeros(0, np.uint8), np.zeros(0, np.uint8))
    stats = {
        "words": count,
        "chars_a_word": np.bincount(of, length, n) / np.maximum(count, 1),
        "upper": upper / np.maximum(upper + lower, 1),
        "digit": inside(_DIGIT) / size,
        "symbol": inside(_SYMBOL) / size,
        "stop": inside(_STOP) / size,
        "shout": inside(_SHOUT) / size,
        "high": inside(_HIGH) / size,
        "repeat": np.bincount(of, same, n) / np.maximum(count, 1),
        "distinct": np.bincount(of[first], minlength=n) / np.maximum(np.minimum(count, 60), 1),
        "short": np.bincount(of, length <= 3, n) / np.maximum(count, 1),
        "copies": copies,
        "begin": (_UPPER[head] | _HIGH[head]).astype(np.int64),
        "end": (_STOP[tail] | _SHOUT[tail]).astype(np.int64),
    }
    return Lines(stats, size.astype(np.float64), np.searchsorted(row, np.arange(n_rows + 1)))


def features(lines: Lines) -> tuple[list[np.ndarray], np.ndarray]:
    """(feature indices, whether a line is its row's first)."""
    n = len(lines.weight)
    first = np.zeros(n + 1, bool)
    first[lines.rows[:-1]] = True
    first = first[:n]
    last = np.append(first[1:], True)[:n]
    out, base, bins = [], 1, {}
    for name, edges in BINS:
        bins[name] = np.searchsorted(np.array(edges, np.float64), lines.stats[name], "left")
        out.append(base + bins[name])
        base += len(edges) + 1
    sizes = {name: len(edges) + 1 for name, edges in BINS}
    for name in BESIDE:
        k = bins[name]
        before, after = np.full(n, sizes[name]), np.full(n, sizes[name])
        before[1:] = k[:-1]
        before[first] = sizes[name]
        after[:-1] = k[1:]
        after[last] = sizes[name]
        out += [base + before, base + sizes[name] + 1 + after]
        base += 2 * (sizes[name] + 1)
    out.append(np.zeros(n, np.int64))
    return out, first


N_FEATURES = 1 + sum(len(e) + 1 for _, e in BINS) + sum(2 * (len(e) + 2) for name, e in BINS if name in BESIDE)


@dataclass
class Model:
    weights: np.ndarray
    factors: np.ndarray
    slope: float
    offset: float


def _goodness(model: Model, lines: Lines) -> np.ndarray:
    """Log odds of the length-weighted mean marginal of each row; rows without lines have the lowest."""
    feats, first = features(lines)
    u = np.zeros(len(first))
    for f in feats:
        u += model.weights[f]
    m = crf.forward_backward(u, first, model.factors).marginal
    sums = [np.concatenate(([0.0], np.cumsum(x))) for x in (m * lines.weight, lines.weight)]
    top, all_ = (s[lines.rows[1:]] - s[lines.rows[:-1]] for s in sums)
    mean = np.clip(np.where(all_ > 0, top / np.maximum(all_, 1e-9), 0), 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def fit(texts: list[str], y: list[int]) -> Model:
    y = np.array(y, np.int64)
    prior = (y.sum() + 0.5) / (len(y) + 1)
    flat = Model(np.zeros(N_FEATURES), np.ones((2, 2)), 0.0, float(np.log(prior / (1 - prior))))
    if not len(y) or not y.any() or y.all():
        return flat
    order = np.random.default_rng(len(y)).permutation(len(y))
    texts, y = [texts[i] for i in order], y[order]
    parts = [line_statistics(buf, off) for _, _, buf, off in K.text_slices(pa.array(texts, pa.large_string()))]
    stats = {name: np.concatenate([p.stats[name] for p in parts]) for name, _ in BINS}
    counts = np.concatenate([np.diff(p.rows) for p in parts])
    rows = np.concatenate(([0], np.cumsum(counts)))
    lines = Lines(stats, np.concatenate([p.weight for p in parts]), rows)
    if not len(lines.weight):
        return flat
    chains = np.append(rows[:-1:CHAIN], rows[-1])  # a chain's lines are those of CHAIN documents
    feats, first = features(Lines(stats, lines.weight, chains))
    of = np.repeat(np.arange(len(y)), counts)
    # each document weighs as much as another of its label, each line by its length in it, and the labels alike
    total = np.bincount(of, lines.weight, len(y))
    balance = len(y) / 2 / np.array([max(1, len(y) - y.sum()), max(1, y.sum())])
    weight = lines.weight / total[of] * balance[y[of]]
    weight *= len(weight) / weight.sum()
    weights, factors = crf.train(feats, None, N_FEATURES, y[of], first, weight, rounds=150, l2=1e-4, rate=0.1)
    model = Model(weights, np.exp(factors), 1.0, 0.0)
    model.slope, model.offset = crf.platt(_goodness(model, lines), y)
    return model


def _score(shared):
    def run(batches):
        model = shared.value
        for b in batches:
            z = [_goodness(model, line_statistics(buf, off)) for _, _, buf, off in K.text_slices(b.column(1))]
            score = crf.logistic(model.slope * np.concatenate(z) + model.offset) if z else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return run


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 4, remainder: int = 2) -> DataFrame:
    """Score documents for quality.

    Labels are learnt from a bounded sample (SAMPLE) of the rows of ``labels`` whose
    crc32(id as text) % mod is not ``remainder``; nothing but the text is an input of a
    score.  Returns a row for each input row: doc_id, held_out, score (0 to 1, higher is
    better), predicted (1 if score >= 0.7).  Null, empty and wordless texts have the score
    of a document whose lines are all bad.  Without labels of both kinds every score is the
    share of good labels.  Rows with one id are scored each by its own text.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(labelled.train(fit, docs, labels, label, mod, remainder, SAMPLE))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(_score(model), "doc_id long, score double, predicted int")
    return rows.select("doc_id", labelled.held_out(mod, remainder).alias("held_out"), "score", "predicted")


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All documents, learnt from three quarters of the labels."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
