"""Quality rules: an isolation forest over rule statistics.

Base rules look at a few statistics of a text.  The forest judges what passes them:
random splits isolate odd documents on short paths, and the path length at which a
document is dropped is calibrated on labelled rows.  Rows that grow trees and rows that
calibrate are different ones, by a hash of the id.  Of both kinds all rows count: a tree's
splits are drawn in the box of all rows, then every row that grows it is counted at its
nodes, and the threshold comes from the scores of every row that calibrates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.runtime import Stored, ship

U64 = np.uint64
REPEAT_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: Of no effect: no rows are sampled.  The names stay for those who set them.
SAMPLE_ROWS = LABELLED_ROWS = None
#: A node's share of the rows is told as that of TREE_ROWS rows; fewer good rows than that don't grow a forest alone.
TREES, TREE_ROWS, DEPTH = 100, 256, 8
NODES = (1 << (DEPTH + 1)) - 1
#: Share of good labelled rows that the threshold may drop.
LOST = 0.001
#: Steps of the scores, to find about where LOST of the good rows lie; the threshold itself is exact.
BINS = 1 << 16
SEED = 17

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_digits", "n_marks", "n_distinct")


def _per_row(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A hash of entry and row together."""
    return K.mix(h ^ K.mix(row.astype(U64) + U64(1)))


def statistics(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """STATS then EXTRA of the rows of a buffer."""
    n_rows = len(off) - 1
    w = K.split_words(buf, off, K.SPACED)
    row = K.row_ids(w.rows)
    inside = K.SPACED.word[buf]
    chars = K.row_sums(inside & ((buf & 0xC0) != 0x80), off)
    symbols = K.row_sums(_SYMBOL[buf], off)
    lines = K.split_words(buf, off, K.LINES)
    filled = np.concatenate(([0], np.cumsum(inside)))
    real = filled[lines.ends] > filled[lines.starts] if len(lines.starts) else np.zeros(0, bool)
    line_row = K.row_ids(lines.rows)[real]
    n_lines = np.bincount(line_row, minlength=n_rows)
    _, at = np.unique(_per_row(lines.hashes[real], line_row), return_index=True)
    dup = n_lines - np.bincount(line_row[at], minlength=n_rows)
    h, pos = K.windows(w, REPEAT_WORDS)
    keyed = _per_row(h, row[pos])
    order = np.argsort(keyed)
    same = keyed[order][1:] == keyed[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    repeated = K.row_sums(K.covered(pos[order[again]], REPEAT_WORDS, len(w.hashes)), w.rows)
    _, at = np.unique(_per_row(w.hashes, row), return_index=True)
    distinct = np.bincount(row[at], minlength=n_rows)
    extra = [n_lines, *(K.row_sums(t[buf], off) for t in (_UPPER, _DIGIT, _MARK)), distinct]
    return [np.asarray(x, np.int64) for x in (w.counts, chars, symbols, dup, repeated, *extra)]


def _stats(batches):
    for b in batches:
        cols = [[] for _ in STATS + EXTRA]
        for _, _, buf, off in K.text_slices(b.column(1)):
            for c, x in zip(cols, statistics(buf, off), strict=True):
                c.append(x)
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in cols)], names=["doc_id", *STATS, *EXTRA])


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios of the statistics, (n, k)."""
    s = {k: np.asarray(v, np.float64) for k, v in s.items()}
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    # shares beyond their cap are as odd as the cap, so that splits fall where texts differ
    return np.stack(
        [
            np.minimum(s["word_chars"] / words, 12),
            np.minimum(s["n_symbols"] / words, 0.3),
            np.minimum(s["n_dup_lines"] / lines, 0.5),
            s["n_repeat_words"] / words,
            np.minimum(s["n_upper"] / chars, 0.3),
            np.minimum(s["n_digits"] / chars, 0.3),
            np.minimum(s["n_marks"] / words, 0.8),
            np.minimum(s["n_distinct"] / np.minimum(words, 200), 1.0),
        ],
        1,
    )


@dataclass
class Forest:
    """Trees of one depth as arrays: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    threshold: float = np.inf

    def ends(self, t: int, x: np.ndarray) -> np.ndarray:
        """The node of tree t at which each row's path ends."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(DEPTH):
            f = self.feature[t][node]
            go = 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= self.cut[t][node])
            node = np.where(f >= 0, go, node)
        return node

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 is odd."""
        total = np.zeros(len(x))
        for t in range(len(self.feature)):
            total += self.length[t][self.ends(t, x)]
        return 2.0 ** (-total / max(1, len(self.feature)) / _expected(TREE_ROWS))

    def visits(self, x: np.ndarray) -> np.ndarray:
        """The number of rows whose path ends at each node, (trees, nodes)."""
        return np.stack([np.bincount(self.ends(t, x), minlength=NODES) for t in range(len(self.feature))])


def _expected(n):
    """Mean path length of an unsuccessful search among n rows, which may be a mean number of rows."""
    n = np.asarray(n, np.float64)
    m = np.maximum(n, 1) - 0.5
    return np.where(n > 1, 2 * (np.log(m) + np.euler_gamma + 1 / (24 * m * m)) - 2 * (n - 1) / np.maximum(n, 1), 0.0)


def split(everything: np.ndarray) -> Forest:
    """Trees of full depth whose random splits range over the box of ``everything``."""
    rng = np.random.default_rng(SEED)
    feature, cut = np.full((TREES, NODES), -1), np.zeros((TREES, NODES))
    low, high = (np.tile(edge, (TREES, 1, 1)) for edge in (everything.min(0), everything.max(0)))
    for depth in range(DEPTH):
        at, wide = slice((1 << depth) - 1, (2 << depth) - 1), high > low
        f = np.where(wide, rng.random(wide.shape), -1).argmax(-1)[..., None]
        c = rng.uniform(np.take_along_axis(low, f, -1), np.take_along_axis(high, f, -1))
        feature[:, at], cut[:, at] = np.where(wide.any(-1), f[..., 0], -1), c[..., 0]
        own, shape = np.arange(low.shape[-1]) == f, (TREES, 2 << depth, low.shape[-1])
        low, high = np.stack([low, np.where(own, c, low)], 2).reshape(shape), np.stack([np.where(own, c, high), high], 2).reshape(shape)
    return Forest(feature, cut, np.zeros((TREES, NODES)))


def grow(x: np.ndarray | DataFrame, everything: np.ndarray) -> Forest:
    """Trees on all rows x, features or a table of statistics, whose random splits range over the box of
    ``everything``, so that a split can fall where x has no rows: what lands there is isolated at once.

    A path ends where one row or fewer of TREE_ROWS is left, which is what trees on draws of so many rows
    have there on average.
    """
    if not len(everything):
        return Forest(np.full((0, NODES), -1), np.zeros((0, NODES)), np.zeros((0, NODES)))
    forest = split(everything)
    n = forest.visits(x) if isinstance(x, np.ndarray) else visits(forest, x)
    for node in range(NODES // 2 - 1, -1, -1):
        n[:, node] += n[:, 2 * node + 1] + n[:, 2 * node + 2]
    rows = int(n[0, 0])
    if not rows:
        return Forest(forest.feature[:0], forest.cut[:0], forest.length[:0])
    share = n * min(1.0, TREE_ROWS / rows)
    forest.feature[share <= 1] = -1
    forest.length = np.where(forest.feature < 0, np.log2(np.arange(NODES) + 1).astype(np.int64) + _expected(share), 0.0)
    return forest


def calibrate(scores: np.ndarray, good: np.ndarray) -> float:
    """The score from which rows are dropped: the one with the best gap between the shares of bad
    and good rows it drops, among those that drop at most LOST of the good rows.  It lies half way
    between the least score it drops and the next one below."""
    if not good.any() or good.all():
        return np.inf
    well, ill = np.sort(scores[good]), np.sort(scores[~good])
    at = np.unique(ill)
    lost, caught = ((len(s) - np.searchsorted(s, at)) / len(s) for s in (well, ill))
    gap = np.where(lost <= LOST, caught - lost, 0.0)
    if not gap.max() > 0:
        return np.inf
    least = at[gap.argmax()]
    below = scores[scores < least].max(initial=-np.inf)
    middle = (below + least) / 2
    return float(middle if middle > below else least)


_DDL = "doc_id long, " + ", ".join(f"{s} long" for s in STATS + EXTRA)


def _features(b: pa.RecordBatch) -> np.ndarray:
    return features({n: b.column(b.schema.get_field_index(n)).to_numpy() for n in STATS + EXTRA})


def _edges(batches):
    """The least and the greatest of each feature over a task's rows, if it has any."""
    low = high = None
    for b in batches:
        if b.num_rows:
            x = _features(b)
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
    if low is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*low, *high)], names=[f"{e}{i}" for e in ("low", "high") for i in range(len(low))])


def box(rows: DataFrame) -> np.ndarray:
    """Two rows, the least and the greatest of each feature over all rows; none if there are none."""
    k = features({n: np.zeros(1) for n in STATS + EXTRA}).shape[1]
    names = [f"{e}{i}" for e in ("low", "high") for i in range(k)]
    ends = rows.mapInArrow(_edges, ", ".join(f"{n} double" for n in names)).agg(*(F.min(n) for n in names[:k]), *(F.max(n) for n in names[k:])).first()
    return np.array([ends[:k], ends[k:]], np.float64) if ends[0] is not None else np.zeros((0, k))


def _visits(shared):
    def run(batches):
        n = sum(shared.value.visits(_features(b)) for b in batches if b.num_rows)
        if np.ndim(n):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.ravel()[at])], names=["at", "n"])

    return run


def visits(forest: Forest, rows: DataFrame) -> np.ndarray:
    """Forest.visits of all rows of a table; a number for each node comes to the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)
    got = rows.mapInArrow(_visits(shared), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(forest.feature.size, np.int64)
    n[got["at"].to_numpy()] = got["n"].to_numpy()
    return n.reshape(forest.feature.shape)


def _score(shared):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.scores(_features(b))), b.column(b.schema.get_field_index("y"))], names=["score", "y"])

    return run


def _between(shared):
    """How many scores lie between one good row's and the next one's, and the least of them."""

    def run(batches):
        for b in batches:
            s = np.sort(b.column(0).to_numpy())
            at, first, n = np.unique(np.searchsorted(shared.value, s), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(s[first]), pa.array(n)], names=["at", "score", "n"])

    return run


def gather(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Scores of all rows, and whether they are good, that ``calibrate`` takes for those of the table
    (score double, y int).

    A threshold has at most LOST of the good rows above it, so only their scores come to the driver, a few
    more with them, and of the bad rows between two of them the number and the least score, as no other one there
    can be the least to drop.  The other good rows are told by their number.
    """
    good = scored.where("y = 1")
    bins = good.groupBy(F.floor(F.col("score") * BINS).alias("bin")).count().toArrow().to_pandas().sort_values("bin", ascending=False)
    total = int(bins["count"].sum())
    top, n_top = np.zeros(0), np.zeros(0, np.int64)
    if total:
        edge = bins["bin"][bins["count"].cumsum() / total > LOST].iloc[0] / BINS  # more than LOST from here on
        got = good.where(F.col("score") >= float(edge)).groupBy("score").count().toArrow().to_pandas().sort_values("score")
        top, n_top = got["score"].to_numpy(), got["count"].to_numpy()
    shared = scored.sparkSession.sparkContext.broadcast(top)
    bad = scored.where("y = 0").select("score").mapInArrow(_between(shared), "at long, score double, n long")
    bad = bad.groupBy("at").agg(F.min("score").alias("score"), F.sum("n").alias("n")).toArrow().to_pandas()
    below = np.full(total - int(n_top.sum()), top.min(initial=np.inf))
    scores = [np.repeat(top, n_top), below, np.repeat(bad["score"].to_numpy(np.float64), bad["n"].to_numpy(np.int64))]
    return np.concatenate(scores), np.arange(sum(map(len, scores))) < total


def _judge(shared):
    def run(batches):
        forest = shared.value
        for b in batches:
            s = {n: b.column(b.schema.get_field_index(n)).to_numpy() for n in STATS + EXTRA}
            failed = (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"])
            score = forest.scores(features(s)) if len(forest.feature) else np.zeros(b.num_rows)
            kept = ~failed & (score < forest.threshold)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(s[n]) for n in STATS), pa.array(failed), pa.array(kept), pa.array(score)], names=["doc_id", *STATS, "base_failed", "kept", "anomaly"])

    return run


def quality_rules(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Base rules and the forest's verdict.

    Returns a row for each input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, anomaly (0 to 1).  Null and empty texts have no words
    and fail the base rules.  Of the labelled rows that pass them, one half by a hash of the id
    calibrates, and all good ones of the other grow the forest; where those are fewer than TREE_ROWS, all
    rows that pass grow it.  Without labels of both kinds the forest drops nothing.  Rows
    with one id, and equal rows, are judged each by its own text; null labels and null ids are not
    learnt from.  An empty table gives no rows.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = Stored(spark)
    stats = stored.put("rules", docs.mapInArrow(_stats, _DDL))
    passed = stats.where(f"n_words >= {LEAST_WORDS} and 100 * n_repeat_words <= {MOST_REPEATED} * n_words")
    columns = STATS + EXTRA
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2).alias("half"))
    rows = passed.where("doc_id is not null").groupBy("doc_id").agg(*(F.min(F.struct(*columns)).getField(c).alias(c) for c in columns))  # of an id's rows one
    rows = stored.put("labelled", rows.join(known, "doc_id"))
    grown = rows.where("half = 0 and y = 1")
    forest = grow(grown if grown.count() >= TREE_ROWS else passed, box(passed))
    scored = stored.put("scored", rows.where("half = 1").mapInArrow(_score(spark.sparkContext.broadcast(forest)), "score double, y int"))
    forest.threshold = calibrate(*gather(scored))
    stored.drop("labelled", "scored")
    ddl = "doc_id long, " + ", ".join(f"{s} long" for s in STATS) + ", base_failed boolean, kept boolean, anomaly double"
    return stats.mapInArrow(_judge(spark.sparkContext.broadcast(forest)), ddl)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents; the threshold is calibrated on labels.quality."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
