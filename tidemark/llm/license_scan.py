"""License scans: an exact set-similarity join of text blocks with notice templates.

A block is a run of consecutive words, as long as a template and a quarter more.  A
template's tokens are ordered by their frequency over all documents; a block that
contains enough of them contains one of the rarest few, its prefix.  Documents are
joined with templates on prefix tokens; length and positional bounds drop what can't
reach the threshold, and the rest is counted exactly.  All blocks are reported with their
places; a block speaks for its label if it has enough of the template's words in their
order, so that the words of a short notice in another order say nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.license_texts import TEMPLATES
from tidemark.llm.runtime import ship, table

U64 = np.uint64
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
THRESHOLD = 0.9
#: Templates are broadcast; a table of more is refused.
MOST_TEMPLATES = 10_000
SLACK = 1.25


def _hashes(text: str) -> np.ndarray:
    b = np.frombuffer(text.encode(), np.uint8)
    return K.split_words(b, np.array([0, len(b)]), K.ALNUM_FOLDED).hashes


@dataclass
class _Template:
    label: str
    name: str
    words: np.ndarray  # in the text's order
    tokens: np.ndarray  # distinct, rarest first
    need: int
    block: int


def common_words(a: list[int], b: list[int]) -> int:
    """The length of the longest common subsequence, by bits of one integer."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & masks.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


class _Matcher:
    def __init__(self, templates, phrases, threshold: float, counts: dict[int, int]):
        self.templates, self.threshold = [], threshold
        for label, name, text in templates:
            words = _hashes(text)
            if not len(words):
                continue
            h = np.unique(words)
            order = sorted(range(len(h)), key=lambda i: (counts.get(int(h[i]), 0), int(h[i])))
            need = int(np.ceil(threshold * len(h) - 1e-9))
            self.templates.append(_Template(label, name, words, h[order], need, int(np.ceil(SLACK * len(words)))))
        self.phrases = [(label, _hashes(p)) for p, label in phrases]
        self.keys = np.unique(np.concatenate([np.zeros(0, U64)] + [t.tokens for t in self.templates] + [h for _, h in self.phrases]))
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(self.keys & U64(0xFFFF)).astype(np.int64)] = True
        self.at = [np.searchsorted(self.keys, t.tokens) for t in self.templates]
        self.words = [np.searchsorted(self.keys, t.words).tolist() for t in self.templates]
        self.prefix = [a[: len(a) - t.need + 1] for a, t in zip(self.at, self.templates, strict=True)]
        self.phrase_at = [np.searchsorted(self.keys, h) for _, h in self.phrases]

    def tokens(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, token numbers) of template tokens among words."""
        at = np.flatnonzero(self.bits[(h & U64(0xFFFF)).astype(np.int64)])
        if not len(at):
            return at, at
        k = np.searchsorted(self.keys, h[at])
        k[k == len(self.keys)] = 0
        ok = self.keys[k] == h[at]
        return at[ok], k[ok]

    def base(self, pos: np.ndarray, tok: np.ndarray) -> list[tuple[int, str]]:
        """(start, label) of phrases; pos and tok of one row."""
        out = []
        for (label, _), want in zip(self.phrases, self.phrase_at, strict=True):
            m = len(pos) - len(want) + 1
            if m > 0:
                ok = np.ones(m, bool)
                for j, t in enumerate(want):
                    ok &= (tok[j : j + m] == t) & (pos[j : j + m] == pos[:m] + j)
                out += [(int(p), label) for p in pos[:m][ok]]
        return out

    def similar(self, pos: np.ndarray, tok: np.ndarray, n_words: int) -> list[tuple[str, str, int, int, float, bool]]:
        """(label, template, first word, end, containment, in order) of the blocks of one row that reach the threshold.

        A block begins at a template's token and ends after its last within the block's length.  Of blocks that
        overlap the one with the greatest containment counts, the first of equals; ``in order`` says whether it has
        the threshold's share of the template's words in their order.
        """
        out = []
        seen = np.zeros(len(self.keys), bool)
        seen[tok] = True
        for t, at, words, prefix in zip(self.templates, self.at, self.words, self.prefix, strict=True):
            if n_words < t.need or not seen[prefix].any() or seen[at].sum() < t.need:  # length; prefix; all that the row has
                continue
            rank = np.full(len(self.keys), -1)
            rank[at] = np.arange(len(at))
            own = rank[tok]
            p, r = pos[own >= 0], own[own >= 0]
            # a block may begin at a token of the template; it is counted up to where it ends
            ends = np.searchsorted(p, p + t.block)
            lead = np.append(np.searchsorted(p, p - t.block, "right"), len(p))
            hits = np.flatnonzero(r <= len(at) - t.need)
            reach = np.zeros(len(p) + 1, np.int64)
            np.add.at(reach, lead[hits], 1)  # starts whose block can hold the prefix token
            np.add.at(reach, hits + 1, -1)
            best = None
            for s in np.flatnonzero((np.cumsum(reach[:-1]) > 0) & (ends - np.arange(len(p)) >= t.need)).tolist():
                if best and p[s] > p[ends[best[1]] - 1]:
                    out.append(self._block(t, words, p, tok[own >= 0], best, ends))
                    best = None
                got = len(np.unique(r[s : ends[s]]))
                if got >= t.need and (best is None or got > best[0]):
                    best = (got, s)
            if best:
                out.append(self._block(t, words, p, tok[own >= 0], best, ends))
        return sorted(out, key=lambda x: (x[2], x[3], x[1]))

    def _block(self, t: _Template, words: list[int], p: np.ndarray, tok: np.ndarray, best: tuple[int, int], ends: np.ndarray):
        got, s = best
        inside = tok[s : ends[s]].tolist()
        ordered = common_words(words, inside) >= self.threshold * len(words) - 1e-9
        return (t.label, t.name, int(p[s]), int(p[ends[s] - 1]) + 1, got / len(t.tokens), ordered)


def _count(shared):
    def run(batches):
        m = shared.value
        total = np.zeros(len(m.keys), np.int64)
        for b in batches:
            for _, _, buf, off in K.text_slices(b.column(0)):
                total += np.bincount(m.tokens(K.split_words(buf, off, K.ALNUM_FOLDED).hashes)[1], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(m.keys.view(np.int64)), pa.array(total)], names=["token", "n"])

    return run


_BLOCK = pa.struct([("label", pa.string()), ("template", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64()), ("in_order", pa.bool_())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))), ("blocks", pa.list_(_BLOCK))])
_DDL = "doc_id long, n_words long, base array<struct<label: string, start: long>>, blocks array<struct<label: string, template: string, start: long, end: long, containment: double, in_order: boolean>>"


def _scan(shared):
    def run(batches):
        m = shared.value
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for lo, hi, buf, off in K.text_slices(b.column(1)):
                w = K.split_words(buf, off, K.ALNUM_FOLDED)
                pos, tok = m.tokens(w.hashes)
                cut = np.searchsorted(pos, w.rows)
                for i in range(hi - lo):
                    a, c, n = cut[i], cut[i + 1], int(w.counts[i])
                    p, t = pos[a:c] - w.rows[i], tok[a:c]
                    base = [{"label": x, "start": s} for s, x in sorted(m.base(p, t))] if a < c else []
                    near = [dict(zip(_BLOCK.names, x, strict=True)) for x in m.similar(p, t, n)] if a < c else []
                    rows.append((ids[lo + i], n, base, near))
            yield table(_SCHEMA, rows)

    return run


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """License phrases and notices in each document, with their places.

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z.  ``templates``: (label, name,
    text) rows, as a DataFrame or a sequence; those without words match nothing.  Returns a row for each
    input row: doc_id, n_words, base (label and start of each base phrase) and blocks (label, template, start, end,
    containment, in_order of each block of words that has at least ``threshold`` of a template's distinct words;
    see ``_Matcher.similar``).  Null and empty texts have no words and empty arrays.  Rows with one id, and
    equal rows, get a row each.  Other columns are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    if isinstance(templates, DataFrame):  # a table of notices, which is broadcast as a whole: MOST_TEMPLATES at most
        templates = [tuple(r) for r in templates.select("label", "name", "text").where("text is not null").limit(MOST_TEMPLATES + 1).collect()]
        if len(templates) > MOST_TEMPLATES:
            raise ValueError(f"more than {MOST_TEMPLATES} templates")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain = spark.sparkContext.broadcast(_Matcher(templates, phrases, threshold, {}))
    counts = docs.select("text").mapInArrow(_count(plain), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # a row a template token
    counts = {int(np.int64(r.token).view(U64)): r.n for r in counts}
    return docs.mapInArrow(_scan(spark.sparkContext.broadcast(_Matcher(templates, phrases, threshold, counts))), _DDL)


def license_digest(found: DataFrame) -> DataFrame:
    """A row for each row of ``scan_licenses``: n_base, first_word, last_word (null without a base phrase), base_labels,
    labels (with those of blocks in order), score (1 with a base phrase, else the greatest containment of such blocks, else 0)."""
    near = F.filter("blocks", lambda x: x["in_order"])
    base, starts = F.col("base.label"), F.col("base.start")
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.transform(near, lambda x: x["containment"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        text(base).alias("base_labels"),
        text(F.concat(base, F.transform(near, lambda x: x["label"]))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"),
        "blocks",
    )


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """All documents against the templates."""
    return license_digest(scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))).drop("blocks")
