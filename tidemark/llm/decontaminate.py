"""Benchmark decontamination: a prefix-filtered containment join over item-sized windows.

A benchmark item is the windows of ``window`` consecutive words in it; a window is
the set of its word shingles.  A document contains a window only if it contains the
window's rarest shingle (the necessary prefix at a containment threshold of 1), so

1. shingles of all windows are counted over all documents, which orders them by rarity,
2. documents are joined with windows on each window's rarest shingle,
3. length and positional bounds drop windows that don't fit at that place of the row,
4. what is left is verified word by word, on the words' bytes.

The windows are the small side.  Their rarest shingles come from a join, and they are
broadcast as arrays in blocks of at most ``BLOCK_WINDOWS``, so what reaches the driver
and is broadcast has a fixed bound; a benchmark of more windows takes several passes,
whose hits are merged by row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.runtime import Stored, blob, ship, spans, table

U64 = np.uint64
SHINGLE = 5
#: Windows broadcast at a time: about 250 bytes each with their words and shingles.
BLOCK_WINDOWS = 200_000
#: Places verified at a time.
AT_A_TIME = 200_000
_BITS = U64((1 << 22) - 1)

_WINDOW_SCHEMA = pa.schema([("item_id", pa.string()), ("words", pa.binary()), ("width", pa.int32()), ("shingles", pa.list_(pa.int64()))])


def _item_windows(window: int):
    """Each window's words, lower-cased and joined by one space, and the hashes of its shingles."""

    def run(batches):
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for lo, _, buf, off in K.text_slices(b.column(1)):
                w = K.split_words(buf, off, K.ALNUM_FOLDED)
                data = K.folded(buf, K.ALNUM_FOLDED).tobytes()
                for i, n in enumerate(w.counts.tolist()):
                    if n:
                        a, c = w.rows[i], w.rows[i + 1]
                        width = min(n, window)
                        own = [data[x:y] for x, y in zip(w.starts[a:c].tolist(), w.ends[a:c].tolist(), strict=True)]
                        s = min(SHINGLE, width)
                        parts = K.mix(K.window_hashes(w.hashes[a:c], s)).view(np.int64).tolist()
                        rows += [(ids[lo + i], b" ".join(own[j : j + width]), width, parts[j : j + width - s + 1]) for j in range(n - width + 1)]
            yield table(_WINDOW_SCHEMA, rows)

    return run


class _Lookup:
    """Positions in a sorted table of hashes, by way of a bit table that most misses end in."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(int(_BITS) + 1, bool)
        self.bits[(keys & _BITS).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where in h, where in keys) of the entries of h that are keys."""
        at = np.flatnonzero(self.bits[(h & _BITS).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.searchsorted(self.keys, h[at])
        k[k == len(self.keys)] = 0
        ok = self.keys[k] == h[at]
        return at[ok], k[ok]


def _counts(shared):
    """How often each item shingle occurs in the documents of this task."""

    def run(batches):
        keys = shared.value
        looks = {s: _Lookup(k) for s, k in keys.items()}
        total = {s: np.zeros(len(k), np.int64) for s, k in keys.items()}
        for b in batches:
            for _, _, buf, off in K.text_slices(b.column(0)):
                w = K.split_words(buf, off, K.ALNUM_FOLDED)
                for s, look in looks.items():
                    _, k = look.find(K.windows(w, s)[0])
                    total[s] += np.bincount(k, minlength=len(total[s]))
        for s, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(keys[s][at].view(np.int64)), pa.array(t[at])], names=["shingle", "n"])

    return run


class _Index:
    """Windows by their rarest shingle, their words, and the items of each window."""

    def __init__(self, text, widths, prefix, offset, item_cut, items):
        self.text, self.widths, self.offset, self.item_cut, self.items = text, widths, offset, item_cut, items
        space = np.flatnonzero(text == 0x20)  # one after each word
        self.word_cut = np.concatenate(([0], np.cumsum(widths)))
        self.word_start = np.concatenate(([0], space[:-1] + 1)) if len(space) else space
        self.word_size = space - self.word_start
        self.by_width = {}
        for s in np.unique(np.minimum(widths, SHINGLE)).tolist():
            own = np.flatnonzero(np.minimum(widths, SHINGLE) == s)
            own = own[np.argsort(prefix[own], kind="stable")]
            keys, first, count = np.unique(prefix[own], return_index=True, return_counts=True)
            self.by_width[s] = (_Lookup(keys), own, first, count)

    def _verified(self, data: np.ndarray, w: K.Words, start: np.ndarray, win: np.ndarray) -> np.ndarray:
        """Whether the words from ``start`` on are those of the window, by their bytes."""
        width = self.widths[win]
        pair = np.repeat(np.arange(len(win)), width)
        mine, its = spans(start, width), spans(self.word_cut[win], width)
        size = self.word_size[its]
        same = w.ends[mine] - w.starts[mine] == size
        ok = np.ones(len(win), bool)
        ok[pair[~same]] = False
        left = np.flatnonzero(ok[pair])
        equal = K.same_spans(data, w.starts[mine[left]], self.text, self.word_start[its[left]], size[left])
        ok[pair[left[~equal]]] = False
        return ok

    def hits(self, buf: np.ndarray, w: K.Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of all verified occurrences in the rows of w."""
        starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        data = row_of = None
        for s, (look, own, first, count) in self.by_width.items():
            h, at = K.windows(w, s)
            pos, key = look.find(h)
            if not len(pos):
                continue
            if row_of is None:
                data, row_of = K.folded(buf, K.ALNUM_FOLDED), K.row_ids(w.rows)
            parts = np.searchsorted(np.cumsum(count[key]), np.arange(0, int(count[key].sum()), AT_A_TIME), "right")
            for a, b in zip(parts, [*parts[1:], len(pos)], strict=True):
                k = key[a:b]
                win = own[spans(first[k], count[k])]
                start = np.repeat(at[pos[a:b]], count[k]) - self.offset[win]
                row = row_of[np.repeat(at[pos[a:b]], count[k])]
                fits = (start >= w.rows[row]) & (start + self.widths[win] <= w.rows[row + 1])
                start, win = start[fits], win[fits]
                ok = self._verified(data, w, start, win)
                starts.append(start[ok])
                found.append(win[ok])
        return np.concatenate(starts), np.concatenate(found)


_HIT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("text_key", pa.binary()), ("hit", pa.binary()), ("items", pa.list_(pa.string()))])


def _scan(shared, keyed: bool):
    """Hit words (as start, end pairs) and items of each row."""

    def run(batches):
        index = _Index(*shared.value)
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for lo, hi, buf, off in K.text_slices(b.column(1)):
                w = K.split_words(buf, off, K.ALNUM_FOLDED)
                start, win = index.hits(buf, w)
                order = np.argsort(start, kind="stable")
                start, win = start[order], win[order]
                cut = np.searchsorted(start, w.rows)
                for i in range(hi - lo):
                    a, c = cut[i], cut[i + 1]
                    key = hashlib.sha256(buf[off[i] : off[i + 1]]).digest() if keyed else b""
                    if a == c:
                        rows.append((ids[lo + i], int(w.counts[i]), key, b"", []))
                        continue
                    own = np.unique(win[a:c])
                    names = {index.items[j] for k in own for j in range(index.item_cut[k], index.item_cut[k + 1])}
                    span = np.stack([start[a:c], start[a:c] + index.widths[win[a:c]]], 1) - w.rows[i]
                    rows.append((ids[lo + i], int(w.counts[i]), key, blob(span.astype(np.int64)), sorted(x for x in names if x is not None)))
            yield table(_HIT_SCHEMA, rows)

    return run


_OUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_OUT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])


def _finish(batches):
    for b in batches:
        rows = []
        for doc, n, hit, items in zip(*(b.column(x).to_pylist() for x in ("doc_id", "n_words", "hit", "items")), strict=True):
            hits = 0
            if hit:
                d = np.zeros(n + 1, np.int64)
                span = np.frombuffer(hit, np.int64).reshape(-1, 2)
                np.add.at(d, span[:, 0], 1)
                np.add.at(d, span[:, 1], -1)
                hits = int((np.cumsum(d[:-1]) > 0).sum())
            names = sorted(set(items))
            rows.append((doc, n, hits, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hits > 0))
        yield table(_OUT_SCHEMA, rows)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Words of each document inside any occurrence of a benchmark window.

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z.  An item of
    fewer words than ``window`` is one window; items without words (null or empty)
    are none.  Returns a row for each input row: doc_id, n_words, n_hit, n_items,
    items_sha256 (of the hit item ids as strings, sorted, comma-joined; of the empty
    string without hits) and contaminated.  Null and empty texts have no words.  Items
    with one id are one item; items with a null id hit words but are not counted or
    named.  Equal rows each get their row.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    indexes = list(_blocks_of(Stored(spark), benchmark, window))
    blocks = len(indexes)
    passes = [docs.mapInArrow(_scan(spark.sparkContext.broadcast(_build(spark, docs, index)), blocks > 1), "doc_id long, n_words long, text_key binary, hit binary, items array<string>") for index in indexes]
    if blocks == 1:
        return passes[0].mapInArrow(_finish, _OUT)
    merged = passes[0]
    for p in passes[1:]:
        merged = merged.union(p)
    merged = merged.groupBy("doc_id", "text_key", "n_words").agg(F.count("*").alias("n"), F.collect_set("hit").alias("hits"), F.flatten(F.collect_set("items")).alias("items"))
    merged = merged.select("doc_id", "n_words", F.array_join(F.transform("hits", F.hex), "").alias("hit"), "items", F.explode(F.sequence(F.lit(1), (F.col("n") / blocks).cast("int"))))
    return merged.select("doc_id", "n_words", F.unhex("hit").alias("hit"), "items").mapInArrow(_finish, _OUT)


def _blocks_of(store: Stored, benchmark: DataFrame, window: int):
    """The distinct windows of all items with the items that have them, at most BLOCK_WINDOWS or so at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    windows = items.mapInArrow(_item_windows(window), "item_id string, words binary, width int, shingles array<long>")
    windows = windows.groupBy("words").agg(F.first("width").alias("width"), F.first("shingles").alias("shingles"), F.collect_set("item_id").alias("items"), F.max(F.col("item_id").isNull()).alias("unnamed"))
    windows = store.put("windows", windows)
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    for block in range(blocks):
        yield windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)


def _build(spark, docs: DataFrame, windows: DataFrame):
    """The arrays of an _Index of a block: each window's rarest shingle in the documents comes from a join."""
    sizes = windows.select(F.least("width", F.lit(SHINGLE)).alias("s"), F.explode("shingles").alias("shingle"))
    known = sizes.groupBy("s").agg(F.sort_array(F.collect_set("shingle")).alias("keys")).toArrow()  # the block's shingles
    keys = {s.as_py(): np.sort(k.values.to_numpy(zero_copy_only=False).view(U64)) for s, k in zip(known.column("s"), known.column("keys"), strict=True)}
    seen = docs.select("text").mapInArrow(_counts(spark.sparkContext.broadcast(keys)), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    each = windows.select("words", F.posexplode("shingles").alias("pos", "shingle")).join(seen, "shingle", "left")
    rarest = each.groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "pos")).alias("r"))
    index = windows.join(rarest, "words").select("words", "width", "items", "unnamed", "r.shingle", "r.pos").toArrow()
    text = np.frombuffer(b"".join([x + b" " for x in index.column("words").to_pylist()]), np.uint8)
    names = [sorted(x) + [None] * bool(u) for x, u in zip(index.column("items").to_pylist(), index.column("unnamed").to_pylist(), strict=True)]
    cut = np.concatenate(([0], np.cumsum([len(x) for x in names]))).astype(np.int64)
    array = lambda c: index.column(c).to_numpy().astype(np.int64)
    return text, array("width"), array("shingle").view(U64), array("pos"), cut, [x for own in names for x in own]


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Ten-word windows of all benchmark items in all documents."""
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _clean(shared, text: str):
    def run(batches):
        index = _Index(*shared.value)
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            for lo, hi, buf, off in K.text_slices(b.column(b.schema.get_field_index(text))):
                w = K.split_words(buf, off, K.ALNUM_FOLDED)
                start, _ = index.hits(buf, w)
                keep[lo + np.searchsorted(w.rows, start, "right") - 1] = False
            yield b.filter(pa.array(keep))

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of docs, with all their columns, in which no benchmark window occurs.

    Null and empty texts have no words and stay, and so does everything if no item has words.  Rows with one id,
    and equal rows, are judged each by its own text; an empty table stays empty.  Columns can have any names.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    out = docs
    for index in _blocks_of(Stored(spark), benchmark, window):
        out = out.mapInArrow(_clean(spark.sparkContext.broadcast(_build(spark, texts, index)), "text"), docs.schema)
    return out
