"""Substring dedup by repeated-phrase automata.

Documents are dealt over chunks of bounded size.  Windows of ``width`` words that
start anywhere else are found in two rounds, in which a chunk sends each distinct
window once and gets a bit for it back:

1. filter: 32 bits of a window's hash, within the shard that the others choose,
2. confirm: 128 bits of the windows that passed, from two independent hashes.

Runs of recurring windows are a chunk's phrases.  They are compiled into the chunk's
shard of the Aho-Corasick automata, and all documents of the chunk are streamed
through it: each word inside an occurrence goes.  A phrase only concerns chunks in
which it occurs, so every document passes through one automaton, and an automaton's
size is bounded by its chunk's.  An automaton reads numbers of words, written in a few
digits each, so that its size does not depend on how long words are; two words have one
number only if their bytes are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.runtime import blob, by_shard, partitions, ship, spans, table

U64 = np.uint64
CHUNK_BYTES = 4 << 20
#: Text whose windows meet in one shard, at most: shards follow the data.
SHARD_BYTES = 32 << 20
#: Recurring windows that make one pattern.
PATTERN_WINDOWS = 64
#: An automaton's alphabet: digits of a word's number, one range for each place.
DIGITS = 64


def _in_order(t: pa.Table) -> pa.Table:
    """The chunk's documents in an order that doesn't depend on how they arrived."""
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")])


class _Chunk:
    """Words and windows of a chunk's documents; positions count all its words."""

    def __init__(self, t: pa.Table, width: int, second: bool):
        column = t.column("text").combine_chunks()
        self.buf, hashes, starts, ends, rows, pos, h1, h2, base, at_byte = [], [], [], [], [0], [], [], [], 0, 0
        for _, _, buf, off in K.text_slices(column):
            w = K.split_words(buf, off, K.SPACED)
            h, at = K.windows(w, width)
            h1.append(h)
            pos.append(at + base)
            if second:
                w2 = K.Words(K.hash_spans(buf, w.starts, w.ends, K.SECOND_SEED), w.starts, w.ends, w.rows)
                h2.append(K.windows(w2, width)[0])
            self.buf.append(buf)
            hashes.append(w.hashes)
            starts.append(w.starts + at_byte)
            ends.append(w.ends + at_byte)
            rows += (w.rows[1:] + base).tolist()
            base += int(w.rows[-1])
            at_byte += len(buf)
        whole = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.n, self.rows = base, np.array(rows, np.int64)
        self.words, self.starts, self.ends = whole(hashes, U64), whole(starts, np.int64), whole(ends, np.int64)
        self.pos, self.h, self.h2 = whole(pos, np.int64), whole(h1, U64), whole(h2, U64)

    def text(self) -> np.ndarray:
        return np.concatenate([*self.buf, np.zeros(1, np.uint8)])

    def numbers(self, text: np.ndarray) -> np.ndarray:
        """A number for each word; words have one number only if their bytes are equal."""
        _, first, number = np.unique(self.words, return_index=True, return_inverse=True)
        size, own = self.ends - self.starts, first[number]
        same = size == size[own]
        check = np.flatnonzero(same & (own != np.arange(self.n)))
        same[check] = K.same_spans(text, self.starts[check], text, self.starts[own[check]], size[check])
        others: dict[bytes, int] = {}
        for i in np.flatnonzero(~same).tolist():  # words that share a hash with another
            number[i] = others.setdefault(text[self.starts[i] : self.ends[i]].tobytes(), len(first) + len(others))
        return number

    def distinct(self, shards: int):
        """The distinct windows in order of shard and hash: (hashes, shard bounds, number in it of each window, count)."""
        names, inverse, count = np.unique(self.h, return_inverse=True, return_counts=True)
        order, cut = by_shard(((names >> U64(32)) % U64(shards)).astype(np.int32), shards)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return names[order], cut, rank[inverse], count[order]

    def distinct_pairs(self, cand: np.ndarray, shards: int):
        """The same of candidates' 128 bits."""
        h, h2 = self.h[cand], self.h2[cand]
        shard = ((h2 >> U64(32)) % U64(shards)).astype(np.int64)
        order = np.lexsort((h2, h, shard))
        a, b, s = h[order], h2[order], shard[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        return a[at], b[at], np.searchsorted(s[at], np.arange(shards + 1)), rank, np.bincount(rank, minlength=len(at))


_FILTER = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary())])
_BITS = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("bits", pa.binary())])
_CONFIRM = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_NO_SHARD = -1


def _filter_asks(width: int, shards: int):
    def run(key, t):
        chunk = key[0].as_py()
        names, cut, _, _ = _Chunk(_in_order(t), width, False).distinct(shards)
        low = names.astype(np.uint32)
        rows = [(s, chunk, blob(low[cut[s] : cut[s + 1]])) for s in range(shards) if cut[s] < cut[s + 1]]
        return pa.Table.from_batches([table(_FILTER, rows)])

    return run


def _recurs(same: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Flags, in the order before sorting, of entries that equal a neighbour in sorted order."""
    flag = np.zeros(len(order), bool)
    flag[1:] |= same
    flag[:-1] |= same
    out = np.empty(len(order), bool)
    out[order] = flag
    return out


def _split_bits(t: pa.Table, flags: np.ndarray, sizes: list[int]) -> list[tuple]:
    cut = np.concatenate(([0], np.cumsum(sizes)))
    ids = zip(t.column("chunk").to_pylist(), t.column("shard").to_pylist(), strict=True)
    return [(c, s, blob(np.packbits(flags[a:b]))) for (c, s), a, b in zip(ids, cut[:-1], cut[1:], strict=True)]


def _filter_answers(t: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint32) for x in t.column("keys").to_pylist()]
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    k = keys[order]
    return pa.Table.from_batches([table(_BITS, _split_bits(t, _recurs(k[1:] == k[:-1], order), [len(p) for p in parts]))])


def _answers(bits: pa.Table, cut: np.ndarray) -> np.ndarray:
    """The shards' bits, put together in the chunk's order."""
    out = np.zeros(cut[-1], bool)
    for s, x in zip(bits.column("shard").to_pylist(), bits.column("bits").to_pylist(), strict=True):
        if s != _NO_SHARD:
            out[cut[s] : cut[s + 1]] = np.unpackbits(np.frombuffer(x, np.uint8), count=int(cut[s + 1] - cut[s])).astype(bool)
    return out


def _confirm_asks(width: int, shards: int):
    def run(key, docs, bits):
        chunk = key[0].as_py()
        c = _Chunk(_in_order(docs), width, True)
        _, cut, rank, count = c.distinct(shards)
        cand = np.flatnonzero((_answers(bits, cut) | (count > 1))[rank])
        a, b, cut, _, _ = c.distinct_pairs(cand, shards)
        rows = [(s, chunk, blob(a[cut[s] : cut[s + 1]]), blob(b[cut[s] : cut[s + 1]])) for s in range(shards) if cut[s] < cut[s + 1]]
        mask = np.zeros(len(c.h), bool)
        mask[cand] = True
        if len(cand):  # the chunk's own candidates, to come back with the answers
            rows.append((_NO_SHARD - chunk, chunk, blob(np.packbits(mask)), b""))
        return pa.Table.from_batches([table(_CONFIRM, rows)])

    return run


def _confirm_answers(t: pa.Table) -> pa.Table:
    shard = t.column("shard").to_pylist()
    if shard[0] < 0:
        rows = [(c, _NO_SHARD, a) for c, a in zip(t.column("chunk").to_pylist(), t.column("a").to_pylist(), strict=True)]
        return pa.Table.from_batches([table(_BITS, rows)])
    parts = [np.frombuffer(x, U64) for x in t.column("a").to_pylist()]
    a, b = np.concatenate(parts), np.concatenate([np.frombuffer(x, U64) for x in t.column("b").to_pylist()])
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    return pa.Table.from_batches([table(_BITS, _split_bits(t, _recurs((x[1:] == x[:-1]) & (y[1:] == y[:-1]), order), [len(p) for p in parts]))])


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _spelled(number: np.ndarray) -> tuple[str, int]:
    """Words' numbers as a string, and the characters of a word: digits, whose ranges differ by place."""
    places = 1
    while DIGITS**places <= int(number.max(initial=0)):
        places += 1
    digit = np.stack([number // DIGITS**p % DIGITS + DIGITS * p for p in range(places)], 1)
    return digit.astype("<u4").tobytes().decode("utf-32-le"), places


def _patterns(first: np.ndarray, width: int):
    """(first word, words) of patterns that cover the windows that begin at ``first`` (ascending)."""
    if not len(first):
        return
    new = np.flatnonzero(np.append(True, np.diff(first) > 1))
    for a, b in zip(first[new].tolist(), first[np.append(new[1:], len(first)) - 1].tolist(), strict=True):
        for at in range(a, b + 1, PATTERN_WINDOWS):
            yield at, min(PATTERN_WINDOWS, b + 1 - at) + width - 1


def _located(c: _Chunk, recurring: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """The words of the chunk that lie in an occurrence of its phrases, found by the automaton of the phrases."""
    import ahocorasick

    spelled, places = _spelled(c.numbers(text))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    bounds = np.searchsorted(recurring, c.rows)
    for i in np.flatnonzero(np.diff(bounds)).tolist():
        for at, n in _patterns(recurring[bounds[i] : bounds[i + 1]], width):
            automaton.add_word(spelled[at * places : (at + n) * places])
    automaton.make_automaton()
    depth = np.zeros(c.n + 1, np.int64)
    for i in np.flatnonzero(np.diff(c.rows)).tolist():
        a, b = int(c.rows[i]), int(c.rows[i + 1])
        for end, size in automaton.iter(spelled[a * places : b * places]):
            last = a + (end + 1) // places
            depth[last - size // places] += 1
            depth[last] -= 1
    return np.cumsum(depth[:-1]) > 0


def _remove(width: int, shards: int, with_text: bool):
    def run(_key, docs, bits):
        docs = _in_order(docs)
        c = _Chunk(docs, width, bits.num_rows > 0)
        recurring = np.zeros(0, np.int64)
        own = [x for s, x in zip(bits.column("shard").to_pylist(), bits.column("bits").to_pylist(), strict=True) if s == _NO_SHARD]
        if own:
            cand = np.flatnonzero(np.unpackbits(np.frombuffer(own[0], np.uint8), count=len(c.h)))
            _, _, cut, rank, count = c.distinct_pairs(cand, shards)
            recurring = c.pos[cand[(_answers(bits, cut) | (count > 1))[rank]]]
        text = c.text()
        gone = _located(c, recurring, text, width) if len(recurring) else np.zeros(c.n, bool)
        removed, size = K.row_sums(gone, c.rows), c.ends - c.starts + 1
        left = np.concatenate(([0], np.cumsum(np.where(gone, 0, size))))[c.rows]  # bytes of the kept words and a space each
        flat = _joined(text, c.starts[~gone], size[~gone])
        rows = []
        for i, doc in enumerate(docs.column("doc_id").to_pylist()):
            kept = flat[left[i] : max(left[i], left[i + 1] - 1)]
            rows.append((doc, int(c.rows[i + 1] - c.rows[i]), int(removed[i]), hashlib.sha256(kept).hexdigest(), bytes(kept).decode() if with_text else None))
        return pa.Table.from_batches([table(_OUT, rows)])

    return run


def _joined(text: np.ndarray, starts: np.ndarray, size: np.ndarray) -> memoryview:
    """The words at ``starts``, of size - 1 bytes, each with a space after it."""
    out, done = np.empty(int(size.sum()), np.uint8), 0
    for a in range(0, len(starts), 1 << 17):
        n = size[a : a + (1 << 17)]
        part = text[spans(starts[a : a + (1 << 17)], n)]
        part[np.cumsum(n) - 1] = 0x20
        out[done : done + len(part)] = part
        done += len(part)
    return out.data


def remove_repeated_phrases(docs: DataFrame, width: int = 35, with_text: bool = True) -> DataFrame:
    """Remove each word covered by a window of ``width`` words that also starts anywhere else.

    Words are [^\\x20\\x09-\\x0D]+ as written; windows lie in one document and are judged on
    the input.  Returns a row for each input row: doc_id, n_words, n_removed, kept_sha256
    (of the kept words joined by one space) and, ``with_text``, kept, those words.  Null
    and empty texts have no words.  Rows with one id, and equal rows, are documents of
    their own, whose windows recur in each other.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, chunks = max(partitions(spark), -(-total // SHARD_BYTES)), max(1, -(-total // CHUNK_BYTES))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # a row's chunk depends on the row and its partition, not on its place there: a task that runs again deals alike
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(chunks)).cast("int"))
    own = docs.groupBy("chunk")
    asks = own.applyInArrow(_filter_asks(width, shards), "shard int, chunk int, keys binary")
    bits = asks.groupBy("shard").applyInArrow(lambda t: _filter_answers(t), "chunk int, shard int, bits binary")
    asks = own.cogroup(bits.groupBy("chunk")).applyInArrow(_confirm_asks(width, shards), "shard int, chunk int, a binary, b binary")
    bits = asks.groupBy("shard").applyInArrow(lambda t: _confirm_answers(t), "chunk int, shard int, bits binary")
    out = own.cogroup(bits.groupBy("chunk")).applyInArrow(_remove(width, shards, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out if with_text else out.drop("kept")


def op2_phrase_dedup(spark, sf_dir: str) -> DataFrame:
    """Windows of 35 words over all documents."""
    return remove_repeated_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)
