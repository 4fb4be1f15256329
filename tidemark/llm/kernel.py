"""Vectorised text kernels over Arrow string buffers.

Words are never materialised as Python objects: a text column is looked at as one
byte buffer plus row offsets, word boundaries come from a 256-entry table, and a
word's 64-bit hash takes its bytes eight at a time, each through a mixing step that
no later one undoes.  Words of up to eight bytes and equal length never collide; words
of more than ``LONG`` bytes are hashed by xxh3.  Rows never run into each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
SLICE_BYTES = 1 << 20
#: Spans longer than this are hashed one by one.
LONG = 64
SEED, SECOND_SEED = 0x9E3779B97F4A7C15, 0x6A09E667F3BCC909
_WINDOW = U64(0xD6E8FEB86659FD93)
_SIZE = U64(0xA0761D6478BD642F)
_C1, _C2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: The first n of eight bytes.
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], U64)


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, in place on a fresh array."""
    h = h ^ (h >> U64(30))
    h *= _C1
    h ^= h >> U64(27)
    h *= _C2
    h ^= h >> U64(31)
    return h


@dataclass(frozen=True)
class Cut:
    """Which bytes belong to words, and what bytes are taken for others in hashes."""

    word: np.ndarray
    fold: np.ndarray | None = None


def cut_at(separators: bytes, fold_case: bool = False) -> Cut:
    """Words between separators; A-Z are taken for a-z when folding."""
    word = np.ones(256, bool)
    word[list(separators)] = False
    fold = None
    if fold_case:
        fold = np.arange(256, dtype=np.uint8)
        fold[ord("A") : ord("Z") + 1] += 32
    return Cut(word, fold)


#: Words [^\x20\x09-\x0D]+ , as written and with A-Z lower-cased.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
SPACED = cut_at(SPACES)
SPACED_FOLDED = cut_at(SPACES, True)
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
NON_ALNUM = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
ALNUM_FOLDED = cut_at(NON_ALNUM, True)
LINES = cut_at(b"\n")


def folded(buf: np.ndarray, cut: Cut) -> np.ndarray:
    return buf if cut.fold is None else cut.fold[buf]


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, zeros after the end."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray(len(buf) + 1, "<u8", buffer=padded, strides=(1,))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """A hash of the bytes of each span, as they are."""
    size = ends - starts
    if not len(size):
        return np.zeros(0, U64)
    eight, factor = lanes(buf), U64(seed | 1)
    h = mix((eight[starts] & _FIRST[np.minimum(size, 8)]) ^ (size.astype(U64) * _SIZE + U64(seed)))
    todo, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(todo):
        left = size[todo] - done
        h[todo] = mix(h[todo] * factor ^ (eight[starts[todo] + done] & _FIRST[np.minimum(left, 8)]))
        todo, done = todo[left > 8], done + 8
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].data, seed)
    return h


@dataclass
class Words:
    """Words of some rows: hash, byte span in the buffer, and row offsets into the words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


def split_words(buf: np.ndarray, offsets: np.ndarray, cut: Cut) -> Words:
    n = len(buf)
    if n == 0:
        e = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), e, e, np.zeros(len(offsets), np.int64))
    inside = cut.word[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(hash_spans(folded(buf, cut), starts, ends), starts, ends, np.searchsorted(starts, offsets))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two neighbours, in their order; not linear, so that no pattern of entries cancels out."""
    h = a * _WINDOW
    h += b
    h ^= h >> U64(32)
    h *= _C1
    return h


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Unmixed hash of every k consecutive entries (row borders not looked at), from those of halves."""
    if len(h) < k:
        return np.zeros(0, U64)
    power, width = h, 1  # hashes of `width` entries
    acc, acc_len, bits = None, 0, k
    while bits:
        if bits & 1:
            if acc is None:
                acc, acc_len = power, width
            else:  # acc covers [i, i + acc_len), then power
                m = len(h) - (acc_len + width) + 1
                acc = _pair(acc[:m], power[acc_len : acc_len + m])
                acc_len += width
        bits >>= 1
        if bits:
            m = len(h) - 2 * width + 1
            power = _pair(power[:m], power[width : width + m])
            width *= 2
    return acc


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Mixed hash of each k-word window that lies in one row, and the windows' first words."""
    h = window_hashes(words.hashes, k)
    if not len(h):
        return h, np.zeros(0, np.int64)
    # a window may not begin in the last k-1 words of a row
    depth = np.zeros(len(words.hashes) + 1, np.int32)
    lo = np.maximum(words.rows[1:] - (k - 1), words.rows[:-1])
    np.add.at(depth, lo, 1)
    np.add.at(depth, words.rows[1:], -1)
    ok = np.cumsum(depth)[: len(h)] == 0
    at = np.flatnonzero(ok)
    return mix(h[at]), at


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Mask over n words of those in any window [s, s + k)."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + k, n), -1)
    return np.cumsum(d[:-1]) > 0


def row_sums(mask: np.ndarray, rows: np.ndarray) -> np.ndarray:
    c = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=c[1:])
    return c[rows[1:]] - c[rows[:-1]]


def row_ids(rows: np.ndarray) -> np.ndarray:
    """The row number of each word."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, row offsets) of runs of rows; null texts are empty."""
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def same_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether span i of buffer a has the bytes of span i of buffer b, for spans of equal sizes."""
    same, todo, done = np.ones(len(size), bool), np.flatnonzero(size > 0), 0
    x, y = lanes(a), lanes(b)
    while len(todo):
        left = size[todo] - done
        if done >= LONG:
            for i in todo.tolist():
                same[i] = np.array_equal(a[a_starts[i] + done : a_starts[i] + size[i]], b[b_starts[i] + done : b_starts[i] + size[i]])
            break
        ok = ((x[a_starts[todo] + done] ^ y[b_starts[todo] + done]) & _FIRST[np.minimum(left, 8)]) == 0
        same[todo[~ok]] = False
        todo, done = todo[ok & (left > 8)], done + 8
    return same


def affixes(buf: np.ndarray, words: Words, cut: Cut, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of each word's first bytes (size > 0) or last bytes (size < 0), whole for shorter words."""
    data, out = folded(buf, cut), []
    for n in sizes:
        if n > 0:
            out.append(hash_spans(data, words.starts, np.minimum(words.starts + n, words.ends)))
        else:
            out.append(hash_spans(data, np.maximum(words.ends + n, words.starts), words.ends))
    return out
