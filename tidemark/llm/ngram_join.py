"""N-gram Jaccard join: exact near-duplicate links by a metric-space join.

Jaccard distance is a metric, so documents within distance r of each other differ
by at most r in their distance to any pivot.  The join goes in these steps:

1. Sets.  A document's set is its distinct word shingles; equal sets are one class.
2. Shared-shingle filter.  A class can only have a link if enough of its shingles
   occur in another class; shingles meet their like in shards, packed as arrays.
3. Families.  Shingles are ordered by rarity; classes with no common shingle in
   their prefixes, or none in the shorter prefix of the smaller one, are further than r
   apart.  What prefixes connect is a family, the top level of regions: distances between
   families need never be computed.
4. Voronoi regions.  Every family is cut by pivots, whatever its size.  A class goes to
   the region of its nearest pivot and, as a guest, to each region q with
   d(x, q) <= min(d(x, home) + 2r, radius(q) + r), outside of which the triangle
   inequality rules links out.  Regions are cut again until they are small.  What a
   task can hold (``BLOCK`` classes) is cut there, in arrays; what is larger is cut by a
   distributed step first, by the same rule.
5. The smallest regions, and those that no pivot splits, are joined exactly, by an
   inverted index.  Classes within r of the same pivot are connected already and not
   compared with each other.

A shingle that very many classes have reaches its shard once a block of classes, not
once a class.  Groups of copies never become pairs: classes absorb exact copies and only
the edges of a spanning forest leave a region.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernel as K
from tidemark.llm.components import components, join_hot
from tidemark.llm.runtime import Stored, blob, by_shard, joined, partitions, rows_of, ship, spans, table

U64 = np.uint64
#: Classes that a region's join holds in memory from each side.
BLOCK = 1024
#: Pivots of a cut, at most, and the classes at home of a region that needs no further cut.
PIVOTS, LEAF = 8, 1
#: A distributed cut that leaves more of the rows than this in regions beyond BLOCK is the last one.
STALLED = 0.7
#: Shingles gathered in a task before they are dealt to shards, and those that meet in a shard or a block: both follow the data.
GATHER = 4_000_000
SHARD_SHINGLES = 4_000_000
BLOCK_SHINGLES = 2_000_000

_SKETCH = "doc_id long, n_shingles long, fp_hi long, fp_lo long"


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row with words."""
    for lo, _, buf, off in K.text_slices(column):
        w = K.split_words(buf, off, K.SPACED_FOLDED)
        h, at = K.windows(w, width)
        cut = np.searchsorted(at, w.rows)
        for i, n in enumerate(w.counts):
            if n >= width:
                s = np.sort(h[cut[i] : cut[i + 1]])
                yield lo + i, s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif n:
                yield lo + i, K.mix(K.window_hashes(w.hashes[w.rows[i] : w.rows[i + 1]], int(n)))


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    a, b = K.mix(s ^ U64(0x51ED270B9F9D3A11)), K.mix(s ^ U64(0x2545F4914F6CDD1D))
    return int(np.add.reduce(a).view(np.int64)), int((np.bitwise_xor.reduce(b) ^ U64(len(s))).view(np.int64))


def _sketches(width: int):
    def run(batches):
        for b in batches:
            ids = b.column(0)
            n, hi, lo = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for i, s in _sets(b.column(1), width):
                n[i] = len(s)
                hi[i], lo[i] = _fingerprint(s)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(hi), pa.array(lo)], names=["doc_id", "n_shingles", "fp_hi", "fp_lo"])

    return run


def _runs(h: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))


_ASK_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("his", pa.binary()), ("los", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary()), ("common", pa.binary())])
_ASK = "shard int, block long, his binary, los binary, counts binary, keys binary, common binary"
_COUNT_SCHEMA = pa.schema([("part", pa.int32()), ("blocks", pa.binary()), ("his", pa.binary()), ("los", pa.binary()), ("counts", pa.binary())])
_COUNT = "part int, blocks binary, his binary, los binary, counts binary"


def _ask(block: int, fps: list[tuple[int, int]], sets: list[np.ndarray], shards: int, parts: int) -> pa.RecordBatch:
    """Rows for the shards from a block of distinct sets.

    A shingle that one set of the block has goes to its shard with the set.  One that several have
    is known to be shared: it goes there once, for the other blocks, and is counted here.  A shard
    and the low 32 bits identify a shingle for the filter.  Counts go to negative shards, -1 - part.
    """
    hi, lo = (np.array([f[i] for f in fps], np.int64) for i in (0, 1))
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    h = np.concatenate(sets)
    shard = ((h >> U64(32)) % U64(shards)).astype(np.int32)
    key = (shard.astype(U64) << U64(32)) | (h & U64(0xFFFFFFFF))
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    at = _runs(key)
    size = np.diff(np.append(at, len(key)))
    common = np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at)
    own, n = np.unique(owner[np.repeat(common, size)], return_counts=True)
    part = (lo[own].view(U64) % U64(parts)).astype(np.int32)
    order, cut = by_shard(part, parts)
    own, n = own[order], n[order].astype(np.int64)
    rows = [(-1 - p, block, blob(hi[o]), blob(lo[o]), blob(c), b"", b"") for p in range(parts) if cut[p] < cut[p + 1] for o, c in [(own[cut[p] : cut[p + 1]], n[cut[p] : cut[p + 1]])]]
    several = key[at[common]]
    single = ~np.repeat(common, size)
    key, owner = key[single], owner[single]
    order = np.argsort((key >> U64(32) << U64(32)) | owner.astype(U64))
    key, owner = key[order], owner[order]
    bounds = np.arange(shards + 1, dtype=U64) << U64(32)
    cut, cut2 = np.searchsorted(key >> U64(32), np.arange(shards + 1, dtype=U64)), np.searchsorted(several, bounds)
    for s in range(shards):
        a, b, c, d = cut[s], cut[s + 1], cut2[s], cut2[s + 1]
        if a < b or c < d:
            own, n = np.unique(owner[a:b], return_counts=True)
            rows.append((s, block, blob(hi[own]), blob(lo[own]), blob(n.astype(np.int32)), blob(key[a:b].astype(np.uint32)), blob(several[c:d].astype(np.uint32))))
    return table(_ASK_SCHEMA, rows)


def _filter_asks(width: int, shards: int, parts: int):
    """Each distinct set of a block of a task once."""

    def run(batches):
        place = TaskContext.get().partitionId() << 32
        sets: dict[tuple[int, int], np.ndarray] = {}
        held = done = 0
        for b in batches:
            for _, s in _sets(b.column(0), width):
                fp = _fingerprint(s)
                if fp not in sets:
                    sets[fp] = s
                    held += len(s)
                    if held >= GATHER:
                        yield _ask(place + done, list(sets), list(sets.values()), shards, parts)
                        sets, held, done = {}, 0, done + 1
        if sets:
            yield _ask(place + done, list(sets), list(sets.values()), shards, parts)

    return run


def _numbered(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """A number for each pair, the same for equal pairs only."""
    order = np.lexsort((lo, hi))
    new = np.ones(len(order), bool)
    new[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number


def _shared(parts: int):
    """How many of each set's shingles in this shard another set has too, as each block that has the set sees it."""

    def run(t: pa.Table) -> pa.Table:
        block = t.column("block").to_pylist()
        his, los, counts = (rows_of(t.column(c), d) for c, d in (("his", np.int64), ("los", np.int64), ("counts", np.int64 if t.column("shard")[0].as_py() < 0 else np.int32)))
        hi, lo = np.concatenate(his), np.concatenate(los)
        blocks = np.repeat(np.array(block, np.int64), [len(x) for x in his])
        if t.column("shard")[0].as_py() < 0:
            rows = [(-1 - t.column("shard")[0].as_py(), blob(blocks), blob(hi), blob(lo), blob(np.concatenate(counts)))]
            return pa.Table.from_batches([table(_COUNT_SCHEMA, rows)])
        count, number = np.concatenate(counts), _numbered(hi, lo)
        keys, common = joined(t.column("keys"), np.uint32), joined(t.column("common"), np.uint32)
        entry = np.append(np.repeat(np.arange(len(count)), count), np.full(len(common), -1))
        own = np.append(np.repeat(number, count), np.full(len(common), -1))
        keys = np.append(keys, common)
        order = np.argsort(keys)
        k, o, entry = keys[order], own[order], entry[order]
        at = _runs(k)
        low, high = np.minimum.reduceat(o, at), np.maximum.reduceat(o, at)
        both = np.repeat((low != high) | (low < 0), np.diff(np.append(at, len(k))))
        n = np.bincount(entry[both & (entry >= 0)], minlength=len(count)).astype(np.int64)
        some = np.flatnonzero(n)
        order, cut = by_shard((lo[some].view(U64) % U64(parts)).astype(np.int32), parts)
        some = some[order]
        rows = []
        for p in range(parts):
            own = some[cut[p] : cut[p + 1]]
            if len(own):
                rows.append((p, blob(blocks[own]), blob(hi[own]), blob(lo[own]), blob(n[own])))
        return pa.Table.from_batches([table(_COUNT_SCHEMA, rows)])

    return run


def _sum_shared(t: pa.Table) -> pa.Table:
    """A set's shared shingles: every block that has the set counts them all, so the greatest sum is the number."""
    block, hi, lo, n = (joined(t.column(c), np.int64) for c in ("blocks", "his", "los", "counts"))
    own = _numbered(hi, lo)
    pair = _numbered(own, block)
    total = np.bincount(pair, n).astype(np.int64)
    _, first = np.unique(pair, return_index=True)
    best = np.zeros(int(own.max()) + 1, np.int64)
    np.maximum.at(best, own[first], total)
    _, first = np.unique(own, return_index=True)
    return pa.table({"fp_hi": hi[first], "fp_lo": lo[first], "shared": best})


def _candidate_sets(width: int):
    def run(batches):
        for b in batches:
            rows = [(*_fingerprint(s), blob(s)) for _, s in _sets(b.column(0), width)]
            if rows:
                yield table(pa.schema([("fp_hi", pa.int64()), ("fp_lo", pa.int64()), ("toks", pa.binary())]), rows)

    return run


_DF_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _block_keys(t: pa.Table, shards: int):
    """The distinct shingles of a block in order of shard and key: (keys, shard bounds, number of each shingle of the sets, count)."""
    keys, inverse, count = np.unique(joined(t.column("toks"), U64), return_inverse=True, return_counts=True)
    order, cut = by_shard(((keys >> U64(32)) % U64(shards)).astype(np.int32), shards)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return keys[order], cut, rank[inverse], count[order]


def _df_asks(shards: int):
    def run(key, t):
        keys, cut, _, count = _block_keys(t.sort_by([("rid", "ascending")]), shards)
        rows = [(s, key[0].as_py(), blob(keys[cut[s] : cut[s + 1]]), blob(count[cut[s] : cut[s + 1]])) for s in range(shards) if cut[s] < cut[s + 1]]
        return pa.Table.from_batches([table(_DF_SCHEMA, rows)])

    return run


def _df_answers(t: pa.Table) -> pa.Table:
    """The number of sets that have each shingle, to each block that asked, in its order."""
    asked, counts = rows_of(t.column("keys"), U64), joined(t.column("counts"), np.int64)
    _, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    df = np.bincount(inverse, counts).astype(np.int64)[inverse]
    cut = np.concatenate(([0], np.cumsum([len(x) for x in asked])))
    rows = [(s, b, blob(df[x:y]), b"") for s, b, x, y in zip(t.column("shard").to_pylist(), t.column("block").to_pylist(), cut[:-1], cut[1:], strict=True)]
    return pa.Table.from_batches([table(_DF_SCHEMA, rows)])


_STAR_SCHEMA = pa.schema([("shard", pa.int32()), ("ids", pa.binary()), ("keys", pa.binary()), ("leads", pa.binary())])


def _star(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges from the smallest id of each key to its others, once; keys; their smallest ids)."""
    order = np.lexsort((ids, keys))
    k, o = keys[order], ids[order]
    at = _runs(k) if len(k) else np.zeros(0, np.int64)
    head = np.repeat(o[at], np.diff(np.append(at, len(k))))
    u, v = head[head != o], o[head != o]
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    return np.stack([u[new], v[new]]).astype(np.int64), k[at], o[at]


def _prefixes(percent: int, shards: int):
    """The necessary prefix of each set of a block, rarest shingles first.  Sets of the block that share a
    prefix shingle are connected here (edges go to a negative shard); one of them goes to its shard.

    The smaller set of a link has a shared shingle within a shorter prefix, its lead: it has at least
    2 * percent / (100 + percent) of its own shingles in common.  A shingle that leads nowhere connects no blocks.
    """

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([("rid", "ascending")])
        keys, cut, rank, _ = _block_keys(left, shards)
        df = np.zeros(len(keys), np.int64)
        for s, x in zip(right.column("shard").to_pylist(), rows_of(right.column("keys"), np.int64), strict=True):
            df[cut[s] : cut[s + 1]] = x
        rid = left.column("rid").to_numpy()
        n = left.column("n").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(rid)), [len(x) // 8 for x in left.column("toks").to_pylist()])
        k, f = keys[rank], df[rank]
        shared = f > 1
        k, f, owner = k[shared], f[shared], owner[shared]
        order = np.lexsort((k, f, owner))
        owner, k = owner[order], k[order]
        at = _runs(owner) if len(owner) else np.zeros(0, np.int64)
        count = np.diff(np.append(at, len(owner)))
        size = n[owner[at]]
        need = -(-percent * size // 100)
        take = np.clip(size - need + 1 - (size - count), 0, count)  # shingles no other class has come first
        lead = np.clip(size - -(-2 * percent * size // (100 + percent)) + 1 - (size - count), 0, take)
        pick = spans(at, take)
        leading = np.sort(k[spans(at, lead)])
        edges, k, ids = _star(k[pick], rid[owner[pick]])
        leads = np.searchsorted(leading, k, "right") > np.searchsorted(leading, k, "left")
        rows = [(-1 - key[0].as_py(), blob(edges[0]), blob(edges[1]), b"")] if edges.size else []
        order, cut = by_shard(((k >> U64(32)) % U64(shards)).astype(np.int32), shards)
        ids, k, leads = ids[order], k[order], leads[order]
        rows += [(s, blob(ids[a:b]), blob(k[a:b]), blob(leads[a:b])) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
        return pa.Table.from_batches([table(_STAR_SCHEMA, rows)])

    return run


def _stars(t: pa.Table) -> pa.Table:
    """An edge from the smallest class of each prefix shingle to the others, once."""
    if t.column("shard")[0].as_py() < 0:
        return pa.table({"u": joined(t.column("ids"), np.int64), "v": joined(t.column("keys"), np.int64)})
    keys, ids, leads = joined(t.column("keys"), U64), joined(t.column("ids"), np.int64), joined(t.column("leads"), bool)
    leading = np.sort(keys[leads])
    some = np.searchsorted(leading, keys, "right") > np.searchsorted(leading, keys, "left")
    edges, _, _ = _star(keys[some], ids[some])
    return pa.table({"u": edges[0], "v": edges[1]})


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


class _Region:
    """The sets of a region in one array of shingles, and the links found among them."""

    def __init__(self, sets: list[np.ndarray], group: list[int | None], percent: int):
        self.sets, self.percent = sets, percent
        self.n = np.array([len(s) for s in sets], np.int64)
        self.toks, self.at = np.concatenate(sets), np.concatenate(([0], np.cumsum(self.n)))[:-1]
        self.forest, self.out = _Forest(len(sets)), []
        self.cuts = 0
        known: dict[int, int] = {}
        for i, g in enumerate(group):
            if g is not None:
                self.forest.join(known.setdefault(g, i), i)

    def link(self, i: int, others: np.ndarray, both: np.ndarray) -> None:
        """Join i with those of the others that it links with, given the sizes of the intersections."""
        linked = (both > 0) & (100 * both >= self.percent * (self.n[others] + self.n[i] - both))
        for j in others[linked].tolist():
            if j != i and self.forest.join(i, j):
                self.out.append((i, j))

    def shared_with(self, pivot: int, members: np.ndarray, toks: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """The sizes of the members' intersections with the pivot's set."""
        p = self.sets[pivot]
        k = np.searchsorted(p, toks)
        k[k == len(p)] = 0
        return np.add.reduceat((p[k] == toks).astype(np.int64), cut)

    def exact(self, home: np.ndarray, guests: np.ndarray) -> None:
        """All links that have an end at home, by an inverted index of those at home."""
        owner = np.repeat(home, self.n[home])
        toks = self.toks[spans(self.at[home], self.n[home])]
        order = np.argsort(toks, kind="stable")
        toks, owner = toks[order], owner[order]
        at = _runs(toks)
        size = np.diff(np.append(at, len(toks)))
        first = toks[at]
        for i in np.concatenate([home, guests]).tolist():
            s = self.sets[i]
            where = np.searchsorted(first, s)
            where[where == len(first)] = 0
            where = where[first[where] == s]
            others, both = np.unique(owner[spans(at[where], size[where])], return_counts=True)
            self.link(i, others, both)

    def join(self, home: np.ndarray, guests: np.ndarray) -> None:
        """Cut by pivots into Voronoi regions with windows, recursively; what is small or can't be cut is joined exactly."""
        radius = 1 - self.percent / 100
        todo = [(home, guests)]
        while todo:
            home, guests = todo.pop()
            if not len(home) or len({self.forest.find(i) for i in (*home.tolist(), *guests.tolist())}) == 1:
                continue  # nothing to compare, or all connected already
            if len(home) <= LEAF:
                self.exact(home, guests)
                continue
            self.cuts += 1
            every = np.concatenate([home, guests])
            toks = self.toks[spans(self.at[every], self.n[every])]
            cut = np.concatenate(([0], np.cumsum(self.n[every])))[:-1]
            near, d = np.full(len(every), 2.0), []
            pivot = int(np.argmax(self.n[home]))  # then each time the class that is furthest from all pivots
            for _ in range(min(PIVOTS, -(-len(home) // LEAF))):
                both = self.shared_with(int(home[pivot]), every, toks, cut)
                self.link(int(home[pivot]), every, both)
                d.append(1 - both / (self.n[every] + self.n[home[pivot]] - both))
                near = np.minimum(near, d[-1])
                pivot = int(np.argmax(near[: len(home)]))
            d = np.stack(d)
            nearest = np.argmin(d, 0)
            inside = np.arange(len(every)) < len(home)
            parts = []
            for q in range(len(d)):
                own = inside & (nearest == q)
                if own.any():
                    window = ~own & (d[q] <= np.minimum(near + 2 * radius, d[q][own].max() + radius) + 1e-9)
                    parts.append((every[own], every[window]))
            if max(len(a) + len(b) for a, b in parts) > 0.9 * len(every):  # a window that holds nearly everything
                self.exact(home, guests)
            else:
                todo += parts


def region_links(ids: list[int], sets: list[np.ndarray], group: list[int | None], percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of all links among these sets.

    ``group``: sets with the same value are connected already.
    """
    region = _Region(sets, group, percent)
    region.join(np.arange(len(sets)), np.zeros(0, np.int64))
    return [(ids[i], ids[j]) for i, j in region.out]


def _join_task(percent: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("region", "ascending"), ("rid", "ascending")])
        regions, ids, group = (t.column(c).to_pylist() for c in ("region", "rid", "linked"))
        sets = rows_of(t.column("toks"), U64)
        links, at = [], 0
        for end in range(1, len(ids) + 1):
            if end == len(ids) or regions[end] != regions[at]:
                keep = [i for i in range(at, end) if i == at or ids[i] != ids[i - 1]]
                links += region_links([ids[i] for i in keep], [sets[i] for i in keep], [group[i] for i in keep], percent)
                at = end
        return pa.table({"u": pa.array([a for a, _ in links], pa.int64()), "v": pa.array([b for _, b in links], pa.int64())})

    return run


def _pivot_distances(batches):
    """Jaccard distances of a class to the pivots of its region."""
    for b in batches:
        rows = []
        for region, rid, home, toks, names, pivots in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            s = np.frombuffer(toks, U64)
            ds = []
            for p in pivots:
                p = np.frombuffer(p, U64)
                both = len(np.intersect1d(s, p, assume_unique=True))
                ds.append(1.0 - both / (len(s) + len(p) - both))
            rows.append((region, rid, home, names, ds))
        yield table(pa.schema([("region", pa.int64()), ("rid", pa.int64()), ("home", pa.bool_()), ("names", pa.list_(pa.int64())), ("ds", pa.list_(pa.float64()))]), rows)


def _cut(store: Stored, members: DataFrame, sets: DataFrame, radius: float, level: int) -> tuple[DataFrame, DataFrame]:
    """Cut each region of members (region, rid, home, linked) by pivots: its parts, and links to pivots."""
    own = members.where("home").join(sets.select("rid", "frac", "toks"), "rid")
    # the class with the largest share of common shingles is the most central; the others are dealt by hash
    slot = F.pmod(F.xxhash64("rid", F.lit(level)), F.lit(PIVOTS - 1))
    central = own.groupBy("region").agg(F.min(F.struct(-F.col("frac"), "rid")).getField("rid").alias("pivot"))
    dealt = own.groupBy("region", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("rid"), "rid")).getField("rid").alias("pivot"))
    picked = central.select("region", "pivot").union(dealt.select("region", "pivot")).distinct()
    picked = picked.join(sets.select(F.col("rid").alias("pivot"), "toks"), "pivot").groupBy("region").agg(F.sort_array(F.collect_list(F.struct("pivot", "toks"))).alias("p"))
    picked = store.put(f"picked-{level}", picked)
    salts = store.put(f"salts-{level}", members.groupBy("region").agg(F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK).cast("int").alias("salts")))
    spread = picked.join(salts, "region").select("region", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "salts", "p")
    rows = join_hot(members, salts, "region").select("region", "rid", "home", F.pmod(F.xxhash64("rid"), F.col("salts")).cast("int").alias("salt"))
    rows = rows.join(sets.select("rid", "toks"), "rid").join(spread, ["region", "salt"])
    rows = rows.select("region", "rid", "home", "toks", F.col("p.pivot").alias("names"), F.col("p.toks").alias("pivots"))
    found = store.put(f"pivots-{level}", rows.mapInArrow(_pivot_distances, "region long, rid long, home boolean, names array<long>, ds array<double>"))
    near = F.array_min("ds")
    each = found.select("rid", "home", near.alias("near"), F.array_position("ds", near).alias("at"), F.posexplode(F.arrays_zip("names", "ds")).alias("i", "z"))
    each = each.select("rid", "home", "near", F.col("z.names").alias("region"), F.col("z.ds").alias("d"), (F.col("at") == F.col("i") + 1).alias("nearest"))
    wide = each.groupBy("region").agg(F.max(F.when(F.col("home") & F.col("nearest"), F.col("d"))).alias("wide"), F.count("*").alias("n"))
    parts = join_hot(each, wide.where("wide is not null"), "region").where(f"d <= least(near + {2 * radius}, wide + {radius}) + 1e-9")
    parts = parts.select("region", "rid", (F.col("home") & F.col("nearest")).alias("home"), F.when(F.col("d") <= radius, F.col("region")).alias("linked"))
    links = each.where(f"d <= {radius}").select(F.col("rid").alias("u"), F.col("region").alias("v"))
    return store.put(f"regions-{level}", parts), links


def _region_join(store: Stored, family: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) that connect all classes that links connect; family: (node, label).

    Where there are regions to cut, every kind of edges of every level is a written table: the driver never
    holds the plan, tasks and exchanges of all of them at once.
    """
    radius = 1 - percent / 100
    size = family.groupBy("label").agg(F.count("*").alias("n"))
    sized = store.put("families", join_hot(family, size, "label").select(F.col("node").alias("rid"), F.col("label").alias("region"), F.col("n").alias("size")))
    task = _join_task(percent)
    # families that fit share a task, in which each is cut by pivots of its own
    bins = max(1, sized.where(f"size <= {BLOCK}").count() * 2 // BLOCK)
    few = sized.where(f"size <= {BLOCK}").select("rid", "region", F.pmod(F.xxhash64("region"), F.lit(bins)).alias("bin"), F.lit(None).cast("long").alias("linked"))
    out = few.join(sets.select("rid", "toks"), "rid").select("bin", "region", "rid", "linked", "toks").groupBy("bin").applyInArrow(lambda t: task(t), "u long, v long")
    many = sized.where(f"size > {BLOCK}").select("region", "rid", F.lit(True).alias("home"), F.lit(None).cast("long").alias("linked"))
    left, level = None, 0
    while True:
        before, left = left, many.count()
        if not left:
            return out
        if before and left > STALLED * before:  # windows that hold everything: no cut makes regions smaller
            return out.union(_blocks(store, many, sets, task, level))
        if not level:
            out = store.put("few", out)
        done, links = _cut(store, many, sets, radius, level)
        out = out.union(links)
        big = store.put(f"big-{level}", done.where("home").groupBy("region").count().where(f"count > {BLOCK}").select("region"))
        out = out.union(_blocks(store, done.join(big, "region", "left_anti"), sets, task, level))
        many = store.put(f"many-{level}", done.join(big, "region", "left_semi"))
        level += 1


def _blocks(store: Stored, members: DataFrame, sets: DataFrame, task, level: int) -> DataFrame:
    """Join regions block against block.  Members that are linked to the region's pivot have blocks of
    their own, which only meet blocks of the others; guests only meet blocks of those at home."""
    kind = F.when(F.col("linked").isNotNull(), 0).otherwise(1) + F.when(F.col("home"), 0).otherwise(2)
    rows = members.withColumn("kind", kind)
    count = store.put(f"kinds-{level}", rows.groupBy("region", "kind").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n")))
    rows = rows.join(count, ["region", "kind"]).select("region", "kind", "rid", "linked", F.pmod(F.xxhash64("rid"), F.col("n")).cast("int").alias("block"))
    block = count.select("region", "kind", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"))
    other = block.select("region", F.col("kind").alias("kind2"), F.col("block").alias("block2"))
    pairs = block.join(other, "region").where("struct(kind, block) <= struct(kind2, block2) and kind < 2 and not (kind in (0, 2) and kind2 in (0, 2))")
    key = F.concat_ws("-", "region", "kind", "block", "kind2", "block2").alias("task")
    ends = pairs.select("region", "kind", "block", key).union(pairs.select("region", F.col("kind2"), F.col("block2"), key)).distinct()
    ends = store.put(f"ends-{level}", ends)
    sent = rows.join(ends, ["region", "kind", "block"]).select("task", "region", "rid", "linked")
    found = sent.join(sets.select("rid", "toks"), "rid").groupBy("task").applyInArrow(lambda t: task(t), "u long, v long")
    return store.put(f"found-{level}", found)


def _linked_classes(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """For docs (doc_id, text): (doc_id, n_shingles, fp_hi, fp_lo, row) of all rows, and
    (fp_hi, fp_lo, doc_id, label) of all classes with words; label is one a component."""
    spark = docs.sparkSession
    ship(spark)
    store, least = Stored(spark), partitions(spark)
    all_rows = store.put("sketch", docs.mapInArrow(_sketches(width), _SKETCH).withColumn("row", F.monotonically_increasing_id()))
    shards = max(least, -(-(all_rows.agg(F.sum("n_shingles")).first()[0] or 0) // SHARD_SHINGLES))
    shared = docs.select("text").mapInArrow(_filter_asks(width, shards, least), _ASK).groupBy("shard").applyInArrow(_shared(least), _COUNT)
    shared = store.put("shared", shared.groupBy("part").applyInArrow(lambda t: _sum_shared(t), "fp_hi long, fp_lo long, shared long"))
    classes = all_rows.where("n_shingles > 0").groupBy("fp_hi", "fp_lo").agg(F.min("row").alias("rid"), F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.count("*").alias("copies"))
    able = store.put("able", classes.join(shared, ["fp_hi", "fp_lo"]).where(f"100 * shared >= {percent} * n").withColumn("frac", F.col("shared") / F.col("n")))
    shingles = able.agg(F.sum("n")).first()[0] or 0
    shards, blocks = max(least, -(-shingles // SHARD_SHINGLES)), max(least, -(-shingles // BLOCK_SHINGLES))
    # rows without an id, which may be many, are all looked at; the sets that are not able go below
    text = docs.join(able.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi").select("text").union(docs.where("doc_id is null").select("text"))
    sets = text.select("text").mapInArrow(_candidate_sets(width), "fp_hi long, fp_lo long, toks binary").dropDuplicates(["fp_hi", "fp_lo"])
    sets = store.put("sets", sets.join(able, ["fp_hi", "fp_lo"]).select("rid", "n", "frac", "toks"))
    own = sets.select(F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), "rid", "n", "toks").groupBy("block")
    dfs = own.applyInArrow(_df_asks(shards), "shard int, block int, keys binary, counts binary")
    dfs = dfs.groupBy("shard").applyInArrow(lambda t: _df_answers(t), "shard int, block int, keys binary, counts binary")
    prefix = own.cogroup(dfs.groupBy("block")).applyInArrow(_prefixes(percent, shards), "shard int, ids binary, keys binary, leads binary")
    stars = prefix.groupBy("shard").applyInArrow(lambda t: _stars(t), "u long, v long")
    family = components(store, stars, "family")
    edges = _region_join(store, family, sets, percent)
    links = components(store, edges, "links")
    store.drop(*[n for n in store.paths if n != "sketch" and not n.startswith("links-")])  # all else is worked up in these
    return all_rows, classes.join(links, classes.rid == links.node, "left").select("fp_hi", "fp_lo", "doc_id", "copies", F.coalesce("label", "rid").alias("label"))


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """Exact near-duplicate components over word shingles.

    Returns a row for each input row: doc_id, n_shingles (size of its set),
    component_id (smallest id in the component of 100 * |A & B| >= percent * |A | B| links).
    Null, empty and wordless texts have empty sets and link with nothing; texts of
    fewer than ``width`` words have one shingle, the whole sequence.  Rows with the
    same id or the same text each get their row; rows with a null id are linked as
    any other and keep their null, which is never a component's smallest id unless
    the component has no other.  Other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    all_rows, named = _linked_classes(docs, width, percent)
    store = Stored(docs.sparkSession)
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    named = store.put("named", join_hot(named, smallest, "label").select("fp_hi", "fp_lo", F.col("copies").alias("n"), "component_id"))
    out = join_hot(all_rows.where("n_shingles > 0"), named, ["fp_hi", "fp_lo"]).select("doc_id", "n_shingles", "component_id")
    return out.union(all_rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _with_sketch(width: int, text: str):
    def run(batches):
        for b in batches:
            n = b.num_rows
            words, hi, lo = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i, s in _sets(b.column(b.schema.get_field_index(text)), width):
                words[i] = True
                hi[i], lo[i] = _fingerprint(s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(words), pa.array(hi), pa.array(lo)], names=[*b.schema.names, "__words", "__hi", "__lo"])

    return run


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of docs, with all their columns, less all but one row of each component.

    What stays of a component is a row with its smallest id, a null id only if it has no other; of
    equal rows one.  Rows without words (null, empty or blank texts) all stay.  An empty table stays
    empty.  Columns keep their names and values, whatever their names.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    all_rows, named = _linked_classes(plain, width, percent)
    best = named.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp_hi", "fp_lo")).alias("b")).select("b.doc_id", "b.fp_hi", "b.fp_lo")
    times = all_rows.where("n_shingles > 0").groupBy("fp_hi", "fp_lo", "doc_id").count()
    same = (F.col("b.fp_hi") == F.col("t.fp_hi")) & (F.col("b.fp_lo") == F.col("t.fp_lo")) & F.col("b.doc_id").eqNullSafe(F.col("t.doc_id"))
    kept = best.alias("b").join(times.alias("t"), same).select(F.col("b.fp_hi").alias("__k_hi"), F.col("b.fp_lo").alias("__k_lo"), F.col("b.doc_id").alias("__k_id"), F.col("count").alias("__k_n"))
    kept = Stored(docs.sparkSession).put("kept", kept)
    # the operator's columns have names of their own, whatever docs' columns are called
    own = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    docs = docs.toDF(*own.values())
    schema = T.StructType([*docs.schema.fields, T.StructField("__words", T.BooleanType()), T.StructField("__hi", T.LongType()), T.StructField("__lo", T.LongType())])
    rows = docs.mapInArrow(_with_sketch(width, own["text"]), schema)
    on = (rows["__hi"] == kept["__k_hi"]) & (rows["__lo"] == kept["__k_lo"]) & rows[own["doc_id"]].cast("long").eqNullSafe(kept["__k_id"])
    rows = rows.join(kept, on, "left")
    back = [F.col(n).alias(c) for c, n in own.items()]
    out = rows.where("not __words or __k_n = 1").select(*back)
    if kept.where("__k_n > 1").isEmpty():  # no row is there twice
        return out
    return out.union(rows.where("__words and __k_n > 1").dropDuplicates(["__hi", "__lo", "__k_id"]).select(*back))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Five-word shingles at 75 % over all documents."""
    return ngram_jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
