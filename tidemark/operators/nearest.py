"""Exact nearest neighbours in array code: chunks of vectors meet blocks of queries, a matrix product a pair.

A chunk or a block is one row with its ids and the bytes of its vectors, so what is joined are few rows.  The product
only tells which vectors may be among a query's k nearest, with room for its rounding; their distances are then worked
out component by component, in the order and with the results of ``functions.vectors.distance``, and ties end in the
record id.  A task keeps k rows a query of its blocks.

What executors run is made by functions and refers to nothing of this package, which they need not have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of a chunk, at most.
CHUNK = 2_048
#: Blocks whose best rows a task holds, at most; beyond that it hands them on and begins anew.
HELD = 64


def _packer(most: int):
    """Rows (key, ident, vector) to rows (key, ids, dim, data, nulls) of at most ``most`` vectors of one key and dimension."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def pack(batches):
        for b in batches:
            if not b.num_rows:
                continue
            key, ids, vectors = (b.column(i) for i in range(3))
            dims = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = key.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((dims, keys))
            cut = np.flatnonzero((np.diff(keys[order]) != 0) | (np.diff(dims[order]) != 0)) + 1
            for part in np.split(order, cut):
                for at in range(0, len(part), most):
                    own = pa.array(part[at : at + most])
                    flat = vectors.take(own).flatten()
                    nulls = flat.is_null().to_numpy(zero_copy_only=False).tobytes() if flat.null_count else b""
                    data = flat.to_numpy(zero_copy_only=False).astype(np.float64).tobytes()  # a null is nan here
                    first = int(part[at])
                    row = [pa.array([keys[first]], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), ids.take(own)), pa.array([dims[first]], pa.int32()), pa.array([data], pa.binary()), pa.array([nulls], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, names=["key", "ids", "dim", "data", "nulls"])

    return pack


def packed(rows: DataFrame, most: int) -> DataFrame:
    """(key, ids, dim, data, nulls) of rows (key long, ident, vector)."""
    kind = rows.schema[rows.columns[1]].dataType.simpleString()
    return rows.mapInArrow(_packer(most), f"key long, ids array<{kind}>, dim int, data binary, nulls binary")


def _scanner(k: int, metric: str, held_most: int):
    """Rows (v_ids, v_dim, v_data, v_nulls, block, q_ids, q_dim, q_data, q_nulls) to the k nearest (query_id, record_id, distance) of each query of a block."""
    import numpy as np
    import pyarrow as pa

    EPS, MOST = float(np.finfo(np.float64).eps), np.iinfo(np.int64).max

    def side(dim, data, nulls):
        """By component, one row each; which elements are null; the norm, or its square."""
        x = np.frombuffer(data, np.float64)
        x = np.ascontiguousarray(x.reshape(-1, dim).T) if dim else np.zeros((0, 0))
        none = np.frombuffer(nulls, bool).reshape(-1, dim).T if nulls else None
        square = np.zeros(x.shape[1])
        for row in x:
            square += row * row
        lost = none.any(axis=0) if none is not None else np.zeros(x.shape[1], bool)
        return x, none, square, lost

    def apart(x, y, nx, ny):
        """Whether components differ, as Spark's <> says: nan equals nan, and null is not different."""
        out = x != y
        out &= ~(np.isnan(x) & np.isnan(y))
        if nx is not None:
            out &= ~nx
        if ny is not None:
            out &= ~ny
        return out

    def estimate(q, v):
        """Distances up to ``room`` of each query: (matrix, room)."""
        (qx, qn, q2, q_lost), (vx, vn, v2, v_lost) = q, v
        d = len(qx)
        if metric == "hamming":
            out = np.zeros((qx.shape[1], vx.shape[1]))
            for j in range(d):
                out += apart(qx[j][:, None], vx[j][None, :], qn[j][:, None] if qn is not None else None, vn[j][None, :] if vn is not None else None)
            return out, np.zeros(len(out))
        if metric == "l2":
            a = np.concatenate([-2.0 * qx, np.ones((1, qx.shape[1])), q2[None]])
            b = np.concatenate([vx, v2[None], np.ones((1, vx.shape[1]))])
            return a.T @ b, 8 * (d + 8) * EPS * (q2 + v2.max(initial=0.0)) + 1e-300
        if metric == "dot":
            return (-qx).T @ vx, 8 * (d + 8) * EPS * np.sqrt(q2) * np.sqrt(v2.max(initial=0.0)) + 1e-300
        qm, vm = np.where(q_lost, np.nan, np.sqrt(q2)), np.where(v_lost, np.nan, np.sqrt(v2))
        tame = lambda s: (s > 1e-200) & (s < 1e200)
        out = 1.0 - (qx / np.where(tame(q2), qm, np.nan)).T @ (vx / np.where(tame(v2), vm, np.nan))  # what is not tame has none, and is worked out
        return out, np.full(len(out), 16 * (d + 8) * EPS)

    def exact(q, v, qi, vi):
        """(distance, whether it is null) of pairs."""
        (qx, qn, q2, q_lost), (vx, vn, v2, v_lost) = q, v
        total = np.zeros(len(qi))
        for j in range(len(qx)):
            x, y = vx[j][vi], qx[j][qi]
            if metric == "l2":
                x = x - y
                total += x * x
            elif metric == "hamming":
                total += apart(x, y, vn[j][vi] if vn is not None else None, qn[j][qi] if qn is not None else None)
            else:
                total += x * y
        lost = q_lost[qi] | v_lost[vi]
        if metric == "cosine":
            n = np.sqrt(v2[vi]) * np.sqrt(q2[qi])
            n[lost] = 0.0
            return np.where(n == 0, 1.0, 1.0 - total / np.where(n == 0, 1.0, n)), np.zeros(len(qi), bool)
        if metric == "hamming":
            return total, np.zeros(len(qi), bool)
        return (-total if metric == "dot" else total), lost

    def ranks(ids):
        """Numbers in the order of ids."""
        if ids.dtype != object:
            return ids
        at = {x: i for i, x in enumerate(sorted(set(ids), key=lambda x: (x is not None, x if x is not None else 0)))}
        return np.array([at[x] for x in ids], np.int64)

    class Block:
        """The best rows so far of a block of queries."""

        def __init__(self, r):
            self.ids, self.dim = r["q_ids"], r["q_dim"]
            self.n = len(self.ids)
            self.side = side(self.dim, r["q_data"], r["q_nulls"]) if self.dim > 0 else (np.zeros((0, self.n)), None, np.zeros(self.n), np.zeros(self.n, bool))
            self.at, self.distance, self.null, self.found = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), None
            self.worst = np.full(self.n, np.inf)  # the k-th distance, and its id
            self.worst_id = np.full(self.n, MOST)

        def meet(self, ids, v):
            numbers = ids.dtype != object
            near, room = estimate(self.side, v)
            bound = self.worst + room
            new = np.isinf(self.worst)
            tied = None
            if metric == "hamming" and numbers:  # exact, with many ties: they end here
                order = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
                tied = near * len(ids) + order
            if new.any() and len(ids) > k:
                cut = (tied if tied is not None else near)[new]
                bound[new] = np.partition(cut, k - 1, axis=1)[:, k - 1] + 2 * room[new]
            if tied is not None:
                few = near <= self.worst[:, None]
                few &= (near < self.worst[:, None]) | (ids[None, :] < self.worst_id[:, None]) | new[:, None]
                if new.any() and len(ids) > k:
                    few[new] &= tied[new] <= bound[new][:, None]
            else:
                few = ~(near > bound[:, None])  # what has no estimate stays
            qi, vi = np.nonzero(few)
            if not len(qi):
                return
            parts = [exact(self.side, v, qi[i : i + 200_000], vi[i : i + 200_000]) for i in range(0, len(qi), 200_000)]
            distance, null = (np.concatenate(x) for x in zip(*parts, strict=True))
            stay = null | ~(distance > self.worst[qi])
            if numbers:
                stay &= null | ~((distance == self.worst[qi]) & (ids[vi] > self.worst_id[qi]))
            qi, vi, distance, null = qi[stay], vi[stay], distance[stay], null[stay]
            at, distance, null = np.concatenate([self.at, qi]), np.concatenate([self.distance, distance]), np.concatenate([self.null, null])
            found = ids[vi] if self.found is None else np.concatenate([self.found, ids[vi]])
            order = np.lexsort((ranks(found), np.where(null, 0.0, distance), ~null, at))
            at = at[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            order, at, place = order[place < k], at[place < k], place[place < k]
            self.at, self.distance, self.null, self.found = at, distance[order], null[order], found[order]
            last = place == k - 1
            open_ = self.null[last] | np.isnan(self.distance[last])
            self.worst[at[last]] = np.where(open_, np.inf, self.distance[last])
            if numbers:
                self.worst_id[at[last]] = np.where(open_, MOST, self.found[last])

        def rows(self, kinds):
            if self.found is None:
                return
            for i in range(0, len(self.at), 10_000):
                cut = slice(i, i + 10_000)
                own = [pa.array([self.ids[x] for x in self.at[cut]], kinds[0]), pa.array(self.found[cut].tolist(), kinds[1]), pa.array(self.distance[cut], pa.float64(), mask=self.null[cut])]
                yield pa.RecordBatch.from_arrays(own, names=["query_id", "record_id", "distance"])

    def scan(batches):
        np.seterr(all="ignore")
        blocks, kinds, chunk = {}, None, (None, None)
        for b in batches:
            kinds = [b.schema.field(n).type.value_type for n in ("q_ids", "v_ids")]
            for i in range(b.num_rows):
                name = b.column("block")[i].as_py()
                if name not in blocks:
                    if len(blocks) >= held_most:
                        for x in blocks.values():
                            yield from x.rows(kinds)
                        blocks = {}
                    blocks[name] = Block({n: b.column(n)[i].as_py() for n in ("q_ids", "q_dim", "q_data", "q_nulls")})
                dim = b.column("v_dim")[i].as_py()
                if dim != blocks[name].dim:
                    raise ValueError("vectors of different dimensions")
                ids = b.column("v_ids")[i].values
                if dim == 0:  # vectors without components
                    v = (np.zeros((0, len(ids))), None, np.zeros(len(ids)), np.zeros(len(ids), bool))
                else:
                    v = side(dim, b.column("v_data")[i].as_buffer(), b.column("v_nulls")[i].as_py())
                plain = pa.types.is_integer(ids.type) and not ids.null_count
                blocks[name].meet(ids.to_numpy(zero_copy_only=False).astype(np.int64) if plain else np.array(ids.to_pylist(), object), v)
        for x in blocks.values():
            yield from x.rows(kinds)

    return scan


def scan(pairs: DataFrame, k: int, metric: str) -> DataFrame:
    """(query_id, record_id, distance): for each task the k nearest of each query, of the chunks and blocks that met in it."""
    kinds = [pairs.schema[c].dataType.elementType.simpleString() for c in ("q_ids", "v_ids")]
    rows = pairs.select("v_ids", "v_dim", "v_data", "v_nulls", "block", "q_ids", "q_dim", "q_data", "q_nulls")
    return rows.mapInArrow(_scanner(k, metric, HELD), f"query_id {kinds[0]}, record_id {kinds[1]}, distance double")


def chunks(rows: DataFrame) -> DataFrame:
    """Vectors (key, record_id, vector) in chunks: (key, v_ids, v_dim, v_data, v_nulls)."""
    return packed(rows, CHUNK).select("key", F.col("ids").alias("v_ids"), F.col("dim").alias("v_dim"), F.col("data").alias("v_data"), F.col("nulls").alias("v_nulls"))


def blocks(rows: DataFrame, most: int) -> DataFrame:
    """Queries (key, query_id, vector) in blocks of at most ``most``: (key, block, q_ids, q_dim, q_data, q_nulls)."""
    own = packed(rows, most).withColumn("block", F.monotonically_increasing_id())
    return own.select("key", "block", F.col("ids").alias("q_ids"), F.col("dim").alias("q_dim"), F.col("data").alias("q_data"), F.col("nulls").alias("q_nulls"))
