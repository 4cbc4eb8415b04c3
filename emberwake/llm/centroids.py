"""Clusters of vectors around centroids, by Shallot search.

Components become integers (see ``vectors``); distances that decide are squared,
of integers, and exact. Bounds are doubles, moved outwards by a hair at every
step, so they never rule out a centroid that is as near as the nearest.

A vector remembers its nearest and second-nearest centroid, an upper bound of
the distance to the first and a lower bound of the distance to all others. In a
round the bounds move with the centroids. Only where they meet is the vector
looked at again: its distances to the two remembered centroids are worked out,
the search starts from the closer of them, and its other centroids are taken in
ascending distance from that one, as far as a ball reaches that shrinks with
every nearer centroid found. Ties go to the smaller number.

1. The first centroids are the vectors with the smallest hashes of their ids (as
   many rows as there are centroids reach the driver).
2. Each round is one task per split, without a shuffle of vectors: the table of
   vectors and bounds is read and the next one written to the shared folder. A
   task also writes one row per centroid: the count and sum of the vectors that
   came, less those that went. Spark adds these; centroids x components numbers
   reach the driver. The table before is removed when the next is complete.
   Rounds after one in which no centroid moved are left out: they change nothing.
3. Centroids and their distances are all that is broadcast; their size does not
   depend on the input.

Cases: vectors that are null, have another number of components than ``dims``,
or hold a null or non-finite component are not kept; fewer vectors than
centroids give fewer centroids; of rows with one id, or none (these come last),
the smaller vector comes first; repeated rows count each time; a centroid without
vectors stays where it is; sums that a long cannot hold are null; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import discard, stored
from emberwake.llm.vectors import group_sums, integers, longs, magnitude, scaled, squared, valid

#: Factors that move a bound outwards by more than any rounding.
UP, DOWN = 1 + 1e-12, 1 - 1e-12
STATE = ["v", "near", "other", "upper", "lower"]
CAME = ["cluster", "n", "sums"]


def packed(x: np.ndarray) -> pa.Array:
    """Rows of integer-valued doubles as bytes: of 32-bit integers where all of
    them fit, else of doubles."""
    kind = "<i4" if magnitude(x) < 1 << 30 else "<f8"
    data = np.ascontiguousarray(x.astype(kind))
    size = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of ``packed``, as doubles where some are."""
    rows = column.to_pylist()
    if all(len(r) == 4 * dims for r in rows):
        return np.frombuffer(b"".join(rows), "<i4").reshape(-1, dims)
    return np.stack([np.frombuffer(r, "<i4" if len(r) == 4 * dims else "<f8").astype(np.float64) for r in rows])


def root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


class Centroids:
    """Integer centroids, their neighbours by distance, and how far each moved
    since the round before."""

    def __init__(self, rows: list[list[int]], before: Centroids | None = None):
        self.rows = rows
        self.dims = len(rows[0])
        self.largest = float(max(abs(v) for r in rows for v in r))
        whole = self._array()
        far = np.array([root(squared(whole - row)) for row in whole])
        order = np.argsort(far, axis=1, kind="stable")
        # without the centroid itself, which an equal one may precede
        self.order = np.array([o[o != k] for k, o in enumerate(order)]).reshape(len(rows), -1)
        self.reach = np.take_along_axis(far, self.order, axis=1)
        self.half = self.reach[:, 0] / 2 * DOWN if len(rows) > 1 else np.full(1, np.inf)
        moved = np.zeros(len(rows)) if before is None else root(squared(whole - before._array(max(self.largest, before.largest))))
        self.moved = moved * UP
        #: the farthest that any centroid but this one moved
        most = int(self.moved.argmax())
        self.others = np.full(len(rows), self.moved[most])
        self.others[most] = np.delete(self.moved, most).max(initial=0.0)

    def _array(self, largest: float = 0.0) -> np.ndarray:
        wide = max(largest, self.largest) > isqrt((1 << 61) // self.dims) - 1
        return np.array(self.rows, dtype=object if wide else np.int64)

    def typed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and centroids in one integer type."""
        x = integers(x, max(magnitude(x), self.largest), self.dims)
        return x, np.array(self.rows, dtype=x.dtype)

    def sha256(self, k: int) -> str:
        return hashlib.sha256(",".join(map(str, self.rows[k])).encode()).hexdigest()


def shallot(x: np.ndarray, rows: np.ndarray, c: Centroids, near: np.ndarray, other: np.ndarray,
            upper: np.ndarray, lower: np.ndarray) -> int:
    """Moves the bounds, then finds the nearest and second centroid of the
    vectors ``x`` whose bounds meet; all four arrays change in place. Returns
    the number of distances worked out."""
    upper += c.moved[near]
    upper *= UP
    lower -= c.others[near]
    lower -= np.abs(lower) * (UP - 1)
    if len(rows) == 1:
        return 0
    bound = np.maximum(lower, c.half[near])
    ask = np.flatnonzero(~(upper < bound))
    own = squared(x[ask] - rows[near[ask]])
    worked = len(ask)
    upper[ask] = root(own) * UP
    open_ = ~(upper[ask] < bound[ask])
    ask, own = ask[open_], own[open_]
    if not len(ask):
        return worked
    a, b = near[ask], other[ask]
    second = squared(x[ask] - rows[b])
    worked += len(ask)
    swap = (second < own) | ((second == own) & (b < a))
    start, kept = np.where(swap, b, a), np.where(swap, a, b)
    d1, d2 = np.where(swap, second, own), np.where(swap, own, second)
    first, next_ = start.copy(), kept.copy()
    radius = root(d1) * UP
    live = np.arange(len(ask))
    for j in range(c.order.shape[1]):
        live = live[c.reach[start[live], j] * DOWN <= radius[live] + root(d2[live]) * UP]
        if not len(live):
            break
        candidate = c.order[start[live], j]
        new = candidate != kept[live]
        at, candidate = live[new], candidate[new]
        d = squared(x[ask[at]] - rows[candidate])
        worked += len(at)
        nearer = (d < d1[at]) | ((d == d1[at]) & (candidate < first[at]))
        closer = ~nearer & ((d < d2[at]) | ((d == d2[at]) & (candidate < next_[at])))
        w = at[nearer]
        d2[w], next_[w], d1[w], first[w] = d1[w], first[w], d[nearer], candidate[nearer]
        d2[at[closer]], next_[at[closer]] = d[closer], candidate[closer]
    near[ask], other[ask] = first, next_
    upper[ask], lower[ask] = root(d1) * UP, root(d2) * DOWN
    return worked


def _starts(vectors: DataFrame, centroids: int, seed: int, dims: int, scale: int) -> Centroids | None:
    of_id = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(of_id.asc_nulls_last(), "vector").limit(centroids).select("vector").collect()
    if not rows:
        return None
    x = scaled(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), dims, scale)
    return Centroids([[int(v) for v in row] for row in x.tolist()])


def _assigned(state: DataFrame, c: Centroids, dims: int, scale: int, last: bool) -> DataFrame:
    """vec_id, STATE and, in rows of their own at the end of a task, CAME. On
    the ``last`` pass vec_id, cluster and distance instead."""
    shared = state.sparkSession.sparkContext.broadcast(c)
    fresh = "vector" in state.columns
    kind = state.schema["vec_id"].dataType.simpleString()

    def found(b: pa.RecordBatch):
        x = scaled(b.column(1), dims, scale) if fresh else unpacked(b.column(1), dims)
        c = shared.value
        whole, rows = c.typed(x)
        n = len(x)
        if fresh:
            near, other = np.zeros(n, np.int32), np.full(n, min(1, len(rows) - 1), np.int32)
            upper, lower = np.full(n, np.inf), np.full(n, -np.inf)
            old = np.full(n, -1, np.int32)
        else:
            near, other, upper, lower = (b.column(k).to_numpy(zero_copy_only=False).copy() for k in range(2, 6))
            old = near.copy()
        shallot(whole, rows, c, near, other, upper, lower)
        return x, whole, rows, old, near, other, upper, lower

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change: dict[int, list] = {}
        names = ["vec_id", *STATE, *CAME]
        none = [pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0))]
        for b in batches:
            if not b.num_rows:
                continue
            x, whole, _, old, near, other, upper, lower = found(b)
            moved = np.flatnonzero(old != near)
            for sign, group in ((1, near), (-1, old)):
                rows = moved[group[moved] >= 0]
                for k, n, s in zip(*(v.tolist() for v in group_sums(whole[rows], group[rows]))):
                    held = change.setdefault(k, [0, [0] * dims])
                    held[0] += sign * n
                    held[1] = [p + sign * q for p, q in zip(held[1], s)]
            v = packed(x) if fresh else b.column(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), v, *(pa.array(z) for z in (near, other, upper, lower)),
                 *(pa.nulls(len(x), t) for t in none)], names)
        if change:
            k = sorted(change)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(k), t) for t in (id_type, pa.binary(), pa.int32(), pa.int32(), pa.float64(), pa.float64())]
                + [pa.array(z, t) for z, t in zip((k, [change[i][0] for i in k], [change[i][1] for i in k]), none)], names)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            _, whole, rows, _, near, *_ = found(b)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near), longs(squared(whole - rows[near]))],
                                             ["vec_id", "cluster", "distance"])

    if last:
        return state.mapInArrow(settle, f"vec_id {kind}, cluster int, distance long")
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(state.schema["vec_id"].dataType)
    return state.mapInArrow(move, f"vec_id {kind}, v binary, near int, other int, upper double, lower double, "
                                  "cluster int, n long, sums array<decimal(38,0)>")


def cluster_vectors(table: DataFrame, centroids: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024,
                    seed: int = 3, vector: str = "embedding") -> tuple[DataFrame, Centroids | None]:
    """A table of vec_id, cluster, distance (squared); and the centroids (none
    without vectors)."""
    spark = table.sparkSession
    state = table.filter(valid(F.col(vector), dims)).select("vec_id", F.col(vector).alias("vector"))
    kind = state.schema["vec_id"].dataType.simpleString()
    now = _starts(state, centroids, seed, dims, scale)
    if now is None:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), None
    count, sums = [0] * len(now.rows), [[0] * dims for _ in now.rows]
    folder = None
    for _ in range(rounds):
        made, path = stored(_assigned(state, now, dims, scale, last=False), "bounded_vectors")
        if folder:
            discard(spark, folder)
        folder = path
        state = made.filter("cluster is null").select("vec_id", *STATE)
        came = made.filter("cluster is not null").select(*CAME)
        change = (came.select("cluster", "n", F.posexplode("sums").alias("at", "sum")).groupBy("cluster", "at")
                  .agg(F.sum("n").alias("n"), F.sum("sum").cast("decimal(38,0)").alias("sum"))
                  .collect())  # centroids x components rows
        for r in change:
            sums[r["cluster"]][r["at"]] += int(r["sum"])
            if r["at"] == 0:
                count[r["cluster"]] += r["n"]
        before = now
        now = Centroids([[s // n for s in own] if n else row for n, own, row in zip(count, sums, before.rows)], before)
        if now.rows == before.rows:
            break
    out = stored(_assigned(state, now, dims, scale, last=True), "vector_clusters")[0]
    if folder:
        discard(spark, folder)
    return out, now


def vector_clusters(table: DataFrame, centroids: int = 8, rounds: int = 10, dims: int = 64) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256."""
    spark = table.sparkSession
    out, found = cluster_vectors(table, centroids, rounds, dims)
    per = {r["cluster"]: r["s"] for r in out.groupBy("cluster").agg(F.expr("try_sum(distance)").alias("s")).collect()}
    whole = sum(v for v in per.values() if v is not None)
    whole = None if whole >= 1 << 63 or None in per.values() else whole
    # one row per centroid
    facts = [(k, per[k], whole, found.sha256(k)) for k in sorted(per)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
