"""Vectors as exact integers, for operators that cluster or compress them.

A component x becomes floor(scale * x), x as a double. Differences of integers
are squared and summed in the narrowest type that holds every sum: 32 or 64
bits, or Python's integers for components too large for either.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Totals that are broadcast at most; more are joined by a shuffle.
SMALL = 100_000
SALTS = 32
LONGEST = (1 << 63) - 1


def valid(vector: Column, dims: int) -> Column:
    """Exactly ``dims`` components, none null, not a number, or infinite."""
    def fits(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= 1e305)
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, fits), F.lit(False))


def scaled(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), still as doubles (integers all)."""
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(-1, dims) * float(scale))


def integers(x: np.ndarray, largest: float, terms: int) -> np.ndarray:
    """``x`` in a type that holds the sum of ``terms`` squared differences of
    numbers up to ``largest`` in magnitude."""
    for bits, kind in ((31, np.int32), (63, np.int64)):
        if largest <= isqrt((1 << (bits - 2)) // terms) - 1:
            return x.astype(kind)
    return np.array([[int(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def magnitude(x: np.ndarray) -> float:
    return float(max(x.max(), -x.min())) if x.size else 0.0


def squared(d: np.ndarray) -> np.ndarray:
    """Sum of squares of each row."""
    return (d * d).sum(axis=1) if d.dtype == object else np.einsum("ij,ij->i", d, d, dtype=d.dtype)


def group_sums(x: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(groups, counts, sums of rows) of the groups that have rows."""
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    head = np.flatnonzero(np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]])) if len(order) else order
    wide = x[order] if x.dtype == object else x[order].astype(np.int64)
    sums = np.add.reduceat(wide, head, axis=0) if len(order) else wide
    return sorted_group[head], np.diff(head, append=len(order)), sums


def longs(values: np.ndarray) -> pa.Array:
    """A column of longs; null where a number is too large for one."""
    if values.dtype == object:
        return pa.array([v if v <= LONGEST else None for v in values.tolist()], pa.int64())
    return pa.array(values.astype(np.int64))


def with_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` and the sum of ``value`` over those of equal ``key``, nulls
    together. Totals are broadcast while there are few; beyond that each is
    dealt to some salts, so that a key with many rows is joined by many tasks."""
    totals = rows.groupBy(F.col(key).alias("_key")).agg(F.expr(f"try_sum({value})").alias(name))
    same = F.col(key).eqNullSafe(F.col("_key"))
    if totals.limit(SMALL + 1).count() <= SMALL:
        return rows.join(F.broadcast(totals), same).drop("_key")
    totals = totals.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", (F.rand(7) * SALTS).cast("int"))
    return salted.join(totals, same & (F.col("_salt") == F.col("_of"))).drop("_key", "_of", "_salt")
