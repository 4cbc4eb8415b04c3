"""Weighted quantile sketches that merge (M7's split candidates).

A summary is a list of points (value, weight): the points' values ascend, and a
point stands for the rows above the point before it, up to its own value. It has
at most ``points`` points, cut at even weighted ranks, so a rank asked of it is
short of the true one by at most one cell, ``weight / points``, besides the weight
of equal values. Summaries merge by sorting their points together and cutting
again, which adds one such cell; ``FAN`` summaries of a level make one of the
next, so the error stays below (levels + 1) / points of the whole weight.

Each task sums up its own rows (Arrow batches, no shuffle) and ships at most
``points`` points per feature; these meet in ``GROUPS`` tasks per feature, and
the groups' summaries in one task, which is bounded by GROUPS x points.
Nulls and NaN have no place in an order of values and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 8
GROUPS = 64
Points = tuple[np.ndarray, np.ndarray]
SCHEMA = "feature int, part int, value double, weight double"


def cut(values: np.ndarray, weights: np.ndarray, points: int) -> Points:
    """At most ``points`` points for weighted values."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    last = np.flatnonzero(np.r_[values[1:] != values[:-1], True]) if len(values) else np.zeros(0, np.int64)
    reached = np.cumsum(weights)[last]
    values = values[last]
    if len(values) > points:
        wanted = reached[-1] * np.arange(1, points + 1) / points
        at = np.unique(np.minimum(np.searchsorted(reached, wanted * (1 - 1e-12), side="left"), len(values) - 1))
        values, reached = values[at], reached[at]
    return values, np.diff(reached, prepend=0.0)


class Sketch:
    """Summaries by level, merged ``FAN`` at a time."""

    def __init__(self, points: int):
        self.points = points
        self.levels: list[list[Points]] = []

    def add(self, summary: Points, level: int = 0) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(summary)
        if len(self.levels[level]) == FAN:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self.add(merged, level + 1)

    def update(self, values: np.ndarray, weights: np.ndarray) -> None:
        use = ~np.isnan(values) & (weights > 0)
        if use.any():
            self.add(cut(values[use], weights[use], self.points))

    def _merged(self, summaries: list[Points]) -> Points:
        return cut(*(np.concatenate(x) for x in zip(*summaries)), self.points)

    def result(self) -> Points:
        held = [s for level in self.levels for s in level]
        return self._merged(held) if held else (np.zeros(0), np.zeros(0))


def _rows(sketches: dict[int, Sketch], part: int):
    import pyarrow as pa
    found = [(f, *s.result()) for f, s in sorted(sketches.items())]
    sizes = [len(v) for _, v, _ in found]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([f for f, _, _ in found], sizes).astype(np.int32) if found else [], pa.int32()),
         pa.array([part] * sum(sizes), pa.int32()),
         pa.array(np.concatenate([v for _, v, _ in found]) if found else [], pa.float64()),
         pa.array(np.concatenate([w for _, _, w in found]) if found else [], pa.float64())],
        names=["feature", "part", "value", "weight"])


def weighted_sketch(df: DataFrame, features: Sequence[Column], weight: Column, points: int = 512) -> dict[int, Points]:
    """A summary for each feature, by its place in ``features``: at most
    ``points`` rows a feature reach the driver."""
    def local(batches: Iterator) -> Iterator:
        sketches: dict[int, Sketch] = {}
        for rb in batches:
            w = rb.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            for f in range(rb.num_columns - 1):
                v = rb.column(f + 1).to_numpy(zero_copy_only=False).astype(np.float64)
                sketches.setdefault(f, Sketch(points)).update(v, w)
        yield _rows(sketches, TaskContext.get().partitionId())

    def merge(batches: Iterator) -> Iterator:
        """Rows sorted by feature and part: the summaries of each feature."""
        sketches: dict[int, Sketch] = {}
        now, values, weights = None, [], []

        def close() -> None:
            if now is not None:
                sketches.setdefault(now[0], Sketch(points)).add((np.concatenate(values), np.concatenate(weights)))

        for rb in batches:
            f, p, v, w = (rb.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            if not len(f):
                continue
            start = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (p[1:] != p[:-1])]).tolist()
            for a, b in zip(start, [*start[1:], len(f)]):
                if now != (f[a], p[a]):
                    close()
                    now, values, weights = (f[a], p[a]), [], []
                values.append(v[a:b])
                weights.append(w[a:b])
        close()
        yield _rows(sketches, 0)

    narrow = df.select(F.coalesce(weight.cast("double"), F.lit(0.0)).alias("w"),
                       *[F.coalesce(c.cast("double"), F.lit(float("nan"))).alias(f"f{i}") for i, c in enumerate(features)])
    parts = narrow.mapInArrow(local, SCHEMA)
    grouped = (parts.withColumn("group", F.pmod("part", F.lit(GROUPS))).repartition("feature", "group")
               .sortWithinPartitions("feature", "part").select("feature", "part", "value", "weight").mapInArrow(merge, SCHEMA)
               .withColumn("part", F.spark_partition_id()))
    whole = (grouped.repartition("feature").sortWithinPartitions("feature", "part", "value").mapInArrow(merge, SCHEMA)
             .orderBy("feature", "value").collect())
    out: dict[int, Points] = {i: (np.zeros(0), np.zeros(0)) for i in range(len(features))}
    for f in out:
        own = [r for r in whole if r["feature"] == f]
        out[f] = np.array([r["value"] for r in own]), np.array([r["weight"] for r in own])
    return out


def rank(summary: Points, value: float) -> float:
    """Weight of the rows at or below ``value``, by the summary."""
    return float(summary[1][:int(np.searchsorted(summary[0], value, side="right"))].sum())


def thresholds(summary: Points, bins: int) -> list[float]:
    """At most ``bins`` - 1 ascending values at even weighted ranks."""
    values, weights = summary
    if not len(values):
        return []
    reached = np.cumsum(weights)
    wanted = reached[-1] * np.arange(1, bins) / bins
    at = np.minimum(np.searchsorted(reached, wanted * (1 - 1e-12), side="left"), len(values) - 1)
    return sorted(set(values[at].tolist()))
