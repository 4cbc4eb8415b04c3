"""Second-order (Newton) boosted trees as table aggregations (M7, A5).

Each tree level is one Spark job:

1. the current margin is an expression over the rows (a stored margin plus the
   trees grown since the last checkpoint), giving per row ``g = p - y`` and
   ``h = p (1 - p)`` for the logistic loss;
2. each row is routed to its node of the tree in progress (an expression). Of two
   children only the smaller one is counted: the other's histogram is the
   parent's less that one, so at most half of the rows enter a level;
3. rows fan out to (node, feature, bin) and are summed with a partial
   aggregate, so the shuffle carries at most nodes x features x bins rows per
   task (the gradient histogram, A5);
4. only that histogram (nodes x features x bins rows, independent of the
   data size) reaches the driver, where running sums over bins give every
   candidate split's left/right sums and gain; the driver picks the split per
   node and builds the next expression.

Split candidates are per-feature thresholds: given ones, or those of a mergeable
quantile sketch weighted by the hessian, proposed once or anew every
``resketch`` rounds, as the weights change. A row goes left when
``x < threshold``. Nulls have a bin of their own; where a node holds any, both
sides are tried for them, and the better one is kept in the split. Gain, leaf
weight and the child-weight rule follow the published formulation (Chen &
Guestrin, KDD 2016): gain = 1/2 [G_L^2/(H_L+l) + G_R^2/(H_R+l) - G^2/(H+l)] -
gamma, w = -eta G/(H+l), both children need H >= min_child_weight. Ties go to
the lowest feature, then the lowest threshold, then nulls to the left.

Lineage stays short: the margin is re-expressed from the stored column, and
every ``checkpoint_every`` rounds the stored margin is rewritten with a
reliable ``checkpoint()`` into the shared folder.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwake.operators import sketch
from emberwake.session import shared_dir

TIE_TOLERANCE = 1e-9
NULL_BIN = -1


@dataclass(frozen=True)
class NewtonParams:
    eta: float = 0.1
    max_depth: int = 2
    rounds: int = 100
    lam: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    bins: int = 32
    base_score: float = 0.5
    checkpoint_every: int = 10
    resketch: int = 0       # rounds after which thresholds are proposed anew; 0: once


@dataclass
class NewtonModel:
    features: list[str]
    params: NewtonParams
    # one dict per tree: node id -> ("split", feature, threshold, nulls go left) | ("leaf", weight)
    trees: list[dict] = field(default_factory=list)
    # rows that entered each level's histogram, a list per tree
    counted: list[list[int]] = field(default_factory=list)

    @property
    def base_margin(self) -> float:
        b = self.params.base_score
        return math.log(b / (1 - b))

    # -- expressions -------------------------------------------------------
    def _goes_left(self, split: tuple, rows: Rows | None) -> Column:
        _, f, t, nulls_left = split
        if rows is not None:
            return rows.goes_left(f, t, nulls_left)
        x = F.col(self.features[f]).cast("double")
        return F.coalesce(x < F.lit(t), F.lit(nulls_left))

    def tree_expr(self, tree: dict, rows: Rows | None = None, node: int = 0) -> Column:
        kind = tree[node]
        if kind[0] == "leaf":
            return F.lit(float(kind[1]))
        return F.when(self._goes_left(kind, rows), self.tree_expr(tree, rows, 2 * node + 1)) \
            .otherwise(self.tree_expr(tree, rows, 2 * node + 2))

    def margin_expr(self, trees: list[dict] | None = None, rows: Rows | None = None,
                    start: Column | None = None) -> Column:
        m = start if start is not None else F.lit(self.base_margin)
        for t in (self.trees if trees is None else trees):
            m = m + self.tree_expr(t, rows)
        return m

    def transform(self, df: DataFrame) -> DataFrame:
        m = self.margin_expr()
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        return (df.withColumn("margin", m).withColumn("probability", p)
                .withColumn("prediction", (F.col("probability") > 0.5).cast("double")))

    def feature_score(self) -> dict[int, int]:
        counts: dict[int, int] = {}
        for t in self.trees:
            for kind in t.values():
                if kind[0] == "split":
                    counts[kind[1]] = counts.get(kind[1], 0) + 1
        return dict(sorted(counts.items()))

    def trees_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        for r, t in enumerate(self.trees):
            for node, kind in sorted(t.items()):
                if kind[0] == "split":
                    rows.append((r, node, kind[1], float(kind[2]), kind[3], None))
                else:
                    rows.append((r, node, None, None, None, float(kind[1])))
        return spark.createDataFrame(
            rows, "round int, node int, feature int, threshold double, nulls_left boolean, weight double")


class Rows:
    """The training rows: ``__y``, ``__m`` and either raw columns ``__x`` or,
    while thresholds do not change, bins."""

    def __init__(self, thresholds: list[list[float]], binned: bool):
        self.thresholds, self.binned = thresholds, binned

    def goes_left(self, f: int, t: float, nulls_left: bool) -> Column:
        if self.binned:
            b = F.col(f"__bin{f}")
            return F.when(b == NULL_BIN, F.lit(nulls_left)).otherwise(b <= bisect_left(self.thresholds[f], t))
        return F.coalesce(F.col(f"__x{f}") < F.lit(t), F.lit(nulls_left))

    def bins(self, df: DataFrame) -> DataFrame:
        """``df`` with the bins as columns."""
        if self.binned:
            return df
        return df.withColumns({f"__bin{i}": _bin_expr(F.col(f"__x{i}"), t) for i, t in enumerate(self.thresholds)})


def quantile_thresholds(df: DataFrame, features: list[Column], bins: int, weight: Column | None = None) -> list[list[float]]:
    """Candidate thresholds per feature at even weighted ranks (``bins`` - 1
    numbers per feature); the sketch has sixteen points a bin."""
    found = sketch.weighted_sketch(df, features, F.lit(1.0) if weight is None else weight, 16 * bins)
    return [sketch.thresholds(found[i], bins) for i in range(len(features))]


def _bin_expr(x: Column, thresholds: list[float]) -> Column:
    """Number of thresholds <= x (0 .. n) as a balanced binary search of
    ``CASE`` comparisons: log2(n) comparisons per value. Nulls go to a bin of
    their own."""
    def search(lo: int, hi: int) -> Column:      # the answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x >= F.lit(thresholds[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))
    return F.when(x.isNull(), F.lit(NULL_BIN)).otherwise(search(0, len(thresholds))).cast("int")


def binned_table(df: DataFrame, label: str, features: list[str],
                 thresholds: list[list[float]]) -> DataFrame:
    return df.select(F.col(label).cast("double").alias("__y"),
                     *[_bin_expr(F.col(f).cast("double"), thresholds[i]).alias(f"__bin{i}")
                       for i, f in enumerate(features)])


def gradient_histogram(binned: DataFrame, n_features: int, node: Column, g: Column,
                       h: Column) -> DataFrame:
    """Sum of g and h per (node, feature, bin) (A5). Rows fan out to one entry
    per feature and are combined map-side before the shuffle."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("feature"), F.col(f"__bin{i}").alias("bin"))
        for i in range(n_features)]))
    return (binned.select(node.alias("node"), g.alias("g"), h.alias("h"), entries.alias("e"))
            .filter(F.col("node").isNotNull())
            .groupBy("node", F.col("e.feature").alias("feature"), F.col("e.bin").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("sum_g"),
                 F.sum("h").alias("sum_h")))


Cells = dict[tuple[int, int], tuple[int, float, float]]   # (feature, bin) -> n, G, H


def cells_of(hist_rows) -> dict[int, Cells]:
    """The collected histogram by node (nodes x features x bins rows, bounded)."""
    out: dict[int, Cells] = {}
    for r in hist_rows:
        out.setdefault(r["node"], {})[r["feature"], r["bin"]] = (r["n"], float(r["sum_g"]), float(r["sum_h"]))
    return out


def less(parent: Cells, child: Cells) -> Cells:
    """The other child's histogram; counts are exact, so its empty cells go."""
    out = {}
    for k, (n, g, h) in parent.items():
        cn, cg, ch = child.get(k, (0, 0.0, 0.0))
        if n > cn:
            out[k] = (n - cn, g - cg, h - ch)
    return out


def choose_split(cells: Cells, thresholds: list[list[float]], p: NewtonParams) -> tuple:
    """("leaf", G, H), or ("split", feature, threshold, nulls go left, rows to
    the left, G_L, H_L, G_R, H_R) of the highest gain."""
    by_feature: dict[int, list] = {}
    for (f, b), c in cells.items():
        by_feature.setdefault(f, []).append((b, *c))
    entries = by_feature[min(by_feature)]
    G, H = sum(e[2] for e in entries), sum(e[3] for e in entries)
    parent = G * G / (H + p.lam)
    found = []
    for f, entries in sorted(by_feature.items()):
        entries.sort()
        total = sum(e[1] for e in entries)
        fg, fh = sum(e[2] for e in entries), sum(e[3] for e in entries)
        nulls = entries.pop(0)[1:] if entries[0][0] == NULL_BIN else None
        for nulls_left in ((True, False) if nulls else (True,)):
            n, gl, hl = nulls if nulls and nulls_left else (0, 0.0, 0.0)
            for at, (b, bn, g, h) in enumerate(entries):
                n, gl, hl = n + bn, gl + g, hl + h
                if n == total:      # the right side is empty
                    break
                # after the last bin only nulls are left for the right side
                t = math.inf if at == len(entries) - 1 else thresholds[f][b]
                gr, hr = fg - gl, fh - hl
                if hl < p.min_child_weight or hr < p.min_child_weight:
                    continue
                gain = 0.5 * (gl * gl / (hl + p.lam) + gr * gr / (hr + p.lam) - parent) - p.gamma
                if gain > 1e-6:
                    found.append((gain, f, t, nulls_left, n, gl, hl, gr, hr))
    if not found:
        return ("leaf", G, H)
    top = max(c[0] for c in found)
    tied = [c for c in found if c[0] >= top - TIE_TOLERANCE * max(1.0, abs(top))]
    best = min(tied, key=lambda c: (c[1], c[2], not c[3]))
    return ("split", *best[1:])


def newton_fit(df: DataFrame, label: str, features: list[str],
               params: NewtonParams = NewtonParams(),
               thresholds: list[list[float]] | None = None,
               partitions: int | None = None) -> NewtonModel:
    """Fit second-order boosted trees. Jobs: rounds x depth histogram passes,
    and a sketch for each proposal of thresholds. ``partitions`` deals the rows
    anew; without it they keep the partitions they come in."""
    spark = df.sparkSession
    shared_dir(spark)  # checkpoints go to the shared folder
    model, nf = NewtonModel(list(features), params), len(features)
    raw = df.select(F.col(label).cast("double").alias("__y"),
                    *[F.col(f).cast("double").alias(f"__x{i}") for i, f in enumerate(features)])
    raw = (raw.repartition(partitions) if partitions else raw).withColumn("__m", F.lit(model.base_margin))
    again = params.resketch > 0 and thresholds is None
    columns = [F.col(f"__x{i}") for i in range(nf)]
    raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    base = raw
    pending: list[dict] = []
    lam = params.lam
    try:
        if thresholds is None and not again:   # all weights are equal before the first round
            thresholds = quantile_thresholds(raw, columns, params.bins)
        if not again:
            rows = Rows([list(t) for t in thresholds], True)
            base = raw.select("__y", "__m", *[_bin_expr(c, rows.thresholds[i]).alias(f"__bin{i}")
                                              for i, c in enumerate(columns)]).persist(StorageLevel.MEMORY_AND_DISK)
        else:
            rows = Rows([[]] * nf, False)
        for rnd in range(params.rounds):
            margin = model.margin_expr(pending, rows, F.col("__m"))
            prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
            g = prob - F.col("__y")
            h = prob * (F.lit(1.0) - prob)
            if again and rnd % params.resketch == 0:
                rows = Rows(quantile_thresholds(base, columns, params.bins, h), False)
            tree, counted = _grown(model, rows, base, g, h)
            model.trees.append(tree)
            model.counted.append(counted)
            pending.append(tree)
            if params.checkpoint_every and len(pending) >= params.checkpoint_every \
                    and rnd + 1 < params.rounds:
                nb = base.withColumn("__m", model.margin_expr(pending, rows, F.col("__m"))).checkpoint(eager=True)
                base.unpersist()
                base = nb
                pending = []
    finally:
        base.unpersist()
        raw.unpersist()
    return model


def _grown(model: NewtonModel, rows: Rows, base: DataFrame, g: Column, h: Column) -> tuple[dict, list[int]]:
    """One tree, and the rows that entered the histogram of each level."""
    p, nf = model.params, len(model.features)
    tree: dict = {}
    counted: list[int] = []
    binned = rows.bins(base)

    def leaf(G: float, H: float) -> tuple:
        return ("leaf", -p.eta * G / (H + p.lam))

    sums = {0: (0.0, 0.0)}                     # (G, H) of the open nodes
    parents: dict[int, Cells] = {}
    ask, by_rest = {0}, {}                     # nodes to count; sibling -> (parent, the one counted)
    for depth in range(p.max_depth):
        if not sums:
            break
        node = _node_expr(model, rows, tree, ask)
        found = cells_of(gradient_histogram(binned, nf, node, g, h).collect())
        counted.append(sum(n for c in found.values() for (f, _), (n, _, _) in c.items() if f == 0))
        for rest, (parent, child) in by_rest.items():
            found[rest] = less(parents[parent], found.get(child, {}))
        later, ask, by_rest, parents = {}, set(), {}, {}
        for n, (G, H) in sums.items():
            if not found.get(n):               # no rows reached this node
                tree[n] = leaf(G, H)
                continue
            choice = choose_split(found[n], rows.thresholds, p)
            if choice[0] == "leaf":
                tree[n] = leaf(*choice[1:])
                continue
            _, f, t, nulls_left, n_left, gl, hl, gr, hr = choice
            tree[n] = ("split", f, t, nulls_left)
            left, right = 2 * n + 1, 2 * n + 2
            later[left], later[right] = (gl, hl), (gr, hr)
            total = sum(c[0] for (k, _), c in found[n].items() if k == f)
            small, rest = (left, right) if 2 * n_left <= total else (right, left)
            ask.add(small)
            parents[n] = found[n]
            by_rest[rest] = (n, small)
        sums = later
    for n, (G, H) in sums.items():
        tree[n] = leaf(G, H)
    return tree, counted


def _node_expr(model: NewtonModel, rows: Rows, tree: dict, ask: set[int], node: int = 0) -> Column:
    """Node id of a row in the partial tree, if it is asked for; else null."""
    if node in ask:
        return F.lit(node)
    kind = tree.get(node)
    if kind is None or kind[0] == "leaf":
        return F.lit(None).cast("int")
    return F.when(model._goes_left(kind, rows), _node_expr(model, rows, tree, ask, 2 * node + 1)) \
        .otherwise(_node_expr(model, rows, tree, ask, 2 * node + 2))
