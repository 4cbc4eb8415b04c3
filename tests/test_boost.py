"""Boosted trees (M1-M7, A5, R1-R4, S9, S10): toy golden values from FIXTURES.md."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector as features_of
from pyspark.sql import functions as F

from paths import SF_SMALL
from emberwake.operators import boost as B
from emberwake.operators import newton as N
from emberwake.operators import sketch as K
from emberwake.sources.points import TOY_POINTS, labelled_points, to_rows


def test_labelled_points(spark):
    df = labelled_points(spark)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 13
    assert [f.name for f in df.schema.fields] == ["label", "features"]
    assert sorted(r.label for r in df.collect()) == [0.0] * 6 + [1.0] * 7


def test_gbt_toy_predicts_labels_and_scores_splits(spark):
    df = labelled_points(spark)
    model = B.fit_boosted(df, B.BoostParams(rounds=20), workers=4, spill=True)
    pred = B.predict(model, df).select("label", "prediction").collect()
    assert all(r.label == r.prediction for r in pred)
    only_features = B.predict(model, df, features_only=True)
    assert only_features.count() == 13 and "label" not in only_features.columns
    score = {r.feature: r.splits for r in B.feature_score(spark, model).collect()}
    assert sum(score.values()) == sum(t.numNodes // 2 for t in model.trees)
    assert set(score) <= {0, 1, 2}


def test_gbt_rows_of_a_task_are_bounded(spark, monkeypatch):
    rows = spark.range(0, 6000, 1, 2).select((F.col("id") % 2).cast("double").alias("label"),
                                             features_of(F.array(F.col("id").cast("double"), F.rand(1))).alias("features"))
    assert B.even_parts(rows).rdd.getNumPartitions() == 2
    monkeypatch.setattr(B, "TASK_BYTES", 500 * (B.ROW_BYTES + 8))
    sizes = B.even_parts(rows).rdd.glom().map(len).collect()
    assert len(sizes) == 12 and sum(sizes) == 6000 and max(sizes) <= 550
    assert B.even_parts(rows.filter("id < 0")).count() == 0
    fitted = []
    monkeypatch.setattr(B.BoostParams, "estimator", lambda *_: type("E", (), {"fit": lambda _, d: fitted.append(d)})())
    B.fit_boosted(rows)
    assert fitted[0].rdd.getNumPartitions() == 12


def test_newton_toy_golden_values(spark):
    """100 rounds, eta 0.1, depth 2, lambda 1, min child weight 1."""
    rows = [(lbl, *v) for lbl, v in TOY_POINTS]
    df = spark.createDataFrame(rows, "label double, f0 double, f1 double, f2 double").repartition(4)
    model = N.newton_fit(df, "label", ["f0", "f1", "f2"], N.NewtonParams(rounds=100))
    assert model.feature_score() == {0: 17}
    probs = {(r.label, round(r.probability, 6))
             for r in model.transform(df).select("label", "probability").collect()}
    assert probs == {(1.0, 0.827726), (0.0, 0.200973)}
    trees = model.trees_frame(spark)
    assert trees.filter(F.col("feature").isNotNull()).count() == 17


def test_newton_checkpoint_does_not_change_the_fit(spark):
    rows = [(lbl, *v) for lbl, v in TOY_POINTS]
    df = spark.createDataFrame(rows, "label double, f0 double, f1 double, f2 double")
    a = N.newton_fit(df, "label", ["f0"], N.NewtonParams(rounds=6, checkpoint_every=2))
    b = N.newton_fit(df, "label", ["f0"], N.NewtonParams(rounds=6, checkpoint_every=0))
    assert a.trees == b.trees


def test_histogram_round_one(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet") \
        .withColumn("label", (F.col("l_returnflag") == "R").cast("double"))
    th = [[5.0 * i for i in range(1, 11)]]
    binned = N.binned_table(li, "label", ["l_quantity"], th)
    hist = N.gradient_histogram(binned, 1, F.lit(0), F.lit(0.5) - F.col("__y"), F.lit(0.25))
    got = {r.bin: (r.n, round(r.sum_g, 6)) for r in hist.collect()}
    want = {}
    for r in li.select("l_quantity", "label").collect():
        b = sum(1 for t in th[0] if r.l_quantity >= t)
        n, g = want.get(b, (0, 0.0))
        want[b] = (n + 1, g + 0.5 - r.label)
    assert {k: (v[0], round(v[1], 6)) for k, v in want.items()} == got


def test_to_rows_from_table(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    pts = to_rows(li, F.col("l_returnflag") == "R", ["l_quantity", "l_discount"])
    first = pts.first()
    assert first.features.size == 2 and first.label in (0.0, 1.0)
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    v = to_rows(emb, F.col("label") == 0, "embedding").first()
    assert v.features.size == 64


def test_unsupported_objective():
    with pytest.raises(ValueError):
        B.BoostParams(objective="reg:squarederror").estimator()


def _points(n, seed=1, nulls=0.3):
    """A label that null f0 decides, and f1 in part."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        f0 = None if rnd.random() < nulls else rnd.random()
        f1 = rnd.gauss(0, 1)
        y = 1.0 if (f0 is None) == (rnd.random() < 0.9) or f1 > 1.2 else 0.0
        rows.append((y, f0, f1))
    return rows


def _brute(rows, thresholds, p):
    """Best split of the first level over all features, thresholds and sides."""
    n = len(rows)
    found = []
    G, H = sum(0.5 - r[0] for r in rows), 0.25 * n
    for f, ts in enumerate(thresholds):
        for t in [*ts, math.inf]:
            for nulls_left in (True, False):
                left = [r for r in rows if (nulls_left if r[f + 1] is None else r[f + 1] < t)]
                if not 0 < len(left) < n:
                    continue
                gl, hl = sum(0.5 - r[0] for r in left), 0.25 * len(left)
                if hl < p.min_child_weight or H - hl < p.min_child_weight:
                    continue
                gain = 0.5 * (gl ** 2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G ** 2 / (H + 1))
                found.append((-round(gain, 9), f, t, not nulls_left, gl, hl))
    return min(found), (G, H)


@pytest.mark.parametrize("seed,nulls", [(1, 0.3), (2, 0.0), (3, 0.6)])
def test_nulls_go_to_the_better_side(spark, seed, nulls):
    rows, p = _points(400, seed, nulls), N.NewtonParams(rounds=1, max_depth=1)
    thresholds = [[0.2, 0.5, 0.8], [-1.0, 0.0, 1.2]]
    model = N.newton_fit(spark.createDataFrame(rows, "y double, f0 double, f1 double"), "y", ["f0", "f1"], p, thresholds)
    (_, f, t, right, gl, hl), (G, H) = _brute(rows, thresholds, p)
    _, got_f, got_t, nulls_left = model.trees[0][0]
    assert (got_f, got_t) == (f, t) and (nulls_left == (not right) or not nulls or f == 1)
    assert model.trees[0][1][1] == pytest.approx(-p.eta * gl / (hl + 1))
    assert model.trees[0][2][1] == pytest.approx(-p.eta * (G - gl) / (H - hl + 1))
    if nulls:
        assert f == 0


def test_only_the_smaller_child_is_counted(spark):
    rows = _points(600, 4)
    df = spark.createDataFrame(rows, "y double, f0 double, f1 double")
    p = N.NewtonParams(rounds=3, max_depth=4, min_child_weight=0.1)
    th = [[k / 16 for k in range(1, 16)], [k / 4 for k in range(-8, 9)]]
    model = N.newton_fit(df, "y", ["f0", "f1"], p, th)
    for counted in model.counted:
        assert counted[0] == 600 and all(c <= 300 for c in counted[1:])
    # leaves equal those of the rows that reach them
    margin = {i: 0.0 for i in range(600)}
    for tree in model.trees:
        g = [1 / (1 + math.exp(-margin[i])) - rows[i][0] for i in range(600)]
        place = dict.fromkeys(range(600), 0)
        for node in sorted(n for n, k in tree.items() if k[0] == "split"):
            _, f, t, nulls_left = tree[node]
            for i in place:
                if place[i] == node:
                    x = rows[i][f + 1]
                    place[i] = 2 * node + (1 if (nulls_left if x is None else x < t) else 2)
        h = [(g[i] + rows[i][0]) * (1 - g[i] - rows[i][0]) for i in range(600)]
        for node, kind in tree.items():
            if kind[0] == "leaf":
                own = [i for i in place if place[i] == node]
                want = -p.eta * sum(g[i] for i in own) / (sum(h[i] for i in own) + 1)
                assert kind[1] == pytest.approx(want, abs=1e-9)
        for i in place:
            margin[i] += tree[place[i]][1]


def test_thresholds_are_proposed_anew(spark):
    df = spark.createDataFrame(_points(800, 5), "y double, f0 double, f1 double").repartition(3)
    p = N.NewtonParams(rounds=4, max_depth=2, bins=8, resketch=1)
    model = N.newton_fit(df, "y", ["f0", "f1"], p)
    loss = model.transform(df).select(F.avg(-F.log(F.when(F.col("y") == 1, F.col("probability"))
                                                   .otherwise(1 - F.col("probability"))))).first()[0]
    assert len(model.trees) == 4 and loss < math.log(2) - 0.05
    once = N.newton_fit(df, "y", ["f0", "f1"], N.NewtonParams(rounds=1, max_depth=2, bins=8))
    assert once.trees[0] == model.trees[0]     # weights are equal before the first round


@pytest.mark.parametrize("parts", [1, 3, 90])
def test_sketch_ranks_are_within_the_bound(spark, parts):
    rng = np.random.default_rng(parts)
    values, weights = np.round(rng.lognormal(0, 2, 20_000), 2), rng.random(20_000) ** 3
    rows = [(float(v) if rng.random() < 0.9 else None, float(w)) for v, w in zip(values, weights)]
    df = spark.createDataFrame(rows, "v double, w double").repartition(parts)
    points = 128
    found = K.weighted_sketch(df, [F.col("v"), F.lit(None)], F.col("w"), points)
    assert len(found[0][0]) <= points and len(found[1][0]) == 0
    have = sorted((v, w) for v, w in rows if v is not None)
    v, w = np.array([h[0] for h in have]), np.cumsum([h[1] for h in have])
    assert found[0][1].sum() == pytest.approx(w[-1])
    for q in (0.01, 0.1, 0.5, 0.9, 0.99):
        at = float(np.quantile(v, q))
        true = w[np.searchsorted(v, at, side="right") - 1]
        assert abs(K.rank(found[0], at) - true) <= 6 / points * w[-1]


def test_sketch_of_few_values_is_exact():
    values, weights = K.cut(np.array([3.0, 1.0, 3.0, 2.0]), np.array([1.0, 2.0, 3.0, 4.0]), 8)
    assert values.tolist() == [1, 2, 3] and weights.tolist() == [2, 4, 4]
    assert K.thresholds((values, weights), 4) == [2.0, 3.0]
