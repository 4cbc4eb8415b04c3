"""Centroid clustering and vector codes against brute force in Python integers."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from emberwake.llm.centroids import Centroids, cluster_vectors, shallot, vector_clusters
from emberwake.llm.common import reachable
from emberwake.llm.vector_codes import compressed_vectors, nearest, transform, vector_codes
from emberwake.llm.vectors import with_total

SMALL = "/root/testdata/sf0.001"
SCHEMA = ("vec_id long, embedding array<double>, label int, vector string, v string, near int, cluster string, n int, "
          "part int, error string, code string")
NAN, INF = float("nan"), float("inf")


@pytest.fixture(autouse=True)
def _workers(spark):
    reachable(spark)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", "y", 1, "z", 2, 3, "e", "c") for i, v, k in rows], SCHEMA)


def awkward_vectors(count=60, dims=8, top=3, seed=5):
    """Few distinct values, so that distances tie; then rows that are dropped."""
    rng = np.random.default_rng(seed)
    rows = [(k, [float(x) / 512 for x in rng.integers(-top, top + 1, dims)], k % 3 or None) for k in range(count)]
    rows += [rows[-1], (7, [0.5] * dims, 1), (None, [0.25] * dims, 2), (None, [0.125] * dims, None)]
    rows += [(100, None, 1), (101, [], 1), (102, [1.0] * (dims - 1), 1), (103, [1.0] * (dims + 1), 1),
             (104, [None] + [1.0] * (dims - 1), 1), (105, [NAN] + [1.0] * (dims - 1), 1), (106, [-INF] + [1.0] * (dims - 1), 1)]
    return rows


def kept(rows, dims):
    return [(i, [math.floor(1024 * x) for x in v], k) for i, v, k in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def square(a, b):
    return sum((p - q) ** 2 for p, q in zip(a, b))


def closest(v, centres):
    return min((square(v, c), k) for k, c in enumerate(centres))


def averaged(rows, choice, centres):
    out = []
    for k, c in enumerate(centres):
        own = [v for v, (_, at) in zip(rows, choice) if at == k]
        out.append([sum(x) // len(own) for x in zip(*own)] if own else c)
    return out


def brute_clusters(rows, dims, centroids, rounds):
    rows = kept(rows, dims)
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v, _ in order[:centroids]]
    vectors = [v for _, v, _ in rows]
    for _ in range(rounds):
        centres = averaged(vectors, [closest(v, centres) for v in vectors], centres)
    choice = [closest(v, centres) for v in vectors]
    own = Counter()
    for d, k in choice:
        own[k] += d
    return [(i, k, d, own[k], sum(own.values()), hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest())
            for (i, _, _), (d, k) in zip(rows, choice)]


def brute_codes(rows, dims, parts, entries, rounds):
    rows = kept(rows, dims)
    size = dims // parts
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[k * size:(k + 1) * size] for _, v, _ in rows] for k in range(parts)]
    books = [[v[k * size:(k + 1) * size] for _, v, _ in order[:entries]] for k in range(parts)]
    for _ in range(rounds):
        books = [averaged(p, [closest(v, b) for v in p], b) for p, b in zip(cut, books)]
    choice = [[closest(v, b) for v in p] for p, b in zip(cut, books)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = [sum(c[j][0] for c in choice) for j in range(len(rows))]
    by_label = Counter()
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e
    return [(i, "".join(f"{c[j][1]:02x}" for c in choice), error[j], by_label[k], sha) for j, (i, _, k) in enumerate(rows)]


@pytest.mark.parametrize("centroids, rounds", [(1, 2), (2, 0), (5, 3), (8, 10), (200, 4)])
def test_clusters_of_awkward_vectors(spark, centroids, rounds):
    rows = awkward_vectors()
    got = vector_clusters(frame(spark, rows).repartition(3), centroids, rounds, 8)
    assert Counter(map(tuple, got.collect())) == Counter(brute_clusters(rows, 8, centroids, rounds))


def test_clusters_of_large_components(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(10.0 ** rng.integers(0, 9)), float(rng.integers(-9, 9)) * 1e7, 1.0], 1) for k in range(40)]
    got = vector_clusters(frame(spark, rows), 4, 3, 3)
    want = brute_clusters(rows, 3, 4, 3)
    assert any(d >= 1 << 63 for _, _, d, _, _, _ in want)

    def long(x):
        return x if x < 1 << 63 else None

    assert Counter((r["vec_id"], r["cluster"], r["distance"], r["centroid_sha256"]) for r in got.collect()) == \
        Counter((i, k, long(d), sha) for i, k, d, _, _, sha in want)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 5), st.integers(0, 2**32 - 1), st.integers(1, 4))
def test_shallot_finds_nearest_and_second_as_centroids_move(k, dims, seed, top):
    rng = np.random.default_rng(seed)
    x = rng.integers(-top, top + 1, (30, dims)).astype(np.int64)
    near, other = np.zeros(30, np.int32), np.full(30, min(1, k - 1), np.int32)
    upper, lower = np.full(30, np.inf), np.full(30, -np.inf)
    c = None
    for _ in range(5):
        c = Centroids(rng.integers(-top, top + 1, (k, dims)).tolist() if c is None else
                      [[v + int(m) for v, m in zip(r, rng.integers(-1, 2, dims))] for r in c.rows], c)
        shallot(x, np.array(c.rows), c, near, other, upper, lower)
        d = ((x[:, None] - np.array(c.rows)[None]) ** 2).sum(axis=2)
        assert near.tolist() == d.argmin(axis=1).tolist()
        own = np.sqrt(d[np.arange(30), near])
        assert (own <= upper).all()
        if k > 1:
            d[np.arange(30), near] = 10 ** 9
            assert (lower <= np.sqrt(d.min(axis=1))).all()


def test_shallot_skips_most_distances():
    rng = np.random.default_rng(2)
    x = (rng.integers(-900, 900, (20, 8))[rng.integers(0, 20, 2000)] + rng.integers(-9, 9, (2000, 8))).astype(np.int64)
    near, other = np.zeros(2000, np.int32), np.ones(2000, np.int32)
    upper, lower = np.full(2000, np.inf), np.full(2000, -np.inf)
    c, worked = Centroids(x[:20].tolist()), []
    for _ in range(4):
        worked.append(shallot(x, np.array(c.rows), c, near, other, upper, lower))
        c = Centroids(averaged(x.tolist(), [(0, k) for k in near.tolist()], c.rows), c)
    assert sum(worked) < 0.5 * len(worked) * 2000 * 20


def test_clusters_survive_partitioning_and_leave_one_table(spark, tmp_path):
    rows = awkward_vectors(200)
    a = vector_clusters(frame(spark, rows).coalesce(1), 6, 5, 8).collect()
    b = vector_clusters(frame(spark, rows).repartition(9), 6, 5, 8).collect()
    assert Counter(a) == Counter(b)


@pytest.mark.parametrize("parts, entries, rounds", [(4, 5, 3), (2, 256, 4), (1, 1, 2), (8, 7, 0)])
def test_codes_of_awkward_vectors(spark, parts, entries, rounds):
    rows = awkward_vectors()
    codes, books = vector_codes(frame(spark, rows).repartition(3), 8, parts, entries, rounds)
    got = with_total(codes, "label", "error", "label_error").select("vec_id", "code", "error", "label_error",
                                                                   F.lit(books.sha256()).alias("sha"))
    assert Counter(map(tuple, got.collect())) == Counter(brute_codes(rows, 8, parts, entries, rounds))


def test_codes_of_parts_that_are_padded(spark):
    rows = awkward_vectors(dims=12)
    codes, _ = vector_codes(frame(spark, rows), 12, 4, 9, 2)
    assert Counter((r["vec_id"], r["code"], r["error"]) for r in codes.collect()) == \
        Counter((i, c, e) for i, c, e, _, _ in brute_codes(rows, 12, 4, 9, 2))


def test_codes_of_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(v) * 10.0 ** int(rng.integers(0, 10)) for v in rng.integers(-9, 9, 4)], 1) for k in range(40)]
    codes, books = vector_codes(frame(spark, rows), 4, 2, 6, 3)
    want = brute_codes(rows, 4, 2, 6, 3)
    assert books.sha256() == want[0][4] and any(e >= 1 << 63 for _, _, e, _, _ in want)
    assert Counter((r["vec_id"], r["code"], r["error"]) for r in codes.collect()) == \
        Counter((i, c, e if e < 1 << 63 else None) for i, c, e, _, _ in want)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 17), st.integers(1, 20), st.integers(0, 2**32 - 1), st.sampled_from([1, 40, 700]))
def test_nearest_entry_is_exact(size, entries, seed, top):
    rng = np.random.default_rng(seed)
    x, e = (rng.integers(-top, top + 1, (n, size)).astype(np.int64) for n in (25, entries))
    width = transform(x).shape[1]
    code, distance = nearest(transform(x), transform(e))
    d = ((x[:, None] - e[None]) ** 2).sum(axis=2)
    assert code.tolist() == d.argmin(axis=1).tolist() and (distance == width * d.min(axis=1)).all()


def test_a_table_without_labels(spark):
    got = compressed_vectors(frame(spark, awkward_vectors(dims=64)).drop("label"), 64)
    assert len({r["label_error"] for r in got.collect()}) == 1


def test_many_labels_are_joined_by_a_shuffle(spark, monkeypatch):
    from emberwake.llm import vectors
    monkeypatch.setattr(vectors, "SMALL", 2)
    rows = spark.createDataFrame([(k, k % 5 or None, k) for k in range(100)], "id long, label long, error long")
    got = {r["id"]: r["t"] for r in with_total(rows, "label", "error", "t").collect()}
    assert got == {k: sum(j for j in range(100) if j % 5 == k % 5) for k in range(100)}


def test_empty_tables(spark):
    none = frame(spark, [])
    for query in (vector_clusters, compressed_vectors):
        assert query(none).count() == 0 and query(frame(spark, [(1, None, 1), (2, [1.0], 1)])).count() == 0
    assert cluster_vectors(none)[1] is None


@pytest.mark.parametrize("name", ["op11_centroids", "op12_vector_codes"])
def test_vector_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    got = entry_mod.queries()[name](spark, SMALL)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({entry_mod.oracle_sql()[name]})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)
