"""Near duplicates by circulant MinHash against all pairs."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_mod
from emberwake.llm import buckets, minhash, partenum
from emberwake.llm.common import reachable
from emberwake.llm.minhash import band_count, band_keys, coordinates, near_duplicates
from emberwake.llm.partenum import mix, shingle_sets
from emberwake.session import shared_dir
from helpers import TEXTS, awkward, component_ids, empty, shingles, unique

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _workers(spark):
    reachable(spark)


def check(spark, texts, width=3, percent=85):
    docs, rows = unique(spark, texts)
    want = component_ids(rows, width, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs, width, percent).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def families(seed, groups, members, words, changed):
    """Texts of a group differ from its base in up to ``changed`` words."""
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(changed + 1)):
                text[rng.randrange(words)] = f"new{rng.randrange(10**6)}"
            out.append(" ".join(text))
    return out


def test_awkward_texts(spark):
    check(spark, TEXTS)
    docs, rows = awkward(spark)
    got = near_duplicates(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    by_text = {}
    for d, t in rows:
        by_text.setdefault(frozenset(shingles(t, 3)), []).append(d)
    same = [d for d in by_text[frozenset(shingles(TEXTS[-1], 3))] if d is not None]
    assert {r["component_id"] for r in got if r["doc_id"] in same} == {min(same)}
    assert near_duplicates(empty(spark)).count() == 0


def test_sets_go_once_their_pairs_are_verified(spark):
    """Tables of sets and of split buckets, the widest of the scratch folder, do not pile up round by round."""
    def held():
        root = f"{shared_dir(spark)}/emberwake"
        names = os.listdir(root) if os.path.isdir(root) else []
        return {n for n in names if n.startswith(("class_sets-", "split_buckets-"))}

    before = held()
    docs, _ = unique(spark, families(3, 1, 2, 40, 0) + families(4, 1, 2, 40, 1))
    sets = minhash.signed_sets(docs, 3, 2, 5)
    ids = [r["cid"] for r in sets.orderBy("doc_id").collect()]
    pairs = spark.createDataFrame([(min(p), max(p)) for p in [(ids[0], ids[-1])]], "a long, b long")
    reps = sets.select("cid", sets["doc_id"].alias("rep")).dropDuplicates(["cid"])
    assert minhash.verified(sets, pairs, 85, "links").count() == 0
    assert partenum._verified(docs, reps, pairs, 3, 85, "links").count() == 0
    classes = spark.createDataFrame([(c, 40, b"\0" * 8) for c in range(4)], "cid long, n long, sketch binary")
    shared = spark.createDataFrame([(9, c) for c in range(4)], "sig long, cid long")
    alone = spark.createDataFrame([], "cid long, comp long")
    pairs = buckets.left_over(shared, classes, alone, 85, None).collect()
    assert sorted(map(tuple, pairs)) == [(a, b) for a in range(4) for b in range(a + 1, 4)]
    assert held() == before


def test_only_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, None)], "doc_id long, text string")
    assert [(r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()] == [(None, True)] * 3


@pytest.mark.parametrize("seed", [1, 2])
def test_families_near_the_threshold(spark, seed):
    check(spark, families(seed, 6, 14, 70, 6))


def test_chains_need_more_than_a_star(spark):
    # each text links to its neighbours alone, whoever is the pivot
    words = [f"w{k}" for k in range(400)]
    check(spark, [" ".join(words[4 * k:4 * k + 80]) for k in range(60)])


def test_split_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", 3)
    monkeypatch.setattr(buckets, "PIVOTS", 0)
    check(spark, families(3, 2, 20, 60, 5), 1, 85)


def _least_reachable(links):
    top = {}

    def find(c):
        while top.get(c, c) != c:
            c = top[c]
        return c

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = top[a] = a
    return {c: find(c) for c in top}


def test_components_of_a_contracted_graph(spark):
    rng = np.random.default_rng(6)
    frame = lambda rows, names: spark.createDataFrame([tuple(map(int, r)) for r in rows], " long, ".join(names) + " long")
    for before, after in ((0, 5), (40, 0), (40, 40), (5, 120)):
        old, new = rng.integers(0, 100, (before, 2)), rng.integers(0, 100, (after, 2))
        old, new = old[old[:, 0] != old[:, 1]], new[new[:, 0] != new[:, 1]]
        labels = frame(_least_reachable(old.tolist()).items(), ["cid", "comp"])
        got = buckets._more(labels, frame(new, ["a", "b"]), partenum.components)
        assert sorted(map(tuple, got.collect())) == sorted(_least_reachable([*old.tolist(), *new.tolist()]).items())


def test_heavy_classes_and_classes_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SHARE", 4)
    monkeypatch.setattr(minhash, "FEW", 1)
    check(spark, ["same text in many rows of it"] * 30 + families(4, 3, 5, 60, 2))


def test_a_coordinate_is_the_least_of_the_shifted_permutation():
    texts = pa.array(["one two three four", "", "five six", "one two three four five six " * 3])
    values, ends = shingle_sets(texts, 1)
    got = coordinates(values, ends, 7)
    for k in range(7):
        x = mix(values ^ minhash.SIGMA) - np.uint64(k)
        x = (x ^ (x >> np.uint64(32))) * minhash.PI1
        x = (x ^ (x >> np.uint64(29))) * minhash.PI2
        start = 0
        for j, end in enumerate(ends.tolist()):
            assert got[k, j] == (x[start:end].min() if end > start else np.uint64(2**64 - 1))
            start = end


def test_long_sets_span_chunks():
    values = np.sort(mix(np.arange(100_000, dtype=np.uint64)))
    whole = coordinates(values, np.array([40, 100_000]), 5)
    apart = [coordinates(values[lo:hi], np.array([hi - lo]), 5)[:, 0] for lo, hi in ((0, 40), (40, 100_000))]
    assert (whole == np.stack(apart, axis=1)).all()


def test_coordinates_agree_as_often_as_sets_do():
    rng = np.random.default_rng(4)
    ratio = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 220).astype(np.uint64)
        a, b = np.sort(x[:200]), np.sort(x[20:])  # 180 of 220 in common
        grid = coordinates(np.concatenate([a, b]), np.array([200, 400]), 160)
        ratio.append((grid[:, 0] == grid[:, 1]).mean())
    assert abs(np.mean(ratio) - 180 / 220) < 0.015 and np.std(ratio) < 1.5 * (0.82 * 0.18 / 160) ** 0.5


def test_bands_meet_for_pairs_at_the_threshold():
    assert band_count(85, 5) == 32 and (1 - 0.85**5) ** 32 < 1e-8
    rng = np.random.default_rng(5)
    for _ in range(300):
        x = rng.integers(0, 2**63, 40).astype(np.uint64)
        a, b = np.sort(x[:37]), np.sort(x[3:])  # 34 of 40
        keys = band_keys(np.concatenate([a, b]), np.array([37, 74]), 32, 5)
        assert (keys[0] == keys[1]).any()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = component_ids(rows, 3, 85)
    got = entry_mod.queries()["op13_minhash"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == \
        {d: (n, c, c == d) for d, (n, c) in want.items()}
    assert len(got) == len(rows)
