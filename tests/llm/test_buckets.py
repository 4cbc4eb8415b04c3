"""Members of a bucket that lie apart: rows and sets that settle them."""

import random

import numpy as np
import pyarrow as pa
import pytest

from emberwake.llm import buckets, partenum
from emberwake.llm.common import reachable
from helpers import component_ids, unique


@pytest.fixture(autouse=True)
def _workers(spark):
    reachable(spark)


def just_apart(members, words=400, changed=26):
    """Texts of similarity 0.78 or less: their sketches allow most pairs, none links."""
    rng, out = random.Random(7), []
    for m in range(members):
        text = [f"w{k}" for k in range(words)]
        for k in rng.sample(range(words), changed):
            text[k] = f"new{m}x{k}"
        out.append(" ".join(text))
    return out


def test_pairs_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    docs, rows = unique(spark, just_apart(120))
    asked, verified = [], partenum._verified
    monkeypatch.setattr(partenum, "_verified", lambda docs, classes, pairs, *more: (
        asked.append(pairs.count()), verified(docs, classes, pairs, *more))[1])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in partenum.similar_documents(docs, 1, 80).collect()}
    assert got == component_ids(rows, 1, 80)
    # the pivots' rounds come first; the last one takes a tree of each task at most
    assert asked[-1] <= 119 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_links_that_only_the_sets_in_a_cluster_show(spark, monkeypatch):
    # without other pivots most links are left to the clusters; small blocks part them
    monkeypatch.setattr(buckets, "PIVOTS", 0)
    monkeypatch.setattr(buckets, "BLOCK", 5)
    texts = just_apart(40)
    for k in range(0, 40, 2):  # a chain through every second text
        other, halfway = texts[(k + 2) % 40].split(" "), texts[k].split(" ")
        for at in [i for i, (p, q) in enumerate(zip(halfway, other)) if p[0] == "w" and q[0] == "n"][:12]:
            halfway[at] = other[at]
        texts.append(" ".join(halfway))
    docs, rows = unique(spark, texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in partenum.similar_documents(docs, 1, 80).collect()}
    want = component_ids(rows, 1, 80)
    assert got == want and 1 < len({c for _, c in want.values()}) < 40


def test_rows_of_buckets_are_narrow_and_go(spark, monkeypatch):
    wide, folders, stored, discard = [], set(), buckets.stored, buckets.discard

    def keep(df, name):
        wide.extend(set(df.columns) & {"sketch", "elements"})
        out = stored(df, name)
        folders.add(out[1])
        return out

    monkeypatch.setattr(buckets, "stored", keep)
    monkeypatch.setattr(buckets, "discard", lambda spark, path: (discard(spark, path), folders.discard(path)))
    docs, _ = unique(spark, just_apart(12))
    partenum.similar_documents(docs, 1, 80).collect()
    assert not wide and not folders


def _group(rng, members):
    """Rows of one group: sets around a base of 60 elements and some larger."""
    base = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = []
    for m in range(members):
        size = 60 if m % 3 else 90
        fresh = int(rng.integers(0, 10))
        sets.append(np.sort(np.unique(np.concatenate([base[fresh:size], rng.integers(0, 2**63, fresh).astype(np.uint64)]))))
    return sets


@pytest.mark.parametrize("remembered", [1 << 18, 0])
def test_a_task_emits_links_that_join_what_pairs_would(monkeypatch, remembered):
    monkeypatch.setattr(buckets, "REMEMBERED", remembered)
    rng, batches, sets = np.random.default_rng(3), [], []
    for sig in range(3):
        held = _group(rng, 30)
        cid = np.arange(len(sets), len(sets) + 30)
        sets += held
        same = [np.full(30, sig), np.full(30, -2), np.zeros(30, int), np.zeros(30, int), np.zeros(30, int), np.ones(30, bool)]
        batches.append(pa.RecordBatch.from_arrays(
            [*map(pa.array, same), pa.array(cid), pa.array(cid // 2 * 2), pa.array([len(x) for x in held]),
             pa.array([x.tobytes() for x in held], pa.binary())],
            ["sig", "step", "i", "j", "block", "low", "cid", "comp", "n", "elements"]))

    def joined(links):
        trees = buckets.Trees()
        for a, b in [*links, *((c, c // 2 * 2) for c in range(90))]:
            trees.join(a, b)
        return [trees.find(c) for c in range(90)]

    found = [(a, b) for r in buckets._compared(iter(batches), 80, True, True) for a, b in zip(*(c.to_pylist() for c in r.columns))]
    want = [(a, b) for a in range(90) for b in range(a + 1, 90)
            if a // 30 == b // 30 and a // 2 != b // 2 and buckets.alike(sets[a], sets[b], 80)]
    assert set(found) <= set(want) and joined(found) == joined(want)
    assert len(found) < 45 < len(want)
