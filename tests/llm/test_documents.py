"""Sharding, exact duplicates, decontamination and the similarity join against
brute force, on awkward rows and on the small tables."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberwake.llm.common import reachable
from emberwake.llm.decontaminate import contamination, drop_contaminated
from emberwake.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from emberwake.llm.partenum import drop_similar, similar_documents
from emberwake.llm.sharding import balanced_shards
from helpers import SHARED, awkward, benchmark_hits, component_ids, empty, lower, sha, unique

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _workers(spark):
    reachable(spark)


def key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0)


def test_shards_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = balanced_shards(docs, 4).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 4
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert balanced_shards(empty(spark), 4).count() == 0


def test_shards_are_even_and_cut_few_links(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = balanced_shards(docs, 8).join(docs.select("doc_id", "text"), "doc_id").collect()
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert len(got) == docs.count()
    share, largest = sum(load.values()) / 8, max(r["size"] for r in got)
    assert all(abs(v - share) <= max(share * 0.02, largest) for v in load.values())
    groups = defaultdict(set)
    for r in got:
        groups[r["text"]].add(r["shard"])
    copies = Counter(r["text"] for r in got)
    several = [t for t, n in copies.items() if n > 1]
    assert sum(len(groups[t]) > 1 for t in several) <= 0.2 * len(several)


def test_a_hot_group_fills_one_shard_then_the_next(spark):
    texts = ["h" * 100] * 3000 + [f"{k:05d}" * 20 for k in range(6007)]  # rooms end above 0 bytes
    docs, _ = unique(spark, texts)
    got = balanced_shards(docs, 8).collect()
    load, copies = Counter(), Counter()
    for r in got:
        load[r["shard"]] += r["size"]
        copies[r["shard"]] += r["doc_id"] < 3000
    share = sum(load.values()) / 8
    assert len(got) == len(texts) and all(abs(v - share) <= 101 for v in load.values())
    assert len([s for s, n in copies.items() if n]) == math.ceil(3000 * 101 / share)


@pytest.mark.parametrize("texts", [
    [f"{k:03d}" * (20 + k) for k in range(150)] * 2,                                   # every text has a copy
    [f"long {k}" * 3000 for k in range(9)] * 3 + [f"{k:04d}" * 9 for k in range(900)] * 2,  # a few very long ones
])
def test_shards_of_linked_documents_are_even(spark, texts):
    docs, _ = unique(spark, texts)
    got = balanced_shards(docs, 4).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    share, largest = sum(load.values()) / 4, max(r["size"] for r in got)
    assert all(abs(load[k] - share) <= largest for k in range(4))


def test_exact_duplicates(spark):
    docs, rows = unique(spark)
    groups = defaultdict(list)
    for d, t in rows:
        groups[lower(t)].append(d)
    got = {r["doc_id"]: r for r in exact_duplicates(docs).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        g, r = groups[lower(t)], got[d]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(g), len(g), d == max(g))
        assert r["text_sha256"] == sha(lower(t))
    assert sorted(r["doc_id"] for r in drop_exact_duplicates(docs).collect()) == sorted(max(g) for g in groups.values())


def test_exact_duplicates_of_repeated_and_null_ids(spark):
    docs, rows = awkward(spark)
    got = exact_duplicates(docs).collect()
    assert len(got) == len(rows)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert kept == Counter({sha(lower(t)): 1 for _, t in rows})
    out = drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert Counter(lower(r["text"]) for r in out.collect()) == Counter({lower(t): 1 for _, t in rows})
    assert exact_duplicates(empty(spark)).count() == 0 and drop_exact_duplicates(empty(spark)).count() == 0


ITEMS = [(1, SHARED), (2, "a b"), (3, None), (4, ""), (5, "34 56"), (5, "34 56"), (6, "not in any text at all"),
         (None, "12 34")]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_contamination(spark):
    docs, rows = awkward(spark)
    got = sorted(contamination(docs, items(spark)).collect(), key=key)
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(want)
    for r, (d, t) in zip(got, want):
        n_words, n_hit, found = benchmark_hits(t, ITEMS)
        assert (r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) == (d, n_words, n_hit, len(found))
        assert r["items_sha256"] == sha(",".join(found)) and r["contaminated"] == (n_hit > 0)
    left = drop_contaminated(docs, items(spark))
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(d for d, t in rows if not benchmark_hits(t, ITEMS)[1])


def test_rows_without_an_id_are_judged_one_by_one(spark):
    rows = [(None, SHARED), (None, "clean"), (None, "clean"), (7, SHARED), (7, "clean too"), (8, "x " + SHARED), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = drop_contaminated(docs, items(spark))
    assert Counter(map(tuple, left.collect())) == Counter([(None, "clean"), (None, "clean"), (7, "clean too"), (9, None)])


def test_contamination_of_empty_tables(spark):
    docs, rows = unique(spark)
    assert contamination(empty(spark), items(spark)).count() == 0
    assert contamination(docs, items(spark).limit(0)).filter("contaminated").count() == 0


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_similar_documents(spark, width, percent):
    base = [f"word{k}" for k in range(60)]
    texts = [None, "", "solo", "Solo", "two words", SHARED, SHARED.upper(), "the the the the the the"]
    texts += [" ".join(base), " ".join(base[:-1]), " ".join(base[:-2]), " ".join(base[:-9]),
              " ".join(base[:30] + ["new"] + base[30:]), " ".join(base[:58] + ["end", "other"]), " ".join(base) * 3]
    docs, rows = unique(spark, texts)
    want = component_ids(rows, width, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_documents(docs, width, percent).collect()}
    assert got == want
    left = drop_similar(docs, width, percent)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({c for _, c in want.values()})


def test_similar_documents_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = similar_documents(docs, 3, 90).collect()
    assert len(got) == len(rows)
    assert similar_documents(empty(spark), 3, 90).count() == 0
    assert drop_similar(empty(spark)).count() == 0


def test_one_row_stays_of_rows_without_an_id_or_with_a_shared_one(spark):
    base = [f"word{k}" for k in range(60)]
    near = [" ".join(base[:60 - k]) for k in range(3)]
    other, third, fourth = ([f"{c}{k}" for k in range(60)] for c in "xyz")
    rows = [(None, near[0]), (None, near[1]), (None, near[2]), (None, None), (None, None),       # ids: none
            (7, " ".join(other)), (7, " ".join(other[:-1])), (9, " ".join(other[:-2])),          # a shared id is the least
            (7, " ".join(third)), (3, " ".join(third[:-1])), (None, " ".join(third[:-2])),       # a single id is the least
            (7, " ".join(fourth)), (7, " ".join(fourth)), (None, " ".join(fourth[:-1]))]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, extra string")
    left = drop_similar(docs, 5, 80)
    assert left.columns == docs.columns
    kept = Counter((r["doc_id"], (r["text"] or " ").split(" ")[0]) for r in left.collect())
    assert kept == Counter({(None, "word0"): 1, (None, ""): 2, (7, "x0"): 1, (3, "y0"): 1, (7, "z0"): 1})


def test_similar_documents_of_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = similar_documents(docs.withColumn("extra", F.lit(1)), 5, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == component_ids(rows, 5, 80)


def test_signed_sets_are_remembered_or_signed_again():
    from emberwake.llm.partenum import Signed
    seen = Signed(4)
    assert seen.first(np.array([0, 1, 1, 2, 0])).tolist() == [True, True, False, True, False]
    assert not seen.first(np.array([0, 1, 2])).any() and seen.first(np.array([5])).all() and seen.first(np.array([1])).all()
    seen = Signed(1 << 10)
    rng = np.random.default_rng(1)
    numbers = rng.integers(-2**62, 2**62, 200)
    assert seen.first(np.concatenate([numbers, numbers])).sum() == 200
    again = seen.first(numbers)
    assert 0 < again.sum() < 100  # those whose place another set took
