"""Near-duplicate documents by circulant MinHash.

Two documents link when ``percent`` of the union of their shingle sets is common
to both. The shingles' 64-bit numbers pass through one permutation, sigma; the
k-th coordinate of a signature is the least value that a second permutation, pi,
circularly shifted by k places, gives them: min of pi(sigma(x) - k) over the set,
modulo 2**64. So two permutations serve for all coordinates. ``rows`` successive
coordinates make a band. Two sets of similarity s agree in a band with
probability s**rows; there are as many bands as leave a pair at the threshold
without a common band with a probability of at most ``MISS`` (85 in a hundred and
5 rows: 32 bands).

1. One pass over the texts writes a table: doc_id, set size, 64-bit digest of the
   set, and, once per equal sets of a slice, bands, a parity sketch and the set.
   Documents of equal digest form a class; from here on classes are joined.
2. Bands are aggregated to their least and largest class (combined before the
   shuffle). Where these differ, all other members are paired with the least.
3. A pair is dropped when its sketches differ in more bits than linked sets may
   differ in elements (no link is lost); the others are compared on full sets.
4. Links are united into components by minimum propagation.
5. Buckets whose members still lie in different components are taken up again
   (see ``buckets``): with other pivots, then inside tasks by sketch and by set.
6. Classes that hold more than one in ``SHARE`` of all documents (so at most
   ``SHARE`` of them) meet their documents by a broadcast, the others by a shuffle.

Cases: a text of fewer words than a shingle is one shingle; a null text or one
without words has no shingles, is linked with nothing, is its own component and
is kept; repeated rows are equal sets; a null doc_id ranks after all others, and
a component without any id has none and keeps all its rows; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwake.llm.buckets import close_pairs, joined_buckets
from emberwake.llm.common import bounded, discard, doc_text, materialise, stored, trimmed
from emberwake.llm.partenum import components, digests, linked_pairs, mix, shingle_sets, sketches

#: Odd multipliers and an offset of the two permutations.
SIGMA, PI1, PI2 = (np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
MISS = 1e-8
#: Elements hashed at a time: they stay in the processor's cache.
CHUNK = 1 << 15
#: More than one in so many rows make a class heavy.
SHARE = 10_000
#: Classes whose numbers are broadcast to find their sets; more are joined by a shuffle.
FEW = 500_000
LONG, BINARY = pa.int64(), pa.binary()


def band_count(percent: int, rows: int) -> int:
    """Bands that leave a pair at the threshold unseen with ``MISS`` at most."""
    return math.ceil(math.log(MISS) / math.log1p(-(percent / 100) ** rows))


def coordinates(values: np.ndarray, ends: np.ndarray, count: int) -> np.ndarray:
    """Circulant MinHash signatures, a column per set; all ones for empty sets."""
    out = np.full((count, len(ends)), np.uint64(2**64 - 1))
    placed = mix(values ^ SIGMA)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    shifted, high = np.empty(CHUNK, np.uint64), np.empty(CHUNK, np.uint64)
    for lo in range(0, len(placed), CHUNK):
        part, owner = placed[lo:lo + CHUNK], text[lo:lo + CHUNK]
        head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sets = owner[head]
        x, y = shifted[:len(part)], high[:len(part)]
        for k in range(count):
            np.subtract(part, np.uint64(k), out=x)
            np.right_shift(x, np.uint64(32), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, PI1, out=x)
            np.right_shift(x, np.uint64(29), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, PI2, out=x)
            # a set that goes on in the next chunk keeps the least of both
            out[k, sets] = np.minimum(out[k, sets], np.minimum.reduceat(x, head))
    return out


def band_keys(values: np.ndarray, ends: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Keys of the bands, a row per set."""
    grid = coordinates(values, ends, bands * rows).reshape(bands, rows, len(ends))
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64)[:, None] * SIGMA, (bands, len(ends)))
    for j in range(rows):
        key = mix(key ^ grid[:, j]) * PI1
    return np.ascontiguousarray(key.T)


def signed_sets(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """A table of doc_id, n_shingles, cid (null for no shingles) and, for the
    first of equal sets in a slice, keys, sketch and elements."""
    source = doc_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, 1):
            values, ends = shingle_sets(b.column(1), width)
            cid = digests(values, ends)
            firsts = {c: k for k, c in reversed(list(enumerate(cid))) if c is not None}
            own = np.array(sorted(firsts.values()), np.int64)
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            size = (ends - starts)[own]
            own_ends = np.cumsum(size)
            pick = np.repeat(starts[own] - (own_ends - size), size) + np.arange(int(size.sum()))
            held = values[pick]
            keys = band_keys(held, own_ends, bands, rows)
            data = held.astype("<u8").tobytes()
            place = np.full(len(cid), -1, np.int64)
            place[own] = np.arange(len(own))
            at = pa.array(place, mask=place < 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * bands),
                                             pa.array(keys.reshape(-1).view(np.int64)))
            elements = [data[8 * lo:8 * hi] for lo, hi in zip([0, *own_ends[:-1].tolist()], own_ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(ends, prepend=0)), pa.array(cid, LONG), lists.take(at),
                 pa.array(sketches(held, own_ends), BINARY).take(at), pa.array(elements, BINARY).take(at)],
                ["doc_id", "n_shingles", "cid", "keys", "sketch", "elements"])

    return materialise(source.mapInArrow(trimmed(run), f"doc_id {kind}, n_shingles long, cid long, keys array<long>, "
                                              "sketch binary, elements binary"), "signed_sets")


def class_sets(sets: DataFrame, wanted: DataFrame) -> tuple[DataFrame, str]:
    """cid, elements of the ``wanted`` classes (cid; a written table) and the
    folder that holds them."""
    if wanted.limit(FEW + 1).count() <= FEW:
        wanted = F.broadcast(wanted)
    return stored(sets.filter("elements is not null").select("cid", "elements").join(wanted, "cid", "left_semi")
                  .dropDuplicates(["cid"]), "class_sets")


def verified(sets: DataFrame, pairs: DataFrame, percent: int, name: str) -> DataFrame:
    """Those of ``pairs`` (a, b; a written table) that link."""
    held, folder = class_sets(sets, materialise(
        pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct(), "wanted_classes"))
    a = held.select(F.col("cid").alias("a"), F.col("elements").alias("x"))
    b = held.select(F.col("cid").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")
    linked = materialise(both.mapInArrow(trimmed(lambda r: linked_pairs(r, percent)), "a long, b long"), name)
    discard(sets.sparkSession, folder)
    return linked


def class_components(sets: DataFrame, percent: int) -> DataFrame:
    """cid, copies (documents of the class), component (least doc_id)."""
    classes = materialise(
        sets.filter("cid is not null").groupBy("cid").agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"),
            F.first("sketch", ignorenulls=True).alias("sketch")), "classes")
    keyed = sets.filter("keys is not null").select("cid", F.explode("keys").alias("sig"))
    heads = (keyed.groupBy("sig").agg(F.min("cid").alias("pivot"), F.max("cid").alias("last"))
             .filter("pivot != last").select("sig", "pivot"))
    shared = materialise(keyed.join(heads, "sig").dropDuplicates(["sig", "cid"]).select("sig", "cid", "pivot"), "shared_bands")
    a = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    b = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    starred = (shared.filter("cid != pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
               .join(a, "a").join(b, "b").select("a", "b", "na", "nb", "x", "y"))
    pairs = materialise(starred.mapInArrow(lambda r: close_pairs(r, percent), "a long, b long"), "pivot_pairs")
    links = verified(sets, pairs, percent, "links")
    labels = components(links)
    labels = joined_buckets(shared, classes, labels, percent, components,
                            lambda more: verified(sets, more, percent, "more_links"),
                            lambda members: class_sets(sets, materialise(members, "wanted_classes")))
    named = classes.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component"))
    return materialise(named.join(least, "comp").select("cid", "copies", "component"), "class_components")


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, rows: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sets = signed_sets(docs, width, band_count(percent, rows), rows)
    found = class_components(sets, percent)
    narrow = sets.select("doc_id", "n_shingles", "cid")
    total = found.agg(F.sum("copies")).first()[0] or 0
    heavy = F.broadcast(found.filter(F.col("copies") > total / SHARE).select("cid", "component"))  # SHARE rows at most
    light = found.filter(F.col("copies") <= total / SHARE).select("cid", "component")
    named = narrow.join(heavy, "cid").unionByName(
        narrow.filter("cid is not null").join(heavy.select("cid"), "cid", "left_anti").join(light, "cid"))
    named = named.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = narrow.filter("cid is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
