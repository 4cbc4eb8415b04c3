"""Similarity join of documents on word shingles with PartEnum signatures.

Two documents link when ``percent`` of the union of their shingle sets is
common to both: 100 * |A & B| >= percent * |A | B|. Equivalently their symmetric
difference H is at most (|A| + |B|) * (100 - percent) / (100 + percent).

Signatures. Set sizes fall into bands; a band bounds H by some k. The shingle
domain is parted, by hash, into n1 = k // 2 + 1 + t parts of three subparts, so
at least t + 1 parts hold one difference or none, and there two of the three
subparts agree in full: a signature is the hash of a set's shingles in two
subparts of one part. A set with at most t parts that have an empty pair of
subparts leaves those signatures out; of two similar sets one of which does so,
a common signature still remains. Sets near the upper end of a band also sign
for the next one.

1. Texts are read where they lie; a narrow table keeps doc_id, set size, a
   64-bit digest of the set and a parity sketch. Documents of equal digest form
   a class; from here on classes are joined.
2. Signatures are shuffled and sorted; those of one class alone are dropped. In
   every other bucket all members are paired with one pivot, its first. The
   pivot is the least by a fixed order, so buckets of one group tend to agree on
   it: m members make m - 1 pairs.
3. A pair is dropped when its sketches differ in more bits than the sets may
   (each differing bit needs a difference, so no link is lost); the others are
   verified on the sets, read from the texts of just these classes.
4. Verified links are united into components by minimum propagation with
   shortcuts over tables in the shared folder.
5. Buckets whose members still lie in different components are taken up again
   (see ``buckets``): with other pivots, then inside tasks by sketch and by set.
   So every pair with a common signature is linked, in one component, ruled out
   by its sketch, or verified.

Cases: a text of fewer words than a shingle is one shingle; a null text or one
without words has no shingles, is linked with nothing and is its own component;
repeated rows are equal sets; a null doc_id ranks after all others; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwake.llm.buckets import Bands, alike, close_pairs, joined_buckets
from emberwake.llm.common import bounded, discard, doc_text, materialise, stored, trimmed
from emberwake.llm.words import FILTER_BITS, hash_filter, hashed, in_filter, words_of

#: Words of a lower-cased text; odd multipliers of the hashes.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BASE, MIX, MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))
SUBPARTS, SLACK = 3, 0.1
#: Sets that a task remembers to have signed, in one place each.
SIGNED = 1 << 16
LONG, BINARY = pa.int64(), pa.binary()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX2
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends): the distinct shingle hashes of each text, ascending, one
    text after another; text i holds values[ends[i - 1]:ends[i]]."""
    words = words_of(texts, WORDS)
    sizes = np.array([len(w) for w in words], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    h = hashed(words, int(first[-1]))
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(words)), counts)
    at = first[text] + np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    short = sizes[text] < width
    value = np.zeros(len(at), np.uint64)
    for j in range(width):
        inside = ~short | (j < sizes[text])
        value = np.where(inside, value * BASE + h[np.minimum(at + j, max(0, len(h) - 1))], value)
    value = mix(value + np.where(short, sizes[text], width).astype(np.uint64))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return value[new], np.cumsum(np.bincount(text[new], minlength=len(words)))


def signatures(values: np.ndarray, ends: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, text) of all texts; equal sets need none of their own, so
    bands without room for a difference give none."""
    starts = np.concatenate([[0], ends[:-1]])
    size = ends - starts
    own = bands.of(size)
    partner = size * 100 // bands.percent  # the largest similar set
    out_sig, out_text = [], []
    spread = mix(values)
    content = mix(values * MIX2)
    for step in (0, 1):
        k = bands.differences(2 * bands.tops[own + step])
        texts = np.flatnonzero((size > 0) & (k > 0) & ((step == 0) | (partner > bands.tops[own])))
        if not len(texts):
            continue
        need = k[texts] // 2 + 1
        spare = (need * SLACK).astype(np.int64)
        n1 = need + spare
        parts = n1 * SUBPARTS
        reps = size[texts]
        pick = np.repeat(starts[texts] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
        part = np.repeat(np.cumsum(parts) - parts, reps) + (
            (spread[pick] >> np.uint64(32)) * np.repeat(parts, reps).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        sums = np.zeros(int(parts.sum()), np.uint64)
        head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums[part[head]] = np.add.reduceat(content[pick][order], head)
        filled = np.zeros(len(sums), bool)
        filled[part[head]] = True
        sums, filled = mix(sums).reshape(-1, SUBPARTS), filled.reshape(-1, SUBPARTS)
        which_text = np.repeat(np.arange(len(texts)), n1)
        # parts with an empty pair of subparts: at most one subpart is filled
        light = np.bincount(which_text, weights=filled.sum(axis=1) < 2, minlength=len(texts))
        leaves_out = (light <= spare)[which_text]
        number = (np.arange(len(which_text)) - np.repeat(np.cumsum(n1) - n1, n1)).astype(np.uint64)
        place = mix(number * np.uint64(8) + (own[texts] + step)[which_text].astype(np.uint64) * BASE)
        for which, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
            signs = filled[:, a] | filled[:, b] | ~leaves_out
            out_sig.append(mix(sums[signs, a] * BASE + sums[signs, b] + place[signs] + np.uint64(which)))
            out_text.append(texts[which_text[signs]])
    if not out_sig:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_text)


def digests(values: np.ndarray, ends: np.ndarray) -> list[int | None]:
    """A signed 64-bit digest of each set; of an empty one, None."""
    data, out, start = values.astype("<u8").tobytes(), [], 0
    for end in ends.tolist():
        part = data[8 * start:8 * end]
        out.append(int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True) if part else None)
        start = end
    return out


def sketches(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Parities of the elements' counts in cells; as many cells as the next
    power of two of the set size, 64 at least."""
    cells, out, start = mix(values + BASE), [], 0
    for end in ends.tolist():
        m = max(64, 1 << (end - start - 1).bit_length()) if end > start else 64
        odd = np.bincount((cells[start:end] & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
        out.append(np.packbits(odd.astype(bool), bitorder="little").tobytes())
        start = end
    return out


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, cid (digest; null for no shingles), sketch."""
    source = doc_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(rows, 1):
            values, ends = shingle_sets(b.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(ends, prepend=0)), pa.array(digests(values, ends), LONG),
                 pa.array(sketches(values, ends), BINARY)], ["doc_id", "n_shingles", "cid", "sketch"])

    return materialise(source.mapInArrow(trimmed(run), f"doc_id {kind}, n_shingles long, cid long, sketch binary"), "shingle_sets")


class Signed:
    """Remembers sets, each in the one place its digest gives it; a later set of
    the same place takes it. What it forgets is signed again, no more."""

    def __init__(self, places: int = SIGNED):
        self.held = np.zeros(places, np.int64)
        self.used = np.zeros(places, bool)

    def first(self, numbers: np.ndarray) -> np.ndarray:
        """Which of the digests are not remembered, equal ones once."""
        new = np.zeros(len(numbers), bool)
        values, at = np.unique(numbers, return_index=True)
        place = values & (len(self.held) - 1)
        fresh = ~(self.used[place] & (self.held[place] == values))
        self.held[place], self.used[place] = values, True
        new[at[fresh]] = True
        return new


def _signed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """sig, cid: the signatures of every set, equal sets about once per task."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), Signed()
        for b in bounded(rows, 0):
            values, ends = shingle_sets(b.column(0), width)
            numbers = np.array([c or 0 for c in digests(values, ends)], np.int64)
            sig, text = signatures(values, ends, bands)
            keep = seen.first(numbers)[text]
            yield pa.RecordBatch.from_arrays([_long(sig[keep]), pa.array(numbers[text[keep]])], ["sig", "cid"])

    return docs.select("text").mapInArrow(trimmed(run), "sig long, cid long")


def _shared(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, cid): those whose signature several classes
    have, with the first of them as pivot."""
    held = None  # the last row: sig, cid, pivot, whether it is its signature's first
    for b in rows:
        if not b.num_rows:
            continue
        s, c = b.column(0).to_numpy(), b.column(1).to_numpy()
        if held:
            s, c = np.concatenate([[held[0]], s]), np.concatenate([[held[1]], c])
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
        s, c = s[new], c[new]
        first = np.ones(len(s), bool)
        first[1:] = s[1:] != s[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
        pivot = c[start]
        if held:
            pivot[start == 0] = held[2]
            first[0] = held[3]
        several = ~first
        several[:-1] |= s[1:] == s[:-1]
        held = int(s[-1]), int(c[-1]), int(pivot[-1]), bool(first[-1])
        several[-1] = False  # told with the next batch
        yield pa.RecordBatch.from_arrays([pa.array(x[several]) for x in (s, c, pivot)], ["sig", "cid", "pivot"])
    if held and not held[3]:
        yield pa.RecordBatch.from_arrays([pa.array([x], LONG) for x in held[:3]], ["sig", "cid", "pivot"])


def linked_pairs(rows: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of (a, b, sets): the pairs that link."""
    for r in rows:
        keep = [alike(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent)
                for x, y in zip(r.column(2).to_pylist(), r.column(3).to_pylist())]
        r = r.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([r.column(0), r.column(1)], ["a", "b"])


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> tuple[DataFrame, str]:
    """cid, elements of the ``wanted`` classes (cid, rep), from their texts; and
    the folder that holds them."""
    spark = docs.sparkSession
    ids = spark.sparkContext.broadcast(hash_filter(wanted.select(F.xxhash64("rep").alias("h")), "h", FILTER_BITS))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(rows, 0):
            b = b.filter(pa.array(in_filter(ids.value, b.column(1).to_numpy())))
            values, ends = shingle_sets(b.column(0), width)
            data = values.astype("<u8").tobytes()
            elements = [data[8 * lo:8 * hi] for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(digests(values, ends), LONG), pa.array(elements, BINARY)],
                                             ["cid", "elements"])

    found = docs.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(trimmed(run), "cid long, elements binary")
    return stored(found.join(wanted.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "class_sets")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The linked ones of ``pairs`` (a, b)."""
    members = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    sets, folder = _sets_of(docs, classes.select("cid", "rep").join(members, "cid", "left_semi"), width)
    a = sets.select(F.col("cid").alias("a"), F.col("elements").alias("x"))
    b = sets.select(F.col("cid").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")
    linked = materialise(both.mapInArrow(trimmed(lambda rows: linked_pairs(rows, percent)), "a long, b long"), name)
    discard(docs.sparkSession, folder)
    return linked


def components(links: DataFrame) -> DataFrame:
    """cid, comp of every class with a link (a, b): the least cid it can reach.

    Every round each class takes the least label among its own, its
    neighbours', and its label's label; rounds end when no label changes.
    """
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("cid")).agg(
        F.least(F.col("a"), F.min("b")).alias("comp")), "labels") if not edges.isEmpty() else \
        edges.select(F.col("a").alias("cid"), F.col("b").alias("comp"))
    while True:
        near = (edges.join(labels.select(F.col("cid").alias("b"), F.col("comp").alias("other")), "b")
                .groupBy(F.col("a").alias("cid")).agg(F.min("other").alias("other")))
        up = labels.select(F.col("cid").alias("comp"), F.col("comp").alias("above"))
        moved = materialise(
            labels.join(near, "cid").join(up, "comp", "left")
            .select("cid", F.least("comp", "other", "above").alias("new"), "comp"), "labels")
        changed = not moved.filter("new != comp").isEmpty()
        labels = moved.select("cid", F.col("new").alias("comp"))
        if not changed:
            return labels


def _compared(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets of all documents, and of each digest: cid, component (least
    doc_id), comp (label of the component, never null)."""
    found = document_sets(docs, width)
    classes = materialise(found.filter("cid is not null").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
    shared = materialise(_signed(docs, width, percent).repartition("sig").sortWithinPartitions("sig", "cid")
                         .mapInArrow(trimmed(_shared), "sig long, cid long, pivot long"), "shared_signatures")
    a = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    b = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    with_pivot = (shared.filter("cid != pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
                  .join(a, "a").join(b, "b").select("a", "b", "na", "nb", "x", "y"))
    pairs = materialise(with_pivot.mapInArrow(lambda rows: close_pairs(rows, percent), "a long, b long"), "pivot_pairs")
    links = _verified(docs, classes, pairs, width, percent, "links")
    labels = components(links)
    labels = joined_buckets(shared, classes, labels, percent, components, lambda more: _verified(
        docs, classes, more, width, percent, "more_links"), lambda members: _sets_of(
        docs, classes.select("cid", "rep").join(members, "cid", "left_semi"), width))

    named = classes.select("cid", "rep").join(labels, "cid")
    least = named.groupBy("comp").agg(F.min("rep").alias("least"))
    component = named.join(least, "comp").select("cid", "least", "comp")
    component = classes.select("cid", "rep").join(component, "cid", "left").select(
        "cid", F.coalesce("least", "rep").alias("component"), F.coalesce("comp", "cid").alias("comp"))
    return found, component


def _named(found: DataFrame, component: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "cid").join(component, "cid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def similar_documents(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return _named(*_compared(docs, width, percent))


def drop_similar(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: its least doc_id, of rows
    that share it or have none the first by row number; all columns. A row
    without shingles is its own component and stays."""
    found, component = _compared(docs, width, percent)
    repeated = materialise(found.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                           .filter("n > 1").select(F.col("doc_id").alias("_repeated")), "repeated_ids")
    stays = materialise(_named(found, component), "similar").select(
        F.col("component_id").alias("_stays")).filter("_stays is not null").distinct()
    unclear = docs.join(repeated, F.col("doc_id") == F.col("_repeated"), "left_semi").unionByName(docs.filter("doc_id is null"))
    if repeated.isEmpty() and found.filter("doc_id is null").isEmpty():
        return docs.join(stays, F.col("doc_id") == F.col("_stays"), "left_semi")

    # an id on several rows, or none, does not tell which row stays: these rows are kept with a number
    unclear = materialise(unclear.withColumn("_row", F.monotonically_increasing_id()), "unclear_rows")
    sets = document_sets(unclear.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("doc_id"), "text"),
                         width).join(component, "cid", "left").select("doc_id", "cid", "component", "comp")
    # a component whose least id is on one row keeps that row
    first = (sets.filter("cid is not null").join(repeated, F.col("component") == F.col("_repeated"), "left")
             .filter("component is null or _repeated is not null").groupBy("comp").agg(F.min("doc_id").alias("doc_id")))
    chosen = first.select(F.col("doc_id._row").alias("_row")).union(sets.filter("cid is null").select("doc_id._row"))
    clear = stays.join(repeated, F.col("_stays") == F.col("_repeated"), "left_anti")
    return docs.join(clear, F.col("doc_id") == F.col("_stays"), "left_semi").unionByName(
        unclear.join(chosen, "_row", "left_semi").drop("_row"))
