"""Buckets of signatures whose members lie in more than one component.

Similarity joins pair the members of a bucket with one pivot first. What that
leaves open is settled here, for any kind of signature:

* ``PIVOTS`` more rounds pair the members of a split bucket with another pivot,
  one of a component picked anew in each round; only members of other components
  are paired, and no pair twice. These are joins of narrow rows, and since the
  pick depends on components alone, buckets of one group agree on it.
* Members that still lie apart are compared by sketch inside tasks, those of
  similar size at a time, in blocks of bounded bytes. A task emits a spanning
  forest of the pairs that pass, at most one pair a member, and these are
  verified. All pairs that pass lie inside the trees, called clusters.
* In clusters with members that still lie apart, the sets are compared inside
  tasks, again in blocks of bounded bytes: every pair of different components is
  ruled out by a finer sketch, verified on the full sets, or in one component by
  links found before. A task emits the links that join components, fewer than it
  has members, so no pair is lost and none needs a row of its own.

Pairs of the first two steps are verified by the caller's exact comparison.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import discard, materialise, stored, trimmed

PIVOTS = 2
#: Members of a bucket that one comparison holds, and bytes of their sketches or
#: sets: two blocks of this size.
BLOCK, BLOCK_BYTES = 2048, 1 << 22
#: Cells of the sketches that are made of sets at hand, for one of others.
FINER = 8
#: Joined numbers a task remembers; what it forgets makes a pair more.
REMEMBERED = 1 << 18


class Bands:
    """Size bands for a similarity of ``percent`` in a hundred."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        if not 0 < percent < 100:
            raise ValueError("percent must lie between 0 and 100")
        self.percent = percent
        tops, top = [], 1
        while top < largest:
            tops.append(top)
            # two steps of the size ratio that similar sets can have
            top = max(top + 1, top * 100 // percent * 100 // percent)
        self.tops = np.array([*tops, top, top * 2], np.int64)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, size)

    def differences(self, total):
        """The most elements in which similar sets of ``total`` elements in
        all differ."""
        return total * (100 - self.percent) // (100 + self.percent)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) as they would be with fewer cells."""
    return np.bitwise_xor.reduce(sketch.reshape(len(sketch), -1, words), axis=1)


def close_pairs(rows: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of (a, b, sizes, sketches): the pairs that their sketches allow."""
    bands = Bands(percent)
    for r in rows:
        keep = []
        for na, nb, x, y in zip(*(r.column(i).to_pylist() for i in (2, 3, 4, 5))):
            room = int(bands.differences(na + nb))
            if abs(na - nb) <= room and len(x) != len(y):
                words = min(len(x), len(y)) // 8
                x, y = (folded(np.frombuffer(z, "<u8").reshape(1, -1), words).tobytes() for z in (x, y))
            keep.append(abs(na - nb) <= room and
                        (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count() <= room)
        r = r.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([r.column(0), r.column(1)], ["a", "b"])


class Trees:
    """Numbers joined by pairs, as trees of their least."""

    def __init__(self):
        self.top: dict[int, int] = {}

    def find(self, c: int) -> int:
        top, root = self.top, c
        while (up := top.get(root, root)) != root:
            root = up
        while c != root:
            top[c], c = root, top[c]
        return root

    def join(self, p: int, q: int) -> None:
        p, q = self.find(p), self.find(q)
        if p != q:
            self.top[max(p, q)] = min(p, q)


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets, without repeats, link."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _parities(sets: list[np.ndarray], cells: int) -> np.ndarray:
    """Sketches of sets of uniform hashes, in rows of 64-bit words."""
    out = np.empty((len(sets), cells // 8), np.uint8)
    for k, x in enumerate(sets):
        odd = np.bincount((x & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
        out[k] = np.packbits(odd.astype(bool), bitorder="little")
    return out.view(np.uint64)


def _compared(batches: Iterator[pa.RecordBatch], percent: int, forest: bool, exact: bool = False) -> Iterator[pa.RecordBatch]:
    """Pairs of different components in groups that their sketches allow, or,
    when ``exact``, that link.

    Columns: sig, step, i, j, block, low, cid, comp, n, and the sketch or, when
    ``exact``, the set; rows of a group (sig, step, i, j) lie together. A group
    holds two blocks at most. With ``forest``, pairs whose ends earlier pairs of
    the task join are left out; if exact, pairs whose components they join.
    """
    bands, trees = Bands(percent), Trees()

    def largest(n) -> int:
        return int(n) * 100 // percent  # the largest similar set

    def pairs(group: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(group).combine_chunks()
        t = t.take(np.argsort(t.column(8).to_numpy(), kind="stable"))
        i, j, block, low, cid, comp, n = (t.column(k).to_numpy() for k in range(2, 9))
        raw, node = t.column(9).to_pylist(), (comp if exact else cid).tolist()
        if len(trees.top) > REMEMBERED:
            trees.top.clear()
        root = np.array([trees.find(c) for c in node]) if forest else None
        sets = [np.frombuffer(x, "<u8") for x in raw] if exact else []
        level = np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)  # sizes of a level have sketches of one length
        cuts = (np.flatnonzero(level[1:] != level[:-1]) + 1).tolist()
        out_a, out_b = [], []
        for s, e in zip([0, *cuts], [*cuts, len(n)]):
            end = max(e, int(np.searchsorted(n, largest(n[e - 1]), side="right")))
            if exact:
                sketch = _parities(sets[s:end], FINER * max(64, 1 << int(level[s])))
            else:
                words = min(map(len, raw[s:end])) // 8
                sketch = np.concatenate([folded(np.frombuffer(x, "<u8").reshape(1, -1), words) for x in raw[s:end]])
            rows = max(1, (1 << 22) // sketch.nbytes)
            for lo in range(s, e, rows):
                hi = min(e, lo + rows)
                to = max(hi, int(np.searchsorted(n, largest(n[hi - 1]), side="right")))
                room = bands.differences(n[lo:hi, None] + n[None, lo:to])
                ok = (comp[lo:hi, None] != comp[None, lo:to]) & (np.abs(n[None, lo:to] - n[lo:hi, None]) <= room)
                ok &= np.arange(lo, hi)[:, None] < np.arange(lo, to)[None]
                ok &= low[lo:hi, None] | low[None, lo:to]
                if i[0] != j[0]:
                    ok &= block[lo:hi, None] != block[None, lo:to]
                if forest:
                    ok &= root[lo:hi, None] != root[None, lo:to]
                x, y = np.nonzero(ok)
                near = np.bitwise_count(sketch[lo - s + x] ^ sketch[lo - s + y]).sum(axis=1) <= room[x, y]
                found = 0
                for a, b in zip((lo + x[near]).tolist(), (lo + y[near]).tolist()):
                    if forest and trees.find(node[a]) == trees.find(node[b]) or exact and not alike(sets[a], sets[b], percent):
                        continue
                    found += 1
                    out_a.append(a)
                    out_b.append(b)
                    if forest:
                        trees.join(node[a], node[b])
                if forest and found:
                    root = np.array([trees.find(c) for c in node])
        a, b = cid[np.array(out_a, np.int64)], cid[np.array(out_b, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    group: list[pa.RecordBatch] = []
    now = None
    for r in batches:
        if not r.num_rows:
            continue
        r = pa.RecordBatch.from_arrays(r.columns, names=r.schema.names)  # the nullability flags differ
        keys = np.stack([r.column(k).to_numpy().astype(np.int64) for k in range(4)], axis=1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
            key = tuple(keys[lo].tolist())
            if key != now and group:
                yield pairs(group)
                group = []
            now = key
            group.append(r.slice(lo, hi - lo))
    if group:
        yield pairs(group)


def _pairs_within(shared: DataFrame, classes: DataFrame, labels: DataFrame, percent: int, forest: bool,
                  sets: Callable[[DataFrame], tuple[DataFrame, str]] | None) -> DataFrame:
    """A table of pairs (a, b) that ``_compared`` finds in the buckets (sig, cid)
    of ``shared``. All but the last shuffle are of narrow rows; sketches, or the
    ``sets`` of classes (cid), join the rows of cells that can hold a pair."""
    spark, exact = shared.sparkSession, sets is not None
    held = (lambda n: F.col(n) * 8) if exact else (lambda n: F.col(n) / 4 + 8)  # bytes of a set, of a sketch
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("m") * held("most") / BLOCK_BYTES)).cast("int")
    counts = [F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("n").alias("most")]
    member = (shared.select("sig", "cid").join(labels, "cid", "left").join(classes.select("cid", "n"), "cid")
              .select("sig", "cid", F.coalesce("comp", "cid").alias("comp"), "n"))
    split = member.groupBy("sig").agg(*counts).filter("m > 2 and lo != hi").select("sig", (blocks == 1).alias("single"))
    # sets that link differ in size by less than one step: a group holds two
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    inside, folder = stored(
        member.join(split, "sig").withColumn("low", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumn("step", F.when(F.col("low"), size).otherwise(size - 1))
        .select("sig", "step", "low", "cid", "comp", "n", "single"), "split_buckets")
    groups = (inside.groupBy("sig", "step").agg(*counts, F.max("low").alias("some"))
              .filter("some and m > 1 and lo != hi").select("sig", "step", blocks.alias("blocks")))
    together = inside.join(groups, ["sig", "step"])
    # a bucket of one block is one group, whatever the sizes, with each member once
    alone = (together.filter("single").select("sig", "cid", "comp", "n").distinct()
             .select("sig", F.lit(-2).alias("step"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"),
                     F.lit(True).alias("low"), "cid", "comp", "n"))
    parted = (together.filter("not single")
              .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("sig", "step", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "low", "cid", "comp", "n"))
    cells, narrow = stored(alone.unionByName(parted), "bucket_cells")
    folders = [folder, narrow]
    if exact:
        data, folder = sets(cells.select("cid").distinct())
        folders.append(folder)
    else:
        data = classes.select("cid", "sketch")
    found = materialise(cells.join(data, "cid")
                        .select("sig", "step", "i", "j", "block", "low", "cid", "comp", "n", data.columns[1])
                        .repartition("sig", "step", "i", "j").sortWithinPartitions("sig", "step", "i", "j")
                        .mapInArrow(trimmed(lambda r: _compared(r, percent, forest, exact)), "a long, b long")
                        .distinct(), "bucket_pairs")
    for f in folders:
        discard(spark, f)
    return found


def left_over(shared: DataFrame, classes: DataFrame, labels: DataFrame, percent: int, forest: bool) -> DataFrame:
    """A table of pairs (a, b) of one bucket, in different components, that
    their sketches allow; with ``forest``, as many as connect these classes."""
    return _pairs_within(shared, classes, labels, percent, forest, None)


def linked_within(close: DataFrame, classes: DataFrame, labels: DataFrame, percent: int,
                  sets: Callable[[DataFrame], tuple[DataFrame, str]]) -> DataFrame:
    """A table of links (a, b) that join the components of ``labels`` inside the
    clusters ``close`` (cid, comp)."""
    return _pairs_within(close.select(F.col("comp").alias("sig"), "cid"), classes, labels, percent, True, sets)


def other_pivots(shared: DataFrame, labels: DataFrame, tried: DataFrame, turn: int) -> DataFrame:
    """A table of pairs (a, b): members of split buckets with the least member
    of a component that the bucket holds, picked by ``turn``; none tried before."""
    member = shared.select("sig", "cid").join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    pick = F.struct(F.xxhash64("comp", F.lit(turn)).alias("h"), F.col("comp").alias("of"), F.col("cid").alias("pivot"))
    split = (member.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(pick).alias("p"))
             .filter("lo != hi").select("sig", "p.of", "p.pivot"))
    pairs = (member.join(split, "sig").filter("comp != of")
             .select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct())
    return materialise(pairs.join(tried, ["a", "b"], "left_anti"), "other_pivots")


def joined_buckets(shared: DataFrame, classes: DataFrame, labels: DataFrame, percent: int,
                   components: Callable[[DataFrame], DataFrame],
                   verified: Callable[[DataFrame], DataFrame],
                   sets: Callable[[DataFrame], tuple[DataFrame, str]]) -> DataFrame:
    """The labels (cid, comp) after all pairs of a bucket are settled.

    ``shared``: sig, cid, pivot; ``classes``: cid, n, sketch; ``labels``: by the
    links found so far; ``components`` labels the ends of links (a, b);
    ``verified`` keeps the linked ones of pairs (a, b); ``sets`` gives cid and
    elements of classes (cid) in a table of its own, and its folder.
    """
    tried = shared.filter("cid != pivot").select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct()

    def allowed(pairs: DataFrame) -> DataFrame:
        a = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
        b = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "x", "y")
        return materialise(both.mapInArrow(trimmed(lambda r: close_pairs(r, percent)), "a long, b long"), "allowed_pairs")

    for turn in range(PIVOTS):
        pairs = other_pivots(shared, labels, tried, turn)
        if pairs.isEmpty():
            break
        tried = tried.unionByName(pairs)
        labels = _more(labels, verified(allowed(pairs)), components)
    close = left_over(shared, classes, labels, percent, True)
    if close.isEmpty():
        return labels
    labels = _more(labels, verified(close), components)
    return _more(labels, linked_within(components(close), classes, labels, percent, sets), components)


def _more(labels: DataFrame, found: DataFrame, components: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``labels`` after the links ``found``: components of the graph whose nodes
    are the components so far, so earlier links are not gone through again."""
    if found.isEmpty():
        return labels
    a = labels.select(F.col("cid").alias("a"), F.col("comp").alias("p"))
    b = labels.select(F.col("cid").alias("b"), F.col("comp").alias("q"))
    between = (found.join(a, "a", "left").join(b, "b", "left")
               .select(F.coalesce("p", "a").alias("a"), F.coalesce("q", "b").alias("b")).filter("a != b").distinct())
    joined = components(materialise(between, "component_links")).select(F.col("cid").alias("comp"), F.col("comp").alias("top"))
    ends = found.select(F.col("a").alias("cid")).union(found.select("b")).distinct()
    known = labels.unionByName(ends.join(labels, "cid", "left_anti").select("cid", F.col("cid").alias("comp")))
    return materialise(known.join(joined, "comp", "left").select("cid", F.coalesce("top", "comp").alias("comp")), "labels")
