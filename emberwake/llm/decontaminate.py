"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of an item (the whole item when it is
shorter). With k-grams of ``gram`` words, the smallest hash among each
``window - gram + 1`` neighbouring k-grams is a fingerprint, so two texts that
share a whole window share a fingerprint inside it. Items shorter than a window
are fingerprinted the same way for their own length.

1. Documents are fingerprinted where they are read. A fingerprint that a
   Bloom filter of fixed size does not rule out is kept with the words around
   it; everything else about the document is its id and word count.
2. These are joined to the items' fingerprints, and each hit is extended word
   by word to both sides: exact, whatever the hashes did.
3. Per document, the extended spans are united and the items listed.

Only the filter, ``filter_bits`` long, is sent to every task. A passage that
many documents share is one join key with many rows on one side; adaptive
execution broadcasts the items when measured small, or splits the key.

Cases: a null text has no words; an item without words has no window; a null
item_id marks words but is not listed; items of equal item_id count once;
documents of equal id give a row each; empty tables give empty or clean
results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import bounded, doc_text, materialise, trimmed
from emberwake.llm.words import FILTER_BITS, hash_filter, hashed, in_filter, words_of

#: The words of a lower-cased text; odd multipliers of the hashes.
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
WINDOW, GRAM = 10, 5
PRINT = "struct<print:long,length:int,at:int,left:int,words:array<string>>"


def gram_length(length: int, gram: int) -> int:
    return min(gram, length)


def fingerprints(hashes: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values chosen from concatenated texts of ``sizes`` words.

    A position is chosen if its k-gram hash is the least of some window of
    k-grams that spans ``length`` words of one text.
    """
    k = gram_length(length, gram)
    near, n = length - k + 1, len(hashes)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = hashes[:n - k + 1].copy()
    for j in range(1, k):
        grams = grams * BASE + hashes[j:n - k + 1 + j]
    grams ^= grams >> np.uint64(31)
    grams = grams * MIX | np.uint64(1)
    ends = np.repeat(np.cumsum(sizes), sizes)
    whole = np.arange(n - length + 1) + length <= ends[:n - length + 1]  # windows inside one text
    least = grams[:n - length + 1].copy()
    for j in range(1, near):
        np.minimum(least, grams[j:n - length + 1 + j], out=least)
    least[~whole] = 0
    best = np.zeros(len(grams), np.uint64)
    for j in range(near):
        np.maximum(best[j:j + len(least)], least, out=best[j:j + len(least)])
    at = np.flatnonzero(best == grams)
    return at, grams[at]


def _contexts(words: list[list[str]], lengths: list[int], gram: int, passes) -> list[list[dict]]:
    """For each text its fingerprints that ``passes``, with the words that any
    window around them can hold."""
    sizes = np.array([len(w) for w in words], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    hashes = hashed(words, int(first[-1]))
    out: list[list[dict]] = [[] for _ in words]
    for length in lengths:
        k = gram_length(length, gram)
        at, value = fingerprints(hashes, sizes, length, gram)
        ok = passes(value)
        at, value = at[ok], value[ok]
        text = np.searchsorted(first, at, side="right") - 1
        for t, p, v in zip(text.tolist(), (at - first[text]).tolist(), value.view(np.int64).tolist()):
            start = max(0, p - (length - k))
            out[t].append({"print": v, "length": length, "at": p, "left": p - start,
                           "words": words[t][start:p + length]})
    return out


def _item_prints(items: DataFrame, window: int, gram: int) -> DataFrame:
    source = items.select("item_id", "text")
    kind = source.schema["item_id"].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            ids, prints = [], []
            for item_id, words in zip(b.column(0), words_of(b.column(1), WORDS)):
                if words:
                    found = _contexts([words], [min(window, len(words))], gram, lambda v: np.ones(len(v), bool))[0]
                    prints += found
                    ids += [item_id.as_py()] * len(found)
            fields = [pa.array([p[n] for p in prints], t) for n, t in
                      (("print", pa.int64()), ("length", pa.int32()), ("left", pa.int32()),
                       ("words", pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), *fields],
                                             ["item_id", "print", "length", "item_left", "item_words"])

    return source.mapInArrow(run, f"item_id {kind}, print long, length int, item_left int, item_words array<string>")


def _extended(rows: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Spans of document words covered by item windows around joined prints."""
    for b in rows:
        got = []
        for row, item_id, length, at, left, words, item_left, item_words in zip(*(c.to_pylist() for c in b.columns)):
            k = gram_length(length, gram)
            if words[left:left + k] != item_words[item_left:item_left + k]:
                continue
            before = after = 0
            while before < min(left, item_left) and words[left - 1 - before] == item_words[item_left - 1 - before]:
                before += 1
            i, j = left + k, item_left + k
            while i + after < len(words) and j + after < len(item_words) and words[i + after] == item_words[j + after]:
                after += 1
            if before + k + after >= length:
                got.append((row, item_id, at - before, at + k + after))
        columns = list(zip(*got)) or [[], [], [], []]
        kinds = [pa.int64(), b.column(1).type, pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         ["row", "item_id", "start", "stop"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated."""
    spark = docs.sparkSession
    prints = materialise(_item_prints(items, window, gram), "item_prints")
    lengths = sorted(r["length"] for r in prints.select("length").distinct().collect())  # at most ``window``
    seen = spark.sparkContext.broadcast(hash_filter(prints, "print", filter_bits))
    source = doc_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33

        def passes(value: np.ndarray) -> np.ndarray:
            return in_filter(seen.value, value.view(np.int64))

        for b in bounded(rows, 1):
            words = words_of(b.column(1), WORDS)
            found = _contexts(words, lengths, gram, passes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(words))), b.column(0),
                 pa.array([len(w) for w in words], pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("print", pa.int64()), ("length", pa.int32()), ("at", pa.int32()),
                                                     ("left", pa.int32()), ("words", pa.list_(pa.string()))])))],
                ["row", "doc_id", "n_words", "prints"])
            row += len(words)

    seen_docs = materialise(
        source.mapInArrow(trimmed(scan), f"row long, doc_id {kind}, n_words long, prints array<{PRINT}>"), "doc_prints")
    item_kind = prints.schema["item_id"].dataType.simpleString()
    hits = (seen_docs.select("row", F.explode("prints").alias("p")).select("row", "p.*")
            .join(prints, ["print", "length"])
            .select("row", "item_id", "length", "at", "left", "words", "item_left", "item_words")
            .mapInArrow(lambda rows: _extended(rows, gram),
                        f"row long, item_id {item_kind}, start int, stop int"))
    # a document's spans and items are bounded by its own words and the item list
    per_doc = hits.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], s["stop"]).alias("reach")),
        lambda acc: acc["n"].cast("long"))
    per_doc = per_doc.select("row", covered.alias("n_hit"), "items")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return seen_docs.select("row", "doc_id", "n_words").join(per_doc, "row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` without those that hold an item window; all columns. Each row is
    judged by its own text, also where rows share an id or have none."""
    verdict = materialise(contamination(docs, items, window, gram), "contaminated")
    hit = verdict.filter("contaminated").select(F.col("doc_id").alias("_hit"))
    unclear = materialise(verdict.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                          .filter("n > 1 or doc_id is null").select(F.col("doc_id").alias("_unclear")), "unclear_ids")
    clean = docs.join(hit, F.col("doc_id") == F.col("_hit"), "left_anti")
    if unclear.isEmpty():
        return clean
    # the id does not tell which row was judged: these rows are judged again by a number
    same = F.col("doc_id").eqNullSafe(F.col("_unclear"))
    rows = materialise(docs.join(unclear, same, "left_semi").withColumn("_row", F.monotonically_increasing_id()),
                       "unclear_rows")
    again = materialise(contamination(rows.select(F.col("_row").alias("doc_id"), "text"), items, window, gram),
                        "contaminated_rows").filter("contaminated").select(F.col("doc_id").alias("_row"))
    return clean.join(unclear, same, "left_anti").unionByName(rows.join(again, "_row", "left_anti").drop("_row"))
