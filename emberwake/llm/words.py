"""Word hashes and fixed-size filters for operators on word sequences."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

#: Words a worker remembers before it starts anew.
WORDS_HELD = 100_000
FILTER_BITS = 1 << 24


class WordHashes(dict):
    """word -> 64-bit hash."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()


def words_of(texts: pa.Array, pattern: re.Pattern) -> list[list[str]]:
    """The words of each text, A-Z lower-cased; null has none."""
    return [pattern.findall(t) for t in pc.ascii_lower(pc.fill_null(texts, "")).to_pylist()]


def hashed(words: list[list[str]], total: int) -> np.ndarray:
    """Hashes of all words, one text after another."""
    get = HASHES.__getitem__
    return np.fromiter((h for w in words for h in map(get, w)), np.uint64, total)


def hash_filter(df: DataFrame, hash_column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A one-hash Bloom filter of a long column, as 64-bit words. It is or-ed
    together by Spark; ``bits`` bounds what reaches the driver and the tasks."""
    words = (df.select(F.pmod(hash_column, F.lit(bits)).alias("bit"))
             .groupBy((F.col("bit") / 64).cast("long").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask")).collect())
    out = np.zeros(bits // 64, np.int64)
    for w in words:
        out[w["word"]] = w["mask"]
    return out.view(np.uint64)


def in_filter(filter_words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which signed 64-bit ``values`` the filter does not rule out."""
    bit = np.mod(values, np.int64(64 * len(filter_words))).astype(np.uint64)
    return (filter_words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
