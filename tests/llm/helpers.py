"""Small tables with every awkward case, and brute-force versions."""

import hashlib
import re

from pyspark.sql import types as T

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{k % 977}x{k % 13}" for k in range(30_000))
SHARED = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
TEXTS = [
    None, "", " ", "a", "A", "a b", "Hello, World! Ünïcode ÄÖ ß \U0001F600 ​ tab\tline\n", LONG, LONG + " tail",
    SHARED, SHARED.upper(), "before " + SHARED + " after", "one two three four five six seven eight nine other",
    SHARED, "the the the the the the the the the the the the", "12 34 56 78", "<|endoftext|> as text", "\x00\x01 odd",
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # columns whose names the operators use inside
    T.StructField("row", T.LongType()), T.StructField("size", T.StringType()), T.StructField("n_words", T.StringType()),
    T.StructField("ids", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("digest", T.StringType())])


def awkward(spark, texts=TEXTS):
    """Unique ids, then the last row again, and a null id."""
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(len(texts) - 1, texts[-1]), (None, "a null id")] if texts else []
    return spark.createDataFrame([(d, t, None, "x", None, "", "7", "z") for d, t in rows], SCHEMA), rows


def unique(spark, texts=TEXTS):
    rows = list(enumerate(texts))
    return spark.createDataFrame([(d, t, None, "x", None, "", "7", "z") for d, t in rows], SCHEMA), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return (text or "").translate(UPPER)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return set()
    return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))}


def component_ids(rows, width, percent):
    """Smallest id reachable over links between all pairs."""
    sets = {d: shingles(t, width) for d, t in rows}
    least = {d: d for d in sets}

    def top(d):
        while least[d] != d:
            d = least[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(a), top(b)))
                least[q] = p
    return {d: (len(sets[d]), top(d)) for d in ids}


def benchmark_hits(text, items):
    """(n_words, n_hit, sorted ids) of one text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, found = word.findall(lower(text)), set(), set()
    for item_id, item in items:
        want = word.findall(lower(item))
        n = min(10, len(want))
        windows = {tuple(want[k:k + n]) for k in range(len(want) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k:k + n]) in windows:
                hit.update(range(k, k + n))
                found.add(item_id)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)
