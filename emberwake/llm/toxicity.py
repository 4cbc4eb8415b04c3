"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, accents and compatibility forms removed,
look-alike letters and digit substitutions undone, invisible characters
dropped, everything else that is no letter turned into a space. i, l and 1 are
one letter. !, |, 6 and 9 inside a word or before it have two readings, which
both count: the letter (l, l, g, g), and a space.

The lexicon is learned from labelled rows. Terms are beginnings of words (whole
words among them); in scripts without spaces every letter is a word and terms
are runs of 2 to 5 letters. A term's weight is the smoothed log ratio of its document
rates in the two classes; of nested terms with the same evidence one is kept.
Exception phrases are learned too: two-word phrases around a term that mostly
clean rows use; an occurrence inside one does not count. The score is a
logistic function, fitted on the same rows, of the summed weights and of the
same sum divided by the text's length in words.

Learning is bounded: at most ``sample`` labelled rows (the first by hash of
doc_id), ``max_terms`` terms and as many phrases; so the broadcast model is
bounded as well. Scoring covers every row and whole text.

Cases: null text scores as empty; an empty text has its fitted base score;
labels that are null or lack a document teach nothing; without both classes
every score is 0; repeated doc_ids score each row; repeated label rows with
different values count as toxic; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import crc_mod, doc_text, materialise

# Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "i": "l"}
# Signs that stand for a letter or for none, and their marks in a folded word.
JOINTS = {"!": "\x01", "|": "\x01", "6": "\x02", "9": "\x02"}
JOINT, LETTERS = re.compile("[\x01\x02]+"), str.maketrans("\x01\x02", "lg")
# Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
UNSPACED = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    "\U00020000-\U0003ffff]")
# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w",
    "х": "x", "у": "y", "α": "a", "β": "b", "ϲ": "c", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l",
    "ø": "o", "đ": "d", "ħ": "h",
}
#: Invisible characters.
INVISIBLE = "­᠎​‌‍⁠﻿"
SHORTEST, LONGEST = 3, 10
LETTER_RUNS = range(2, 6)
SAMPLE, MAX_TERMS = 20_000, 5_000


class Folding(dict):
    """Code point -> folded text, worked out once per character."""

    def __missing__(self, code: int) -> str:
        out = []
        for c in unicodedata.normalize("NFKD", chr(code)).lower():
            for d in unicodedata.normalize("NFKD", c):
                d = LOOKALIKES.get(d, d)
                d = SUBSTITUTES.get(d, d)
                if d in JOINTS:
                    out.append(JOINTS[d])
                elif d.isalpha():
                    out.append(f" {d} " if UNSPACED.match(d) else d)
                elif unicodedata.category(d) not in ("Mn", "Me", "Cf") and d not in INVISIBLE:
                    out.append(" ")
        self[code] = text = "".join(out)
        return text


FOLDING = Folding()


def readings(word: str) -> list[str]:
    """``word`` with its joints as letters, then what stands behind each joint."""
    word = word.rstrip("\x01")  # punctuation
    first, *rest = JOINT.split(word)
    if not first and not any(rest):
        return []
    return [word.translate(LETTERS), *(w for w in rest if w)]


def fold(text: str) -> str:
    """Words of letters between single spaces, one at either end."""
    words = text.translate(FOLDING).split()
    if any("\x01" in w or "\x02" in w for w in words):
        words = [r for w in words for r in (readings(w) if JOINT.search(w) else (w,))]
    return " " + " ".join(words) + " "


@dataclass(frozen=True)
class Model:
    terms: dict[str, float] = field(default_factory=dict)  # " " + beginning of a word -> weight
    phrases: tuple[str, ...] = ()                          # " word word "
    curve: tuple[float, float, float] = (-math.inf, 0.0, 0.0)

    def __hash__(self) -> int:
        return hash((tuple(self.terms.items()), self.phrases, self.curve))


@lru_cache(maxsize=2)
def automaton(model: Model):
    """Built once per worker and model."""
    out = ahocorasick.Automaton()
    for phrase in model.phrases:
        out.add_word(phrase, (phrase, 0.0))
    for term, weight in model.terms.items():
        out.add_word(term, (term, weight))
    if len(out):
        out.make_automaton()
    return out


def occurrences(folded: str, model: Model) -> list[tuple[int, float]]:
    """(start, weight) of the longest term at each place, exceptions taken out."""
    auto = automaton(model)
    if not len(auto):
        return []
    at: dict[int, tuple[int, float]] = {}
    covered: list[tuple[int, int]] = []
    for end, (word, weight) in auto.iter(folded):
        start = end - len(word) + 1
        if weight == 0.0:
            covered.append((start, end))
        elif len(word) > at.get(start, (0, 0.0))[0]:
            at[start] = len(word), weight
    covered.sort()
    starts = [s for s, _ in covered]
    out = []
    for start, (_, weight) in at.items():
        k = bisect_right(starts, start)
        if not any(e > start for s, e in covered[max(0, k - 2):k]):
            out.append((start, weight))
    return out


def features(text: str, model: Model) -> tuple[float, float]:
    """Logarithms of the summed weight and of that sum per thousand words."""
    folded = fold(text)
    total = sum(w for _, w in occurrences(folded, model))
    if not total:
        return 0.0, 0.0
    return math.log1p(total), math.log1p(1000 * total / (folded.count(" ") - 1))


def score(text: str, model: Model) -> float:
    base, by_sum, by_density = model.curve
    if base == -math.inf:
        return 0.0
    a, b = features(text, model)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, base + by_sum * a + by_density * b))))


def _beginnings(folded: str) -> set[str]:
    words = folded.split()
    out = {w[:k] for w in set(words) for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}
    if UNSPACED.search(folded):
        run = 0  # letters of such a script up to here
        for i, w in enumerate(words, 1):
            run = run + 1 if UNSPACED.match(w) else 0
            out |= {" ".join(words[i - k:i]) for k in LETTER_RUNS if k <= run}
    return out


def _counted(df: DataFrame, count) -> DataFrame:
    """term, toxic, clean: documents with each of ``count(text)``'s terms,
    added up inside each task first."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for b in rows:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[toxic].update(count(text or ""))
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()),
             pa.array([seen[0][t] for t in terms], pa.int64())], ["term", "toxic", "clean"])

    return (df.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def labelled(docs: DataFrame, labels: DataFrame, sample: int, train: Column | None) -> DataFrame:
    """text, toxic of the documents of at most ``sample`` labels, in a table of
    its own."""
    chosen = labels.filter("toxic is not null and doc_id is not null")
    if train is not None:
        chosen = chosen.filter(train)
    chosen = (chosen.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # the sample size bounds what is broadcast
    return materialise(doc_text(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxicity_sample")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_terms: int = MAX_TERMS,
          train: Column | None = None, support: int = 3, ratio: float = 30.0) -> Model:
    """The model of the labelled rows that ``train`` (on labels) admits.

    A term needs ``support`` toxic documents, or a two-hundredth of them if
    that is more, and a rate ``ratio`` times that among clean ones.
    """
    rows = labelled(docs, labels, sample, train)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Model()
    least = max(support, toxic // 200)
    spark = rows.sparkSession
    frequent = (_counted(rows.filter("toxic = 1"), lambda t: _beginnings(fold(t)))
                .filter(F.col("toxic") >= least).orderBy(F.desc("toxic"), "term").limit(20 * max_terms))
    possible = spark.sparkContext.broadcast({r["term"]: r["toxic"] for r in frequent.collect()})
    among = {r["term"]: r["clean"] for r in _counted(
        rows.filter("toxic = 0"), lambda t: _beginnings(fold(t)) & possible.value.keys()).collect()}

    def weight(a: int, b: int) -> float:
        return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))

    terms = {t: (a, weight(a, among.get(t, 0))) for t, a in possible.value.items()}
    terms = {t: v for t, v in terms.items() if v[1] >= math.log(ratio)}
    # a beginning whose evidence is nearly all one longer term's gives way to it
    longer = {}
    for t, (a, _) in terms.items():
        for k in range(SHORTEST, len(t)):
            longer[t[:k]] = max(longer.get(t[:k], 0), a)
    terms = {t: v for t, v in terms.items() if longer.get(t, 0) < 0.95 * v[0]}
    # a longer term adds nothing to a beginning that is nearly as telling
    terms = {t: v for t, v in terms.items()
             if not any(t[:k] in terms and terms[t[:k]][1] >= v[1] - 1.0 for k in range(SHORTEST, len(t)))}
    kept = sorted(terms, key=lambda t: (-terms[t][0] * terms[t][1], t))[:max_terms]
    lexicon = {" " + t: terms[t][1] for t in sorted(kept)}
    plain = spark.sparkContext.broadcast(Model(lexicon, (), (0.0, 0.0, 0.0)))

    def phrases(text: str) -> set[str]:
        folded, out = fold(text), set()
        for start, _ in occurrences(folded, plain.value):
            word = folded[start + 1:].split(" ", 1)[0]
            nxt = folded[start + 1 + len(word):start + 200 + len(word)].split()
            prev = folded[max(0, start - 200):start].split()
            out |= {f" {word} {w} " for w in nxt[:1]} | {f" {w} {word} " for w in prev[-1:]}
        return out

    # phrases that several clean rows use, and more often than toxic ones
    excepted = (_counted(rows, phrases).filter((F.col("clean") >= 3) & (F.col("clean") > 3 * F.col("toxic")))
                .orderBy(F.desc("clean"), "term").limit(max_terms))
    model = Model(lexicon, tuple(sorted(r["term"] for r in excepted.collect())), (0.0, 0.0, 0.0))
    return Model(model.terms, model.phrases, _fit(rows, model))


def _fit(rows: DataFrame, model: Model) -> tuple[float, float, float]:
    """Logistic curve over the two features of the sample (at most its size)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [features(t or "", shared.value) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.float64()),
                 b.column(1)], ["a", "b", "toxic"])

    seen = rows.select("text", "toxic").mapInArrow(run, "a double, b double, toxic int") \
        .orderBy(F.xxhash64("a", "b", "toxic")).limit(SAMPLE).toPandas()
    x = np.column_stack([np.ones(len(seen)), seen["a"], seen["b"]])
    y = seen["toxic"].to_numpy(float)
    w, ridge = np.zeros(3), np.diag([1e-3, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), max(0.0, float(w[1])), max(0.0, float(w[2]))


def scorer(spark, model: Model):
    """A column function: text -> score."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxicity(text: pa.Array) -> pa.Array:
        return pa.array([score(t or "", shared.value) for t in text.to_pylist()], pa.float64())

    return toxicity


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, held_out_of: int = 4,
                    held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; rows whose crc32 of the
    id's text leaves ``held_out`` modulo ``held_out_of`` teach nothing."""
    model = learn(docs, labels, train=crc_mod("doc_id", held_out_of) != held_out)
    return (doc_text(docs)
            .select("doc_id", F.coalesce(crc_mod("doc_id", held_out_of) == held_out, F.lit(False)).alias("held_out"),
                    scorer(docs.sparkSession, model)("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` whose score is below ``threshold``; all columns."""
    model = learn(docs, labels)
    return docs.filter(scorer(docs.sparkSession, model)("text") < threshold)
