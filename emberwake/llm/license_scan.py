"""License scans by patience alignment.

A template occurs where a stretch of a text covers at least ``percent`` of the
template's words in order, among them, word after word, the phrases that tell
the license from its neighbours (name, version, nc, sa, affero, clause 3), and
no word that only a neighbour has stands in it or just behind. A license without
a template thus has no name rather than a wrong one. Words are runs of letters
and digits, lower-cased.

1. A template of n words needs ``percent`` of them, so a document that lacks
   too many of its distinct words, or one of the phrases' words, is passed over,
   and so is every stretch with too few words of the template. These tests lose
   no occurrence. Whole texts begin with such a phrase, their heading, and are
   aligned from where it stands; without it they have no name.
2. A stretch that is left (n words and a quarter more) is aligned: common ends
   are matched, words that are unique in both sides and lie on the longest
   increasing subsequence become anchors, and the gaps between anchors are
   aligned in the same way. Coverage is the share of matched template words.
3. A stretch that passes is an occurrence, and the search goes on behind it. Of
   overlapping occurrences of several templates the one with more matched words
   stays; of equals the one with the higher coverage, then the smaller name.

Every document is judged on its own where it is read: no shuffle, and memory is
bounded by one batch and one text.

Cases: a null text has no words; an empty text has no occurrence; a template
without words never occurs; repeated rows and ids each give their row; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberwake.llm.common import batches, doc_text
from emberwake.llm.license_texts import BARRED, HEADINGS, TELLING, TEMPLATES

WORDS = re.compile(r"[^\W_]+")
PERCENT = 80
BEHIND = 30  # words behind a match that may hold a barred one
MATCH = [("license", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("matched", pa.int32()),
         ("coverage", pa.float64())]


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def rising(values: list[int]) -> list[int]:
    """Indices of the longest increasing subsequence of distinct values."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        before.append(ends[k - 1] if k else -1)
        tops[k:k + 1] = [v]
        ends[k:k + 1] = [i]
    out = []
    i = ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, rising on both sides."""
    pairs = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        lo, hi, left, right = gaps.pop()
        while lo < hi and left < right and a[lo] == b[left]:
            pairs.append((lo, left))
            lo, left = lo + 1, left + 1
        while lo < hi and left < right and a[hi - 1] == b[right - 1]:
            hi, right = hi - 1, right - 1
            pairs.append((hi, right))
        if lo == hi or left == right:
            continue
        here, there = Counter(a[lo:hi]), Counter(b[left:right])
        place = {w: j for j, w in enumerate(b[left:right], left) if there[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[lo:hi], lo) if here[w] == 1 and w in place]
        if not anchors:
            continue
        for k in rising([j for _, j in anchors]):
            i, j = anchors[k]
            pairs.append((i, j))
            gaps.append((lo, i, left, j))
            lo, left = i + 1, j + 1
        gaps.append((lo, hi, left, right))
    return sorted(pairs)


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    distinct: frozenset[str]
    need: int  # words that must match
    reach: int  # words of a stretch
    phrases: tuple[tuple[str, ...], ...] = ()  # each must be matched word after word
    telling: frozenset[str] = frozenset()  # their words
    barred: frozenset[str] = frozenset()
    headed: bool = False  # begins with its first phrase

    @classmethod
    def of(cls, name: str, text: str, percent: int, telling: tuple[str, ...] = (), barred: tuple[str, ...] = (),
           headed: bool = False) -> Template:
        words = tuple(words_of(text))
        phrases = tuple(tuple(words_of(p)) for p in telling)
        return cls(name, words, frozenset(words), -(-percent * len(words) // 100), len(words) + len(words) // 4,
                   phrases, frozenset(w for p in phrases for w in p), frozenset(barred), headed)

    def told(self, words: list[str], start: int, pairs: list[tuple[int, int]]) -> bool:
        """Whether the match has every phrase and no barred word."""
        at = {j: i for i, j in pairs}
        if any(w in self.barred for w in words[start + pairs[0][0]:start + pairs[-1][0] + 1 + BEHIND]):
            return False
        return all(any(all(at.get(q + k, -1) == at[q] + k for k in range(len(p)))
                       for q in places(self.words, p) if q in at) for p in self.phrases)


def places(words, phrase: tuple[str, ...]) -> list[int]:
    """Positions where ``phrase`` stands in ``words``."""
    n, first = len(phrase), phrase[0]
    return [k for k, w in enumerate(words) if w == first and tuple(words[k:k + n]) == phrase]


def occurrences(words: list[str], template: Template) -> Iterator[tuple[str, int, int, int, float]]:
    """(license, start, stop, matched, coverage) of disjoint stretches, in order."""
    known = np.fromiter((w in template.distinct for w in words), bool, len(words))
    held = np.concatenate([[0], np.cumsum(known)])
    starts = np.array(places(words, template.phrases[0]), int) if template.headed else np.flatnonzero(known)
    stops = np.minimum(starts + template.reach, len(words))
    free = 0
    for start in starts[held[stops] - held[starts] >= template.need].tolist():
        if start < free:
            continue
        pairs = align(words[start:start + template.reach], template.words)
        if len(pairs) >= template.need and template.told(words, start, pairs):
            free = start + pairs[-1][0] + 1
            yield (template.name, start + pairs[0][0], free, len(pairs), len(pairs) / len(template.words))


def scan(words: list[str], templates: list[Template]) -> list[tuple[str, int, int, int, float]]:
    """The occurrences that stay, by position."""
    seen = set(words)
    found = [m for t in templates if t.words and t.need <= len(words) and t.telling <= seen
             and len(t.distinct - seen) <= len(t.words) - t.need for m in occurrences(words, t)]
    kept: list[tuple[str, int, int, int, float]] = []
    for m in sorted(found, key=lambda m: (-m[3], -m[4], m[0], m[1])):
        if all(m[2] <= k[1] or k[2] <= m[1] for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: m[1])


def known_licenses(percent: int = PERCENT) -> list[Template]:
    """The licenses of ``license_texts`` with what tells them apart."""
    return [Template.of(name, text, percent, TELLING.get(name, ()), BARRED.get(name, ()), name in HEADINGS)
            for name, text in sorted(TEMPLATES.items())]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_matches, license (of the match
    with the most words, the first of equals; else null), covered_words, and
    matches: array of license, start, stop (word positions), matched, coverage."""
    source = doc_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    if templates is None:
        known = known_licenses(percent)
    else:
        known = [Template.of(name, text, percent) for name, text in sorted(templates.items())]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, texts in batches(rows):
            words = [words_of(t) for t in texts]
            found = [scan(w, known) for w in words]
            best = [max(m, key=lambda x: x[3])[0] if m else None for m in found]
            matches = [[dict(zip((n for n, _ in MATCH), x)) for x in m] for m in found]
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array([len(w) for w in words], pa.int64()), pa.array([len(m) for m in found], pa.int64()),
                 pa.array(best, pa.string()), pa.array([sum(x[2] - x[1] for x in m) for m in found], pa.int64()),
                 pa.array(matches, pa.list_(pa.struct(MATCH)))],
                ["doc_id", "n_words", "n_matches", "license", "covered_words", "matches"])

    return source.mapInArrow(run, f"doc_id {kind}, n_words long, n_matches long, license string, covered_words long, "
                                  "matches array<struct<license:string,start:int,stop:int,matched:int,coverage:double>>")
