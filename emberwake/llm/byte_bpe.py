"""Byte-level BPE encoding and decoding by a two-tier look-up.

The vocabulary file holds one ``base64 rank`` line per token. Each match of
the split pattern is a pre-token:

1. a minimal perfect hash over the whole vocabulary tells whether the
   pre-token is itself a token (one probe, one comparison);
2. otherwise the merges run on a linked list of its bytes, with a heap giving
   the lowest-ranked adjacent pair, leftmost first.

The encoder is per-row work inside tasks; Spark reads, splits and writes. No
shuffle is needed. A worker builds its tables from the file once.

Cases: null text is empty; an empty text has no tokens (digests of the empty
string); repeated rows and ids each give their row; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

from emberwake.llm.common import batches, doc_text
from emberwake.llm.pieces import PieceEncoder

#: Fixed value: odd multiplier that spreads the displacements.
MIX = 0x9E3779B97F4A7C15
#: Pre-tokens and pieces a worker remembers before it starts anew.
LIMIT = 600_000


class MinimalPerfectHash:
    """n keys to 0..n-1 with no gaps, by hash and displace.

    Keys fall into n/2 buckets. Largest bucket first, a displacement is sought
    that sends all keys of the bucket to free slots; buckets of one key are
    given the slots that are left.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        self.buckets = n // 2 + 1
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for key in keys:
            h = xxh3_64_intdigest(key)
            members[h % self.buckets].append(h >> 20)
        if len({h for m in members for h in m}) < len(keys):
            raise ValueError("keys repeat")
        free = bytearray(b"\1") * n
        self.shift = [0] * self.buckets
        for b in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            if len(members[b]) < 2:
                break
            d = 0
            while True:
                spots = [(h ^ d * MIX) % n for h in members[b]]
                if all(free[s] for s in spots) and len(set(spots)) == len(spots):
                    break
                d += 1
            self.shift[b] = d
            for s in spots:
                free[s] = 0
        left = (s for s in range(n) if free[s])
        for b, m in enumerate(members):
            if len(m) == 1:
                self.shift[b] = -1 - next(left)

    def __call__(self, key: bytes) -> int:
        """The key's slot. A foreign key gets any slot, so the caller compares
        the key stored there."""
        h = xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        return (h >> 20 ^ d * MIX) % self.n if d >= 0 else -1 - d


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        """``pattern`` must match a run of letters with at most one space
        before it whole, and white space as ``pieces`` describes."""
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.split = regex.compile(pattern).findall
        tokens = list(self.ranks)
        self.hash = MinimalPerfectHash(tokens)
        self.slots: list[tuple[bytes, bytes]] = [(b"", b"")] * len(tokens)
        for t in tokens:
            self.slots[self.hash(t)] = (t, self.ranks[t].to_bytes(4, "little"))
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self.known: dict[str, bytes] = {}  # pre-token -> ids
        self.pieces = PieceEncoder(self._encode_pieces, LIMIT)

    def merge(self, word: bytes) -> list[int]:
        """Lowest-ranked pair first, on linked bytes: O(n log n)."""
        n, rank = len(word), self.ranks.get
        bits = n.bit_length()
        low = (1 << bits) - 1
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        pair = [rank(word[i:i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        heap = [r << bits | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & low
            if pair[i] != top >> bits:
                continue  # an older pair at this place
            j = after[i]
            k = after[i] = after[j]
            pair[j] = -1
            if k < n:
                before[k] = i
                r = pair[i] = rank(word[i:after[k]], -1)
                if r >= 0:
                    heappush(heap, r << bits | i)
            else:
                pair[i] = -1
            p = before[i]
            if p >= 0:
                r = pair[p] = rank(word[p:k], -1)
                if r >= 0:
                    heappush(heap, r << bits | p)
        ranks, out, i = self.ranks, [], 0
        while i < n:
            k = after[i]
            out.append(ranks[word[i:k]])
            i = k
        return out

    def pretoken(self, text: str) -> bytes:
        """Ids of one pre-token as little-endian uint32."""
        ids = self.known.get(text)
        if ids is None:
            word = text.encode()
            token, ids = self.slots[self.hash(word)]
            if token != word:
                merged = self.merge(word)
                ids = pack(f"<{len(merged)}I", *merged)
            if len(self.known) >= LIMIT:
                self.known.clear()
            self.known[text] = ids
        return ids

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        one, split, out = self.pretoken, self.split, []
        for p in pieces:
            if p[1:].isalpha() and (p[0] == " " or p[0].isalpha()):
                out.append(one(p))  # letters only: one match of the pattern
            else:
                out.append(b"".join(map(one, split(p))))
        return out

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.pieces(text), "<u4")

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> ByteBpe:
    """One per worker process and vocabulary."""
    return ByteBpe(path, pattern)


#: output column -> (Spark type, Arrow type)
OUTPUTS = {"ids": ("array<int>", pa.list_(pa.int32())), "n_tokens": ("long", pa.int64()),
           "ids_sha256": ("string", pa.string()), "decoded": ("binary", pa.binary()),
           "decoded_sha256": ("string", pa.string())}


def bpe_round_trip(docs: DataFrame, path: str, pattern: str,
                   outputs: tuple[str, ...] = ("ids", "n_tokens")) -> DataFrame:
    """doc_id and the chosen ``outputs`` for every row of ``docs``.

    ``ids`` are the encoded text, ``decoded`` the bytes decoded from those
    ids, the digests are taken of the ids (decimal, comma-joined) and of the
    decoded bytes.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for doc_id, texts in batches(rows):
            got: dict[str, list] = {name: [] for name in outputs}
            for text in texts:
                array = bpe.encode(text)
                ids = array.tolist()
                decoded = bpe.decode(ids) if {"decoded", "decoded_sha256"} & got.keys() else b""
                row = {"ids": lambda: array.astype(np.int32), "n_tokens": lambda: len(ids),
                       "ids_sha256": lambda: hashlib.sha256(
                           ",".join(map(bpe.text_of.__getitem__, ids)).encode()).hexdigest(),
                       "decoded": lambda: decoded,
                       "decoded_sha256": lambda: hashlib.sha256(decoded).hexdigest()}
                for name in outputs:
                    got[name].append(row[name]())
            yield pa.RecordBatch.from_arrays(
                [doc_id, *(pa.array(got[n], OUTPUTS[n][1]) for n in outputs)], ["doc_id", *outputs])

    source = doc_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{n} {OUTPUTS[n][0]}" for n in outputs)])
    return source.mapInArrow(run, schema)
