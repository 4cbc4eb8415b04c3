"""Language-model scores from an Elias-Fano n-gram trie.

The trie has ``order`` levels (3 unless said otherwise): words, their followers,
the followers of these pairs, and so on. Tokens are the words of a text and one
end; the first token's context is a begin mark, and no context reaches beyond it.

* Vocabulary: word hashes (64 bits) in ascending order as an Elias-Fano
  sequence; a word's number is its position. Exact counts lie beside it.
* Followers: a context is its position in the level above (for the second level
  a word's number), dealt to shards by the remainder of its division by their
  number; a shard keeps the quotient. Per context its followers' numbers, ascending,
  as one Elias-Fano sequence made monotone by adding the last value of the context
  before; the pointers to each context's first follower are another such sequence.
  A look-up finds the context, reads its pointers, and searches the follower as a
  successor relative to that context.

Probabilities are interpolated: p(w | h) = a(h, w) + b(h) p(w | h'), where h' is h
without its first word, up to p(w), with absolute
discounting a = (c - D) / c(h), b = D followers(h) / c(h), both stored in eight
bits, rounded down, so they sum to one at most. p(w) keeps the Good-Turing share
of words seen once for the one unknown word, the rest in proportion to counts.

1. Training texts are counted where they are read; each task ships its distinct
   words, sorted and compressed, to the shard of their hash range. A shard merges
   them and writes its file into the shared folder.
2. All texts are read a second time and become rows of word numbers, with the
   base score; what follows reads these rows.
3. For each further level, contexts are looked up in the levels so far, and the
   distinct pairs of context and follower shipped the same way to the shard of
   their context, which writes its part of the level.
4. Scoring tasks memory-map the files and look up slices of a few MB of numbers.

What a task ships grows with its input; nothing is pruned. The driver sees five
numbers per shard. A level has as many shards as the session has shuffle
partitions, or more where a shard's contexts and words would not fit 64 bits.

Cases: null text is empty and has the end alone; rows without doc_id are not
held out; repeated rows count each time; without training rows every token is
the unknown word; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import bounded, discard, doc_text, map_file, materialise, stored, write_file
from emberwake.llm.elias_fano import EliasFano, from_buffer, to_bytes
from emberwake.llm.words import HASHES, words_of
from emberwake.session import scratch_path

#: Fixed value: the words of a lower-cased text.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: The end token's place among the word hashes.
END = np.uint64(0x51ED270B0A3F5C11)
#: Bytes of text that are looked up together.
SLICE = 4 << 20
#: Bytes of word numbers that are looked up together.
NUMBERS = 8 << 20
#: Tokens that a task counts together before it ships them.
HELD = 2_000_000
#: What the driver sees of a shard.
COUNTED = ["shard", "types", "tokens", "once", "twice"]
#: Eight-bit codes: code k stands for exp(-k * STEP).
STEP = 0.09
CODES = np.exp(-STEP * np.arange(256))


def quantised(p: np.ndarray) -> np.ndarray:
    """Codes of probabilities, rounded down; the last stands for all below."""
    return np.minimum(255, np.ceil(-np.log(np.maximum(p, 1e-300)) / STEP - 1e-9)).astype(np.uint8)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes) of all texts' tokens, each text's end included."""
    words = words_of(texts, WORDS)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    out = np.empty(int(sizes.sum()), np.uint64)
    ends = np.cumsum(sizes) - 1
    plain = np.ones(len(out), bool)
    plain[ends] = False
    out[plain] = np.fromiter(map(HASHES.__getitem__, chain.from_iterable(words)), np.uint64, int(plain.sum()))
    out[ends] = END
    return out, sizes


def squeeze(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts: differences, by byte planes, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    planes = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(len(keys).to_bytes(8, "little") + steps.tobytes() + planes.tobytes(), 1)


def unsqueeze(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:8], "little")
    both = np.frombuffer(raw, np.uint8, offset=8).reshape(2, 8, n)
    keys, counts = (np.ascontiguousarray(x.T).view("<u8").reshape(-1) for x in both)
    return np.cumsum(keys), counts


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[head], np.add.reduceat(c, head) if len(k) else c


def grouped(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions by shard, and where each shard starts among them."""
    shard = shard.astype(np.uint16 if shards <= 1 << 16 else np.int64)  # sixteen bits are sorted by radix
    order = np.argsort(shard, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


def _ship(rows: DataFrame, keys_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], shards: int,
          size: int) -> DataFrame:
    """shard, data: the distinct keys of each run of about HELD tokens.
    ``keys_of`` gives the keys, and their shards, of slices of ``size`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        places: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            order, cut = grouped(np.concatenate(places), shards)
            all_keys = np.concatenate(keys)[order]
            found = np.flatnonzero(np.diff(cut)).tolist()
            data = [squeeze(*np.unique(all_keys[cut[k]:cut[k + 1]], return_counts=True)) for k in found]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(data, pa.binary())], ["shard", "data"])

        for b in bounded(batches, 0, size):
            key, shard = keys_of(b.column(0))
            keys.append(key)
            places.append(shard)
            held += len(key)
            if held >= HELD:
                yield flush()
                keys, places, held = [], [], 0
        if held:
            yield flush()

    return rows.mapInArrow(run, "shard int, data binary")


def _merged(shipped: DataFrame, shards: int, name: str) -> tuple[DataFrame, str, list]:
    """A table of one row per shard: its distinct keys with their counts; its
    folder; and the rows without the keys: shard, types, tokens, once, twice."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, [], []

        def merge() -> None:  # like runs together, so memory follows the distinct keys
            k, c = summed(keys, counts)
            keys[:], counts[:] = [k], [c]

        def row() -> pa.RecordBatch:
            merge()
            c = counts[0]
            numbers = [now, len(c), int(c.sum()), int((c == 1).sum()), int((c == 2).sum())]
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in numbers),
                                               pa.array([squeeze(keys[0], c)], pa.binary())], [*COUNTED, "data"])

        for b in rows:
            for shard, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if shard != now:
                    if now is not None:
                        yield row()
                    now = shard
                    keys.clear()
                    counts.clear()
                k, c = unsqueeze(data)
                keys.append(k)
                counts.append(c)
                if len(keys) >= 16:
                    merge()
        if now is not None:
            yield row()

    schema = ", ".join(f"{c} long" for c in COUNTED) + ", data binary"
    merged, path = stored(shipped.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard")
                         .mapInArrow(run, schema), name)
    return merged, path, merged.select(COUNTED).collect()  # a row per shard


def _written(merged: DataFrame, path: str, write: Callable[[int, np.ndarray, np.ndarray], None]) -> None:
    """``write``(shard, keys, counts) for every shard, in tasks; then the table
    goes, its files hold what it held."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for shard, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                write(shard, *unsqueeze(data))
            yield b.select([0])

    merged.select("shard", "data").mapInArrow(run, "shard long").write.format("noop").mode("overwrite").save()
    discard(merged.sparkSession, path)


class Vocabulary:
    """Word hashes to numbers, numbers to counts; shards are ranges of the hash."""

    def __init__(self, folder: str, sizes: tuple[int, ...]):
        self.folder, self.shards, self.sizes = folder, len(sizes), sizes
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.open: dict[int, tuple[EliasFano, np.ndarray]] = {}

    def _shard(self, k: int) -> tuple[EliasFano, np.ndarray]:
        if k not in self.open:
            arrays = from_buffer(map_file(self.folder, f"words-{k:05d}.ef"))
            self.open[k] = EliasFano.of(arrays, "words"), arrays["counts"]
        return self.open[k]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words; -1: unknown."""
        unique, back = np.unique(hashes, return_inverse=True)
        number = np.full(len(unique), -1, np.int64)
        cut = np.searchsorted(hash_shard(unique, self.shards), np.arange(self.shards + 1))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            if self.sizes[k]:
                at = self._shard(k)[0].find(unique[cut[k]:cut[k + 1]])
                number[cut[k]:cut[k + 1]] = np.where(at >= 0, self.first[k] + at, -1)
        return number[back]

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """How often the words were seen; 0: unknown."""
        count = np.zeros(len(numbers), np.int64)
        known = np.flatnonzero(numbers >= 0)
        order, cut = grouped(np.searchsorted(self.first, numbers[known], side="right") - 1, self.shards)
        order = known[order]
        for k in np.flatnonzero(np.diff(cut)).tolist():
            rows = order[cut[k]:cut[k + 1]]
            count[rows] = self._shard(k)[1][numbers[rows] - self.first[k]]
        return count


def hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ascending ranges of the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def dealt(contexts: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """A context's number within its shard, and the shard."""
    local = contexts // shards
    return local, contexts - local * shards


class Followers:
    """Shards of a further level: (context, follower) to a, b and position."""

    def __init__(self, folder: str, level: int, bits: int, sizes: tuple[int, ...]):
        self.folder, self.level, self.bits, self.shards, self.sizes = folder, level, bits, len(sizes), sizes
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.open: dict[int, tuple] = {}

    @staticmethod
    def build(keys: np.ndarray, counts: np.ndarray, bits: int, discount: float) -> bytes:
        """File of a shard's pairs (context << bits | follower), ascending."""
        context, follower = keys >> np.uint64(bits), keys & np.uint64((1 << bits) - 1)
        head = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        size = np.diff(head, append=len(keys))
        total = np.add.reduceat(counts, head).astype(np.float64)
        # a context's followers come after the last value of the one before
        last = follower[head + size - 1] + np.uint64(1)
        base = np.concatenate([[0], np.cumsum(last)[:-1]]).astype(np.uint64)
        each = np.repeat(np.arange(len(head)), size)
        return to_bytes({
            **EliasFano.arrays(context[head], "contexts"),
            **EliasFano.arrays(np.concatenate([head, [len(keys)]]), "pointers"),
            **EliasFano.arrays(base[each] + follower, "followers"),
            "a": quantised((counts - discount) / total[each]),
            "b": quantised(discount * size / total)})

    def _shard(self, k: int) -> tuple:
        if k not in self.open:
            arrays = from_buffer(map_file(self.folder, f"followers-{self.level}-{k:05d}.ef"))
            self.open[k] = (*(EliasFano.of(arrays, n) for n in ("contexts", "pointers", "followers")),
                            arrays["a"], arrays["b"])
        return self.open[k]

    def look_up(self, context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """a (0 where the pair is new), b (1 where the context is), and the
        pair's position in the level (-1: new). Equal pairs are asked once."""
        a, b, place = np.zeros(len(context)), np.ones(len(context)), np.full(len(context), -1, np.int64)
        known = np.flatnonzero(context >= 0)
        local, shard = dealt(context[known], self.shards)
        order, cut = grouped(shard, self.shards)
        none = np.uint64((1 << self.bits) - 1)  # the number of no word: an unknown follower
        local = local[order].astype(np.uint64) << np.uint64(self.bits)
        order = known[order]
        keys = local | np.where(follower[order] < 0, none, follower[order].astype(np.uint64))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            if not self.sizes[k]:
                continue
            contexts, pointers, followers, a_code, b_code = self._shard(k)
            rows = order[cut[k]:cut[k + 1]]
            unique, back = np.unique(keys[cut[k]:cut[k + 1]], return_inverse=True)
            asked, word = unique >> np.uint64(self.bits), unique & none
            head = np.concatenate([[True], asked[1:] != asked[:-1]])
            group = np.cumsum(head) - 1
            node = contexts.find(asked[head])
            hit = np.flatnonzero(node >= 0)
            lo, hi = (np.zeros(len(node), np.int64) for _ in range(2))
            base = np.zeros(len(node), np.uint64)
            lo[hit], hi[hit] = (pointers.access(node[hit] + step).astype(np.int64) for step in (0, 1))
            later = hit[lo[hit] > 0]
            base[later] = followers.access(lo[later] - 1) + np.uint64(1)
            rest = np.ones(len(node))
            rest[hit] = CODES[b_code[node[hit]]]
            b[rows] = rest[group][back]
            ask = np.flatnonzero((node >= 0)[group] & (word != none))
            of = group[ask]
            at = followers.find(base[of] + word[ask], lo[of], hi[of])
            share, position = np.zeros(len(unique)), np.full(len(unique), -1, np.int64)
            found = ask[at >= 0]
            share[found] = CODES[a_code[at[at >= 0]]]
            position[found] = self.first[k] + at[at >= 0]
            a[rows], place[rows] = share[back], position[back]
        return a, b, place


@lru_cache(maxsize=2)
def _vocabulary(folder: str, sizes: tuple[int, ...]) -> Vocabulary:
    """Opened once per worker and model."""
    return Vocabulary(folder, sizes)


@lru_cache(maxsize=8)
def _followers(folder: str, level: int, bits: int, sizes: tuple[int, ...]) -> Followers:
    return Followers(folder, level, bits, sizes)


class Model:
    """Where the files lie, and the few numbers that the driver holds."""

    def __init__(self, folder: str, sizes: tuple[int, ...], total: int, once: int):
        self.folder, self.sizes, self.total, self.once = folder, sizes, total, once
        self.further: tuple[tuple[int, ...], ...] = ()  # pairs of each shard, per further level
        self.types = sum(sizes)
        #: of a follower's number: one more than of the begin mark, for the number of no word
        self.bits = (self.types + 1).bit_length()
        #: how word numbers are stored
        self.kind = "<i4" if self.types < 1 << 31 else "<i8"

    @property
    def vocabulary(self) -> Vocabulary:
        return _vocabulary(self.folder, self.sizes)

    @property
    def begin(self) -> int:
        """The begin mark's number as a context."""
        return self.types

    def numbers_of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, sizes) of rows of numbers."""
        data = column.to_pylist()
        number = np.frombuffer(b"".join(data), self.kind)
        return number.astype(np.int64), np.array(list(map(len, data)), np.int64) // number.itemsize

    def contexts(self, number: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list]:
        """Each token's context in the level to come (-1: never seen), and a and
        b in each further level."""
        first = np.cumsum(sizes) - sizes

        def moved(place: np.ndarray, start: int) -> np.ndarray:
            context = np.concatenate([[-1], place[:-1]]) if len(place) else place
            context[first] = start
            return context

        context, shares = moved(number, self.begin), []
        for k, pairs in enumerate(self.further):
            a, b, place = _followers(self.folder, 2 + k, self.bits, pairs).look_up(context, number)
            shares.append((a, b))
            context = moved(place, -1)
        return context, shares


def vocabulary(texts: DataFrame, folder: str | None = None) -> Model:
    """The first level of a model of the one column of ``texts``."""
    spark = texts.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = folder or scratch_path(spark, "language_model")

    def keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        hashes, _ = tokens(column)
        return hashes, hash_shard(hashes, shards)

    def words(shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
        write_file(folder, f"words-{shard:05d}.ef", to_bytes(
            {**EliasFano.arrays(keys, "words"), "counts": counts.astype("<u4" if counts.max() < 1 << 32 else "<u8")}))

    merged, path, made = _merged(_ship(texts, keys, shards, SLICE), shards, "lm_words")
    _written(merged, path, words)
    types = {r["shard"]: r["types"] for r in made}
    return Model(folder, tuple(types.get(k, 0) for k in range(shards)),
                 sum(r["tokens"] for r in made), sum(r["once"] for r in made))


def numbered(docs: DataFrame, model: Model) -> DataFrame:
    """A table of the columns of ``docs`` beside its second, the text; n_tokens,
    n_known, base_score; and numbers, the words' numbers one after another."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    kept = [c for k, c in enumerate(docs.columns) if k != 1]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = model.total, model.types
        for b in bounded(rows, 1, SLICE):
            hashes, sizes = tokens(b.column(1))
            number = model.vocabulary.numbers(hashes)
            base = np.log10((model.vocabulary.counts(number) + 1) / (n + (v + 1))).tolist()
            ends = np.cumsum(sizes)
            spans = list(zip((ends - sizes).tolist(), ends.tolist()))
            data = number.astype(model.kind)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(b.column(2 + i) for i in range(len(kept) - 1)), pa.array(sizes),
                 pa.array(np.add.reduceat((number >= 0).astype(np.int64), ends - sizes)),
                 pa.array([math.fsum(base[lo:hi]) for lo, hi in spans], pa.float64()),
                 pa.array([data[lo:hi].tobytes() for lo, hi in spans], pa.binary())],
                [*kept, "n_tokens", "n_known", "base_score", "numbers"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept),
                        "n_tokens long, n_known long, base_score double, numbers binary"])
    return materialise(docs.mapInArrow(run, schema), "lm_numbers")


def extended(numbers: DataFrame, model: Model, order: int = 3, key_bits: int = 64) -> Model:
    """``model`` with the further levels, from the word numbers of its training
    texts; its longest context is ``order`` - 1 tokens. A level has as many
    shards as its keys need to fit ``key_bits`` bits."""
    shards = int(numbers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbers = numbers.select("numbers")
    above = model.begin + 1
    for level in range(2, order + 1):
        room = 1 << max(0, key_bits - model.bits)  # contexts that a shard can tell apart
        model.further += (_further(numbers, model, level, max(shards, -(-above // room))),)
        above = sum(model.further[-1])
    return model


def _further(numbers: DataFrame, model: Model, level: int, shards: int) -> tuple[int, ...]:
    """Writes a level below those of ``model``; the pairs of each shard."""
    folder, bits = model.folder, model.bits

    def pair_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        number, sizes = model.numbers_of(column)
        context, _ = model.contexts(number, sizes)
        seen = context >= 0  # all but the first tokens of a text, which have no longer context
        context, number = context[seen], number[seen].astype(np.uint64)
        local, shard = dealt(context, shards)
        return local.astype(np.uint64) << np.uint64(bits) | number, shard

    merged, path, made = _merged(_ship(numbers, pair_keys, shards, NUMBERS), shards, "lm_followers")
    once, twice = (sum(r[c] for r in made) for c in ("once", "twice"))
    # one discount for the level, however many shards it has
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5

    def followers(shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
        write_file(folder, f"followers-{level}-{shard:05d}.ef", Followers.build(keys, counts, bits, discount))

    _written(merged, path, followers)
    size = {r["shard"]: r["types"] for r in made}
    return tuple(size.get(k, 0) for k in range(shards))


def scored(numbers: DataFrame, model: Model) -> DataFrame:
    """The columns of ``numbered`` but numbers, with train_tokens and score."""
    kinds = {f.name: f.dataType.simpleString() for f in numbers.schema.fields}
    kept = numbers.columns[:-1]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = model.total
        unknown = (model.once + 1) / (n + 2)
        for b in bounded(rows, len(kept), NUMBERS):
            number, sizes = model.numbers_of(b.column(len(kept)))
            _, shares = model.contexts(number, sizes)
            word = np.where(number >= 0, (1 - unknown) * model.vocabulary.counts(number) / max(1, n), unknown)
            for a, back in shares:
                word = a + back * word
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(kept))), pa.array(np.full(len(sizes), n, np.int64)),
                 pa.array(np.add.reduceat(np.log10(word), np.cumsum(sizes) - sizes))],
                [*kept, "train_tokens", "score"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "train_tokens long, score double"])
    return numbers.mapInArrow(run, schema)


def language_model_scores(docs: DataFrame, held_out: Column, order: int = 3, key_bits: int = 64) -> DataFrame:
    """Scores of every document by a model, of this order, of those that are not
    ``held_out``."""
    rows = doc_text(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = vocabulary(rows.filter("not held_out").select("text"))
    numbers = numbered(rows, model)
    extended(numbers.filter("not held_out"), model, order, key_bits)
    return scored(numbers, model).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
