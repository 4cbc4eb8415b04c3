"""Elias-Fano sequences and files of arrays that can be memory-mapped.

A sequence of n non-decreasing integers below u keeps the low bits of each,
packed, and its high part as a bit vector: the k-th value v sets bit
(v >> low) + k. Counts of ones and of zeros before each 64-bit word answer select
in a few vector operations for many queries at once.
"""

from __future__ import annotations

import json
import struct

import numpy as np

HEAD = struct.Struct("<4sI")
MAGIC = b"EFT1"
ONE = np.uint64(1)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """``values`` of ``width`` bits one after another, as 64-bit words."""
    bit = np.arange(len(values)) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    out = np.zeros((len(values) * width + 63) // 64 + 1, "<u8")
    head = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[head]] = np.bitwise_or.reduceat(values << shift, head)
    over = np.flatnonzero(shift + np.uint64(width) > np.uint64(64))  # at most one value reaches into a word
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out


def _select_table() -> np.ndarray:
    """Position of the one with a rank in a byte, at 8 * byte + rank."""
    bits = np.arange(256)[:, None] >> np.arange(8) & 1
    table = np.zeros((256, 8), np.uint8)
    byte, place = np.nonzero(bits)
    table[byte, (np.cumsum(bits, axis=1) - 1)[byte, place]] = place
    return table.reshape(-1)


SELECT = _select_table()
#: Masks of the counts of ones in pairs, fours and bytes of bits; a one in each byte.
PAIRS, FOURS, NIBBLES, EACH = map(
    np.uint64, (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x0101010101010101))
TOPS = np.uint64(0x8080808080808080)


def select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the one with this rank (from 0) in each word: the byte by
    sums over bytes, the bit in it by a table."""
    rank = rank.astype(np.uint64)
    ones = word - (word >> ONE & PAIRS)
    ones = (ones & FOURS) + (ones >> np.uint64(2) & FOURS)
    ones = (ones + (ones >> np.uint64(4)) & NIBBLES) * EACH  # byte k: ones up to and in byte k
    byte = np.bitwise_count((rank * EACH | TOPS) - ones & TOPS)
    place = np.minimum(byte, 7).astype(np.uint64) << np.uint64(3)
    before = ones << np.uint64(8) >> place & np.uint64(255)
    entry = (word >> place & np.uint64(255)) << np.uint64(3) | (rank - before) & np.uint64(7)
    return place.astype(np.int64) + SELECT[entry.astype(np.int64)]


class EliasFano:
    def __init__(self, n: int, low: int, lows: np.ndarray, upper: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.low, self.lows, self.upper, self.ones, self.zeros = n, low, lows, upper, ones, zeros
        #: the eight bytes from each byte of the low bits on
        self.from_byte = np.ndarray((8 * len(lows) - 7,), "<u8", lows, strides=(1,))

    @staticmethod
    def arrays(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        """The sequence as named arrays for a file."""
        n = len(values)
        u = int(values[-1]) + 1 if n else 1
        low = max(0, (u // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(low)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 2
        bits = np.zeros(-(-size // 64) * 64, bool)
        bits[high + np.arange(n)] = True
        upper = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper).astype(np.int64))])
        zeros = 64 * np.arange(len(ones)) - ones
        kind = "<u4" if len(bits) < 1 << 32 else "<u8"
        lows = pack_bits(values & np.uint64((1 << low) - 1), low) if low else np.zeros(2, "<u8")
        return {f"{name}.shape": np.array([n, low], "<i8"), f"{name}.lows": lows, f"{name}.upper": upper,
                f"{name}.ones": ones.astype(kind), f"{name}.zeros": zeros.astype(kind)}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, low = arrays[f"{name}.shape"].tolist()
        return cls(n, low, *(arrays[f"{name}.{part}"] for part in ("lows", "upper", "ones", "zeros")))

    def _lows(self, k: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(k), np.uint64)
        bit = k * self.low
        if self.low <= 57:  # eight bytes hold the value wherever it begins in the first
            return self.from_byte[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.low) - 1)
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.lows[word] >> shift
        spill = shift + np.uint64(self.low) > np.uint64(64)
        value |= np.where(spill, self.lows[word + 1] << (np.uint64(64) - np.where(spill, shift, ONE)), np.uint64(0))
        return value & np.uint64((1 << self.low) - 1)

    def access(self, k: np.ndarray) -> np.ndarray:
        """Values at the positions ``k``."""
        if not len(k):
            return np.zeros(0, np.uint64)
        # in the directory's own type, which would else be converted whole
        word = np.searchsorted(self.ones, k.astype(self.ones.dtype), side="right") - 1
        at = 64 * word + select_in_word(self.upper[word], k - self.ones[word].astype(np.int64))
        return (at - k).astype(np.uint64) << np.uint64(self.low) | self._lows(k)

    def _start(self, high: np.ndarray) -> np.ndarray:
        """The bit after zero number ``high - 1``, where the values with this
        high part begin."""
        start = np.zeros(len(high), np.int64)
        some = np.flatnonzero(high > 0)
        zero = high[some] - 1
        word = np.searchsorted(self.zeros, zero.astype(self.zeros.dtype), side="right") - 1
        word = np.minimum(word, len(self.upper) - 1)
        start[some] = 64 * word + select_in_word(~self.upper[word], zero - self.zeros[word].astype(np.int64)) + 1
        return start

    def _run(self, start: np.ndarray) -> np.ndarray:
        """How many ones follow one another from bit ``start``, 64 at most."""
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        last = len(self.upper) - 1
        beyond = word > last
        bits = np.where(beyond, np.uint64(0), self.upper[np.minimum(word, last)] >> shift)
        more = np.where((shift > 0) & (word < last), self.upper[np.minimum(word + 1, last)], np.uint64(0))
        bits |= more << (np.uint64(64) - np.maximum(shift, ONE))
        return np.bitwise_count(bits & ~(bits + ONE)).astype(np.int64)

    def find(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Position of the first value not below each of ``values`` within
        [lo, hi) if it equals it, else -1."""
        if not self.n or not len(values):
            return np.full(len(values), -1, np.int64)
        top = int(self.zeros[-1])  # zeros there are; the last is behind the last value
        high = np.minimum(values >> np.uint64(self.low), np.uint64(top)).astype(np.int64)
        start = self._start(high)
        left = start - high
        size = self._run(start)
        many = np.flatnonzero(size == 64)
        size[many] = self._start(np.minimum(high[many] + 1, top)) - 1 - start[many]
        right = left + size
        if lo is not None:
            left, right = np.maximum(left, lo), np.minimum(right, hi)
        end = right.copy()
        want = values & np.uint64((1 << self.low) - 1)
        live = np.flatnonzero(left < right)
        while len(live):
            middle = (left[live] + right[live]) >> 1
            less = self._lows(middle) < want[live]
            left[live] = np.where(less, middle + 1, left[live])
            right[live] = np.where(less, right[live], middle)
            live = live[left[live] < right[live]]
        inside = np.flatnonzero(left < end)
        hit = inside[self._lows(left[inside]) == want[inside]]
        out = np.full(len(values), -1, np.int64)
        out[hit] = left[hit]
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """A file of arrays, each aligned to 64 bytes."""
    index, at, parts = {}, 0, []
    for name, a in arrays.items():
        index[name] = [a.dtype.str, at, len(a)]
        data = a.tobytes()
        parts += [data, bytes(-len(data) % 64)]
        at += len(data) + -len(data) % 64
    head = json.dumps(index).encode()
    head += b" " * (-(HEAD.size + len(head)) % 64)
    return b"".join([HEAD.pack(MAGIC, len(head)), head, *parts])


def from_buffer(buffer) -> dict[str, np.ndarray]:
    """The arrays of such a file, without copying."""
    view = memoryview(buffer)
    magic, size = HEAD.unpack_from(view)
    if magic != MAGIC:
        raise ValueError("not a file of this format")
    index = json.loads(bytes(view[HEAD.size:HEAD.size + size]))
    first = HEAD.size + size
    return {name: np.frombuffer(view, kind, count, first + at) for name, (kind, at, count) in index.items()}
