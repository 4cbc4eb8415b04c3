"""Patched frame-of-reference files of unsigned 32-bit ids.

A file is a run of blocks, an index, and a footer (all little-endian):

* block: ``<I B H H`` minimum, bit width, number of ids, number of exceptions;
  the ids minus the minimum packed at that width (exceptions as 0); then the
  exceptions' positions (uint16) and their values minus the minimum (uint32);
* index: the byte position of every block (uint64);
* footer: ``<Q Q Q 4s`` number of ids, ids per block, index position, magic.

The width is the one that the ``percentile`` of a block's values needs, so a
few large ids cost 6 bytes each instead of widening the block. Every block but
the last holds the same number of ids, so id k is in block k // per_block.
"""

from __future__ import annotations

import struct
from typing import BinaryIO

import numpy as np

MAGIC = b"PFR1"
HEAD, FOOT = struct.Struct("<IBHH"), struct.Struct("<QQQ4s")
PER_BLOCK, PERCENTILE = 8192, 95


def pack(values: np.ndarray, width: int) -> bytes:
    """``values`` below 2**width, most significant bit first."""
    if not width:
        return b""
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width:]).tobytes()


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - width:] = bits
    return np.packbits(wide, axis=1).view(">u4").reshape(n).astype(np.uint32)


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    base = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(base)
    kth = min(len(rest) - 1, int(len(rest) * percentile / 100))
    width = int(np.partition(rest, kth)[kth]).bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    values = rest[odd]
    rest[odd] = 0
    return b"".join([HEAD.pack(base, width, len(ids), len(odd)), pack(rest, width),
                     odd.astype("<u2").tobytes(), values.astype("<u4").tobytes()])


def decode_block(data: bytes) -> np.ndarray:
    base, width, n, odd = HEAD.unpack_from(data)
    at = HEAD.size + (n * width + 7) // 8
    out = unpack(data[HEAD.size:at], width, n)
    if odd:
        out[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return out + np.uint32(base)


class Writer:
    """Appends ids to a file; holds one block at a time."""

    def __init__(self, out: BinaryIO, per_block: int = PER_BLOCK, percentile: float = PERCENTILE):
        if not 0 < per_block < 1 << 16:
            raise ValueError("a block holds 1 to 65535 ids")
        self.out, self.per_block, self.percentile = out, per_block, percentile
        self.waiting: list[np.ndarray] = []
        self.held = self.total = self.at = 0
        self.starts: list[int] = []

    def write(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.per_block:
            ids = np.concatenate(self.waiting)
            full = len(ids) // self.per_block * self.per_block
            for k in range(0, full, self.per_block):
                self._block(ids[k:k + self.per_block])
            self.waiting, self.held = [ids[full:]], len(ids) - full

    def _block(self, ids: np.ndarray) -> None:
        data = encode_block(ids, self.percentile)
        self.starts.append(self.at)
        self.at += len(data)
        self.out.write(data)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(FOOT.pack(self.total, self.per_block, self.at, MAGIC))


class Reader:
    """Reads any span of ids; keeps the last block it decoded."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - FOOT.size)
        self.total, self.per_block, at, magic = FOOT.unpack(source.read(FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a file of this format")
        source.seek(at)
        starts = np.frombuffer(source.read(size - FOOT.size - at), "<u8").tolist()
        self.starts = [*starts, at]
        self.block, self.ids = -1, np.zeros(0, np.uint32)

    def _load(self, block: int) -> np.ndarray:
        if block != self.block:
            self.source.seek(self.starts[block])
            self.ids = decode_block(self.source.read(self.starts[block + 1] - self.starts[block]))
            self.block = block
        return self.ids

    def read(self, start: int, n: int) -> np.ndarray:
        if start < 0 or n < 0 or start + n > self.total:
            raise ValueError("span outside the file")
        out, at, end = [], start, start + n
        while at < end:
            block, skip = divmod(at, self.per_block)
            part = self._load(block)[skip:skip + end - at]
            out.append(part)
            at += len(part)
        return np.concatenate(out) if out else np.zeros(0, np.uint32)
