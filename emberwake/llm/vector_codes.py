"""Product codes of vectors, by integer Walsh-Hadamard transforms.

Vectors are cut into equal consecutive parts, and each part position has a
codebook. Parts and entries, padded with zeros to a power of two w, are
transformed by the matrix of signs alone, so w times a squared distance is the
sum of squared differences of the coefficients: no rounding anywhere.

1. The codebooks start as the parts of the vectors with the smallest ids (at
   most ``entries`` rows reach the driver).
2. Each round is one scan of the vector column. Tasks find every part's nearest
   entry, sum the parts of each entry, and ship one row per part and entry;
   Spark adds them, and parts x entries rows reach the driver. Codebooks are
   the only thing broadcast; their size does not depend on the input.
3. The last scan writes the codes to a narrow table in the shared folder.

The nearest entry: squared differences are accumulated in sequency order (rows
of the matrix by their sign changes). After the first quarter of the coefficients
the entry ahead gives an upper bound, its whole distance, and the one ahead half
way may lower it; after each step entries beyond the bound are dropped, those
equal to it stay, and of the ones that reach the end the nearest with the lowest
number wins.

Cases: rows whose vector is null, has another number of components than
``dims``, or holds a null or non-finite component are dropped; fewer vectors
than entries give fewer entries; of rows with one id, or none (these come last),
the smaller vector comes first; repeated rows count each time; a null label is a
label; a table without a label column has null labels; sums that a long cannot
hold are null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import materialise
from emberwake.llm.vectors import group_sums, integers, longs, magnitude, scaled, squared, valid, with_total

#: Vectors compared with all entries at a time, while more than one entry in
#: ``FEW`` is left; then each pair of a vector and an entry is taken by itself.
BLOCK, FEW = 512, 12


@lru_cache(maxsize=8)
def sequency_order(width: int) -> np.ndarray:
    """Rows of the natural-order matrix by their number of sign changes."""
    signs = transform(np.eye(width, dtype=np.int64), ordered=False)
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray, ordered: bool = True) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, zero-padded to a power of two,
    by sequency."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), width), x.dtype)
    out[:, :x.shape[1]] = x
    half = 1
    while half < width:
        pairs = out.reshape(len(x), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), width)
        half *= 2
    return out[:, sequency_order(width)] if ordered else out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, width * squared distance) of each row of coefficients ``x``;
    of entries equally near, the lowest."""
    width = x.shape[1]
    first, step = max(1, width // 4), max(1, width // 8)
    by_place = np.ascontiguousarray(entries.T)
    best, least = [], []
    for lo in range(0, len(x), BLOCK):
        part = x[lo:lo + BLOCK]
        total = np.zeros((len(part), len(entries)), x.dtype)
        d = np.empty_like(total)
        j, row, bound = 0, None, None
        while j < width:
            stop = min(width, j + (step if j else first))
            if row is None:  # all entries of the block
                for k in range(j, stop):
                    np.subtract(part[:, k, None], by_place[k], out=d)
                    np.multiply(d, d, out=d)
                    np.add(total, d, out=total)
                if bound is None or 2 * stop == width:
                    ahead = squared(part - entries[total.argmin(axis=1)])
                    bound = ahead if bound is None else np.minimum(bound, ahead)
                stays = total <= bound[:, None]
                if stop == width or np.count_nonzero(stays) * FEW < stays.size:
                    row, col = np.nonzero(stays)
                    total = total[row, col]
            else:  # the few that are left
                total = total + squared(part[row, j:stop] - entries[col, j:stop])
                stays = total <= bound[row]
                row, col, total = row[stays], col[stays], total[stays]
            j = stop
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        smallest = np.minimum.reduceat(total, head)
        # entries of a row ascend: the first of its smallest is the lowest
        hit = np.flatnonzero(total == np.repeat(smallest, np.diff(head, append=len(row))))
        own = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]
        best.append(col[own])
        least.append(smallest)
    return np.concatenate(best), np.concatenate(least)


class Codebooks:
    """Integer entries per part, with their transforms."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        self.dims = len(entries) * len(entries[0][0])
        self.largest = max(abs(v) for book in entries for e in book for v in e)

    def coded(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(integer parts, codes, squared distances by part) of rows of
        ``scaled`` components."""
        books = len(self.entries)
        size = self.dims // books
        width = 1 << max(0, size - 1).bit_length()
        # all coefficients' squares sum to width times those of the components
        whole = integers(x, max(magnitude(x), float(self.largest)), width * size)
        parts = [whole[:, k * size:(k + 1) * size] for k in range(books)]
        found = [nearest(transform(p), transform(np.array(book, dtype=whole.dtype)))
                 for p, book in zip(parts, self.entries)]
        return parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] // width for f in found], axis=1)

    def updated(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Entries replaced by the floor of the mean of their parts."""
        return Codebooks([[[s // sums[k, e][0] for s in sums[k, e][1]] if (k, e) in sums else entry
                           for e, entry in enumerate(book)] for k, book in enumerate(self.entries)])

    def sha256(self) -> str:
        text = ",".join(str(v) for book in self.entries for entry in book for v in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def _first_books(vectors: DataFrame, dims: int, parts: int, entries: int, scale: int) -> Codebooks | None:
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not rows:
        return None
    x = scaled(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), dims, scale)
    size = dims // parts
    whole = [[int(v) for v in row] for row in x.tolist()]
    return Codebooks([[row[k * size:(k + 1) * size] for row in whole] for k in range(parts)])


def _sums(vectors: DataFrame, books: Codebooks, scale: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and sum of the parts of each (part position, entry) in use."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    size = books.dims // len(books.entries)
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.decimal128(38, 0)] * size]
    names = ["part", "entry", "n", *(f"s{j}" for j in range(size))]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list] = {}
        for b in rows:
            if not b.num_rows:
                continue
            parts, codes, _ = shared.value.coded(scaled(b.column(0), shared.value.dims, scale))
            for k, part in enumerate(parts):
                for e, n, s in zip(*(v.tolist() for v in group_sums(part, codes[:, k]))):
                    held = totals.setdefault((k, e), [0, [0] * size])
                    held[0] += n
                    held[1] = [p + q for p, q in zip(held[1], s)]
        columns = list(zip(*((*key, n, *s) for key, (n, s) in totals.items()))) or [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    schema = "part int, entry int, n long, " + ", ".join(f"s{j} decimal(38,0)" for j in range(size))
    sums = (vectors.select("vector").mapInArrow(run, schema).groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), *(F.sum(f"s{j}").cast("decimal(38,0)").alias(f"s{j}") for j in range(size)))
            .collect())  # parts x entries rows
    return {(r["part"], r["entry"]): (r["n"], [int(r[f"s{j}"]) for j in range(size)]) for r in sums}


def vector_codes(table: DataFrame, dims: int = 64, parts: int = 4, entries: int = 256, rounds: int = 4,
                 scale: int = 1024, vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """A table of vec_id, label, code, error; and the codebooks (none without
    vectors)."""
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("parts must divide the components; a code has two hex digits")
    labelled = F.col(label) if label in table.columns else F.lit(None).cast("int")
    source = table.filter(valid(F.col(vector), dims)).select("vec_id", labelled.alias("label"), F.col(vector).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    books = _first_books(source, dims, parts, entries, scale)
    if books is None:
        return table.sparkSession.createDataFrame([], schema), None
    for _ in range(rounds):
        books = books.updated(_sums(source, books, scale))
    shared = table.sparkSession.sparkContext.broadcast(books)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            if not b.num_rows:
                continue
            _, codes, distance = shared.value.coded(scaled(b.column(2), dims, scale))
            digits = codes.astype(np.uint8).tobytes().hex()
            code = [digits[2 * parts * k:2 * parts * (k + 1)] for k in range(b.num_rows)]
            total = distance.astype(object).sum(axis=1) if distance.dtype == object else distance.astype(np.int64).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code, pa.string()), longs(total)],
                                             ["vec_id", "label", "code", "error"])

    return materialise(source.mapInArrow(run, schema), "vector_codes"), books


def compressed_vectors(table: DataFrame, dims: int = 64) -> DataFrame:
    """One row per vector: vec_id, code, error, label_error, codebooks_sha256."""
    codes, books = vector_codes(table, dims)
    sha = books.sha256() if books else hashlib.sha256(b"").hexdigest()
    return with_total(codes, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
