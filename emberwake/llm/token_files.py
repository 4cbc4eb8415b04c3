"""Token ids of a corpus as patched frame-of-reference files, in id order.

1. Percentiles of ``doc_id`` (one scan of that column) cut the id range into
   as many files as the session has shuffle partitions.
2. Texts are encoded where they are read; only the ids, two bytes each for a
   vocabulary below 65,536, are shuffled to their file and sorted by doc_id.
3. Each task writes its file into the shared folder (a temporary name, then a
   rename, so a repeated attempt replaces like with like) and returns the
   directory rows: which document lies where.
4. Documents are read back from the files through the block index.

Cases: null text is empty and yields the end id alone; a null doc_id sorts
first; rows of equal doc_id lie side by side, ordered by their ids; an empty
table writes no file; other columns are ignored. ``doc_id`` must be numeric.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emberwake.llm import pfor
from emberwake.llm.common import batches, doc_text, materialise, store_of
from emberwake.llm.pieces import PieceEncoder
from emberwake.session import scratch_path

#: Pieces a worker remembers before it starts anew.
LIMIT = 600_000


class FastTokenizer:
    """The library's byte-level tokenizer over remembered pieces. A string of an
    added token in a text is that token, as in the library; it holds no space,
    so a piece holds it whole."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = id_type(max(vocabulary.values(), default=0))
        #: in this alphabet a character of a token is a byte of the text
        self.size = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, k in vocabulary.items():
            self.size[k] = len(token)
        self.pieces = PieceEncoder(self._encode_pieces, LIMIT)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """One call for all pieces; token sizes tell where each ends."""
        text = "".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.cumsum(list(map(len, pieces if text.isascii() else [p.encode() for p in pieces])))
        reached = np.cumsum(self.size[ids])
        stop = (np.searchsorted(reached, ends, side="right") * ids.itemsize).tolist()
        data = ids.tobytes()
        return [data[at:k] for at, k in zip([0, *stop], stop)]

    def encode(self, text: str) -> bytes:
        return self.pieces(text)


def id_type(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def fast_tokenizer(path: str) -> FastTokenizer:
    return FastTokenizer(path)


def _bounds(docs: DataFrame, files: int) -> list:
    """At most ``files`` - 1 ascending ids that part the rows evenly."""
    if files < 2:
        return []
    cuts = [k / files for k in range(1, files)]
    row = docs.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * files)).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def write_token_files(docs: DataFrame, path: str, end_id: int, folder: str | None = None,
                      files: int | None = None) -> tuple[str, DataFrame]:
    """Write every document's ids plus ``end_id``; returns the folder and the
    directory: file int, doc_id, at long (ids before it in its file), n_tokens long."""
    spark = docs.sparkSession
    source = doc_text(docs)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs.select("doc_id"), files)
    folder = folder or scratch_path(spark, "token_files")
    id_kind = source.schema["doc_id"].dataType.simpleString()

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = fast_tokenizer(path)
        end = np.array([end_id], tokenizer.dtype).tobytes()
        for doc_id, texts in batches(rows):
            place = [0 if d is None else bisect_right(bounds, d) for d in doc_id.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int32()), doc_id,
                 pa.array([tokenizer.encode(t) + end for t in texts], pa.binary())],
                ["file", "doc_id", "ids"])

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = fast_tokenizer(path).dtype
        store, root = store_of(folder)
        store.create_dir(root)
        now = writer = temporary = None

        def finish() -> None:
            writer.close()
            writer.out.close()
            store.move(temporary, f"{root}/part-{now:06d}.pfor")

        for b in rows:
            at, sizes = [], []
            for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k != now:
                    if writer:
                        finish()
                    now = k
                    temporary = f"{root}/.part-{k:06d}-{TaskContext.get().taskAttemptId()}"
                    writer = pfor.Writer(store.open_output_stream(temporary))
                ids = np.frombuffer(ids, dtype)
                at.append(writer.total)
                sizes.append(len(ids))
                writer.write(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(at, pa.int64()), pa.array(sizes, pa.int64())],
                ["file", "doc_id", "at", "n_tokens"])
        if writer:
            finish()

    directory = (source.mapInArrow(encode, f"file int, doc_id {id_kind}, ids binary")
                 .repartitionById(len(bounds) + 1, F.col("file"))
                 .sortWithinPartitions("file", "doc_id", "ids")
                 .mapInArrow(write, f"file int, doc_id {id_kind}, at long, n_tokens long"))
    return folder, materialise(directory, "token_directory")


def read_token_files(folder: str, directory: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 from the files themselves."""
    id_kind = directory.schema["doc_id"].dataType.simpleString()

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        now = reader = None
        for b in rows:
            sizes, crcs = [], []
            for k, at, n in zip(*(b.column(c).to_pylist() for c in (0, 2, 3))):
                if k != now:
                    now, name = k, f"{root}/part-{k:06d}.pfor"
                    reader = pfor.Reader(store.open_input_file(name), store.get_file_info(name).size)
                ids = reader.read(at, n)
                sizes.append(len(ids))
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())],
                ["file", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = directory.mapInArrow(read, f"file int, doc_id {id_kind}, at long, n_tokens long, ids_crc32 long")
    # one row per file: bounded by the number of files, not of documents
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = (directory.groupBy("file").agg(F.sum("n_tokens").alias("n"))
              .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    return (found.join(starts, "file")
            .select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
