"""Helpers shared by the operators of this subpackage.

``materialise`` is the one way lineage is cut here: a Parquet table in the
folder the cluster names in ``spark.checkpoint.dir``. A lost executor costs
the tasks it ran, not the table.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back."""
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``materialise``, with the folder, for tables that are discarded once
    another table holds what is needed of them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``stored`` made."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def doc_text(docs: DataFrame, *more: str) -> DataFrame:
    """The two columns the text operators read; any others, whatever their
    names, are pruned from the scan."""
    return docs.select("doc_id", "text", *more)


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(doc_id column, texts with null as empty) of each non-empty batch."""
    for b in rows:
        if b.num_rows:
            yield b.column(0), [t or "" for t in b.column(1).to_pylist()]


def bounded(rows: Iterator[pa.RecordBatch], column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, so that what a
    worker builds from a slice does not grow with the batch. A longer text is a
    slice of its own; no text is cut."""
    for b in rows:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < b.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield b.slice(start, stop - start)
            start = stop


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, whose task hands the memory it no longer uses back to the system
    at its end: a worker lives on and runs the tasks of later stages."""
    def held(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(rows)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps the memory
                ctypes.CDLL(None).malloc_trim(0)
    return held


def crc_mod(doc_id, divisor: int):
    """crc32 of the id's decimal text modulo ``divisor`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def reachable(spark: SparkSession) -> None:
    """Let Python workers on the driver's machine import this package from
    where the driver did. Clusters ship it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file in the shared storage."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_file(folder: str, name: str, data: bytes) -> None:
    """Whole or not at all: a temporary name, then a rename. A repeated task
    attempt replaces the file by an equal one."""
    store, root = store_of(folder)
    store.create_dir(root)
    temporary = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        out.write(data)
    store.move(temporary, f"{root}/{name}")


def map_file(folder: str, name: str) -> pa.Buffer:
    """A file's content: memory-mapped where the storage is mounted."""
    store, root = store_of(folder)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(f"{root}/{name}").read_buffer()
    with store.open_input_file(f"{root}/{name}") as source:
        return source.read_buffer()
