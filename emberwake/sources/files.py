"""File listings as tables.

``list_files`` is a ``binaryFile`` scan of metadata columns alone: any Hadoop
file system, with Spark's file index held by the driver. ``list_tree`` lists a
tree of folders in tasks, level by level, and is for trees of many files.
"""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwake.session import scratch_path

ENTRIES = pa.schema([("path", pa.string()), ("name", pa.string()), ("is_folder", pa.bool_()),
                     ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64())])
#: Entries of one Arrow batch of a listing.
BATCH = 4096


def list_files(spark: SparkSession, folder: str, glob: str = "*",
               recursive: bool = True) -> DataFrame:
    """``path, name, modified, length`` for files under ``folder`` matching ``glob``."""
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", recursive)
            .load(folder)
            .select("path",
                    F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                    F.col("modificationTime").alias("modified"),
                    "length"))


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def list_tree(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path`` (below ``folder``), ``name, modified, length`` of all files in the
    tree under ``folder`` whose name matches ``glob`` (case counts).

    The folders of a level are dealt to tasks, each of which lists its own; the
    entries are written as a table whose folders are the next level, until none
    is left. A task holds the entries of one folder, the driver a number per
    level. Names that begin with ``_`` or ``.`` are passed over with all below
    them, as Spark's own readers do. A folder that goes away while the tree is
    listed counts as empty; a missing ``folder`` is an error; an empty one gives
    no rows.
    """
    store, root = _store(folder)
    if store.get_file_info(root).type != fs.FileType.Directory:
        raise FileNotFoundError(f"not a folder: {folder}")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for b in rows:
            for below in b.column(0).to_pylist():
                found = store.get_file_info(fs.FileSelector(f"{root}/{below}".rstrip("/"), allow_not_found=True))
                kept = [{"path": f"{below}/{e.base_name}".lstrip("/"), "name": e.base_name, "is_folder": is_folder,
                         "modified": e.mtime, "length": None if is_folder else e.size}
                        for e in found for is_folder in [e.type == fs.FileType.Directory]
                        if e.base_name[0] not in "_." and (is_folder or fnmatchcase(e.base_name, glob))]
                for lo in range(0, len(kept), BATCH):
                    yield pa.RecordBatch.from_pylist(kept[lo:lo + BATCH], ENTRIES)

    columns = "path string, name string, is_folder boolean, modified timestamp, length long"
    out, level = scratch_path(spark, "tree"), 0
    folders = spark.range(1).select(F.lit("").alias("path"))
    while True:
        folders.mapInArrow(run, columns).write.parquet(f"{out}/level={level}")
        entries = spark.read.schema(columns).parquet(f"{out}/level={level}")
        below = entries.filter("is_folder").select("path")
        if below.isEmpty():
            break
        folders, level = below.repartition("path"), level + 1
    return (spark.read.schema(columns).parquet(*[f"{out}/level={k}" for k in range(level + 1)])
            .filter("not is_folder").select("path", "name", "modified", "length"))
