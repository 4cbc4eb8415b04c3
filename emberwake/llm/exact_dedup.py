"""Exact duplicates by a tree-merge of sorted digest runs.

1. Each scan task turns its documents into rows (row, doc_id, digest, size) and
   these are kept as a narrow table: texts are read once.
2. Each task sorts its digests into a run with one entry per digest: the best
   row (largest doc_id) and the number of copies.
3. The runs are exchanged in binomial rounds. With 2**m partitions, a round
   settles the next ``fan_bits`` bits of a partition's number: an entry moves to
   the partition whose number agrees with its digest in those bits, so each
   partition merges the 2**fan_bits sorted runs of its peers (Spark's external
   sort does the merge and spills) and keeps one entry per digest. After all
   rounds a digest has one entry. A group of copies shrinks to one entry per
   partition at every level, whatever its size, and no partition ever holds
   more than its share.
4. Groups of several are joined to the narrow table; adaptive execution splits
   a digest that holds many rows.

Entries are equal only if the SHA-256 digest and the byte length both agree.

Cases: null text counts as empty; null doc_id ranks below any other; of rows
with equal text and equal doc_id the first row in storage stays; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwake.llm.common import doc_text, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENTRY = ["digest", "size", "doc_id", "row", "copies"]


def digest_table(docs: DataFrame) -> DataFrame:
    """row, doc_id, digest, size of every document, in a table of its own."""
    source = doc_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for b in rows:
            texts = pc.ascii_lower(pc.fill_null(b.column(1), "")).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(texts))), b.column(0),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([len(t) for t in texts], pa.int64())], ["row", "doc_id", "digest", "size"])
            row += len(texts)

    return materialise(source.mapInArrow(run, f"row long, doc_id {kind}, digest binary, size long"), "digests")


def _sorted(df: DataFrame) -> DataFrame:
    """Entries of a digest lie together, the one to keep first."""
    return df.sortWithinPartitions("digest", "size", F.col("doc_id").desc_nulls_last(), "row")


def _merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per digest of a sorted stream: the first, with all copies."""
    held: pa.RecordBatch | None = None  # the last group so far, as one row
    for b in rows:
        if not b.num_rows:
            continue
        b = pa.RecordBatch.from_arrays(b.columns, names=b.schema.names)  # the nullability flags differ
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        digest, size = b.column("digest"), b.column("size")
        new = np.ones(b.num_rows, bool)
        if b.num_rows > 1:
            new[1:] = pc.or_(pc.not_equal(digest[1:], digest[:-1]), pc.not_equal(size[1:], size[:-1])) \
                .to_numpy(zero_copy_only=False)
        first = np.flatnonzero(new)
        copies = np.add.reduceat(b.column("copies").to_numpy(), first)
        out = b.take(pa.array(first)).set_column(b.schema.get_field_index("copies"), "copies", pa.array(copies))
        held = out.slice(out.num_rows - 1)
        if out.num_rows > 1:
            yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def _slot(bits: int) -> Column:
    """The first ``bits`` bits of the digest."""
    return F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long").bitwiseAND((1 << bits) - 1)


def merged_runs(digests: DataFrame, fan_bits: int = 4) -> DataFrame:
    """One entry per distinct text: digest, size, doc_id, row, copies."""
    spark = digests.sparkSession
    bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    schema = ", ".join(f"{n} {digests.schema[n].dataType.simpleString()}" for n in ENTRY[:4]) + ", copies long"
    runs = _sorted(digests.withColumn("copies", F.lit(1).cast("long")).select(ENTRY)).mapInArrow(_merge, schema)
    runs = runs.withColumn("at", F.spark_partition_id().cast("long").bitwiseAND((1 << bits) - 1))
    for low in range(0, bits, fan_bits):
        mask = (1 << min(low + fan_bits, bits)) - (1 << low)
        at = F.col("at").bitwiseAND(~mask).bitwiseOR(_slot(bits).bitwiseAND(mask))
        runs = runs.withColumn("at", at).repartitionById(1 << bits, F.col("at").cast("int"))
        runs = _sorted(runs).mapInArrow(_merge, schema + ", at long")
    return runs.select(ENTRY)


def exact_duplicates(docs: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256
    (and row, its number in the digest table)."""
    digests = digests if digests is not None else digest_table(docs)
    groups = (merged_runs(digests).filter("copies > 1")
              .select("digest", "size", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "copies"))
    alone = F.col("copies").isNull()
    return digests.join(groups, ["digest", "size"], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns."""
    digests = digest_table(docs)
    verdict = materialise(exact_duplicates(docs, digests), "exact_verdict")
    gone = verdict.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    out = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
    # an id on several rows does not tell which row goes: judge those by text
    shared = digests.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_shared"))
    if shared.isEmpty():
        return out
    several = F.col("doc_id").eqNullSafe(F.col("_shared"))
    text = F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).cast("binary"), 256)
    keep = verdict.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    chosen = (docs.join(shared, several, "left_semi")
              .withColumn("_text_sha", text)
              .join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_sha") == F.col("_sha")), "left_semi")
              .dropDuplicates(["doc_id", "_text_sha"]).drop("_text_sha"))
    return out.join(shared, several, "left_anti").unionByName(chosen)
