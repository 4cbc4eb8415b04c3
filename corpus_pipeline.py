"""A training-corpus pipeline: five stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emberwake.llm.byte_bpe import bpe_round_trip
from emberwake.llm.common import materialise, reachable, table
from emberwake.llm.decontaminate import drop_contaminated
from emberwake.llm.exact_dedup import drop_exact_duplicates
from emberwake.llm.partenum import drop_similar
from emberwake.llm.toxicity import drop_toxic


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon, learned from all labels, accepts."""
    reachable(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id."""
    reachable(spark)
    return drop_exact_duplicates(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with
    the smallest id."""
    reachable(spark)
    return drop_similar(docs, width=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    reachable(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document that is left, checked by decoding."""
    reachable(spark)
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                          ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", keep_clean),
    ("exact_dedup", one_of_equal),
    ("ngram_jaccard", one_of_similar),
    ("decontamination", without_benchmark),
    ("byte_bpe", encode),
]

#: Toxicity scores, the similarity join and BPE have no SQL form; tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each materialised before the next."""
    reachable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
