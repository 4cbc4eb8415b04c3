"""Gradient-boosted tree classifier on Spark ML.

The everyday path: Spark's own ``GBTClassifier`` (first-order boosting,
distributed tree growth). For the second-order fit with the reference's
parameter meaning (eta, lambda, min child weight), see
:mod:`emberwake.operators.newton`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwake.session import scratch_path

#: Bytes of kept training rows that a task reads, about; and what a row takes
#: there beside its features, which are kept as bin numbers of 4 bytes.
TASK_BYTES, ROW_BYTES = 1 << 28, 192


@dataclass(frozen=True)
class BoostParams:
    """Parameter map (M1): eta, max depth, objective, rounds."""
    eta: float = 0.1
    max_depth: int = 2
    objective: str = "binary:logistic"
    rounds: int = 100
    max_bins: int = 32
    seed: int = 42

    def estimator(self, label: str = "label", features: str = "features") -> GBTClassifier:
        if self.objective != "binary:logistic":
            raise ValueError(f"Unsupported objective {self.objective}")
        return GBTClassifier(labelCol=label, featuresCol=features, stepSize=self.eta,
                             maxDepth=self.max_depth, maxIter=self.rounds, lossType="logistic",
                             maxBins=self.max_bins, seed=self.seed)


def even_parts(data: DataFrame, features: str = "features") -> DataFrame:
    """``data`` dealt over more partitions where the largest it has would be
    more than ``TASK_BYTES`` of kept rows; otherwise as it is.

    The fit keeps every partition as objects and a task of each round reads one
    whole. A scan splits files by their bytes, which says little of that: narrow
    columns of a well packed file are many rows.
    """
    held = (data.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count("part").alias("parts"), F.sum("n").alias("rows"), F.max("n").alias("largest")).first())
    if not held["rows"]:
        return data
    width = data.select(F.size(vector_to_array(features)).alias("n")).first()["n"]
    row = ROW_BYTES + 4 * max(width or 0, 0)
    if held["largest"] * row <= TASK_BYTES:
        return data
    return data.repartition(max(held["parts"], math.ceil(held["rows"] * row / TASK_BYTES)))


def fit_boosted(df: DataFrame, params: BoostParams = BoostParams(), workers: int | None = None,
                spill: bool = False, label: str = "label",
                features: str = "features") -> GBTClassificationModel:
    """Train (M2). ``workers`` sets the partition count (M6), which follows the
    rows otherwise; ``spill`` keeps the training input on disk instead of memory
    (the external-memory mode)."""
    data = df.select(label, features)
    data = data.repartition(int(workers)) if workers else even_parts(data, features)
    if spill:
        data = data.persist(StorageLevel.DISK_ONLY)
    try:
        return params.estimator(label, features).fit(data)
    finally:
        if spill:
            data.unpersist()


def predict(model: GBTClassificationModel, df: DataFrame, features_only: bool = False) -> DataFrame:
    """Score a table (M4) or only its feature column."""
    if features_only:
        df = df.select(model.getFeaturesCol())
    return model.transform(df)


def feature_score(spark: SparkSession, model: GBTClassificationModel) -> DataFrame:
    """Number of splits per feature over all trees (M5).

    The model is saved below the shared folder and its node table read back as
    a DataFrame; internal nodes (``leftChild >= 0``) are grouped by split
    feature. (``featureImportances`` is gain-based, a different number.)
    """
    path = scratch_path(spark, "gbt_model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    return (nodes.filter(F.col("nodeData.leftChild") >= 0)
            .groupBy(F.col("nodeData.split.featureIndex").alias("feature"))
            .agg(F.count(F.lit(1)).alias("splits")))
