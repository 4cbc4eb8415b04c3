"""Labelled points: label + dense feature vector."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_SCHEMA = T.StructType([
    T.StructField("label", T.DoubleType()),
    T.StructField("features", VectorUDT()),
])

# The reference's toy training set, 13 points in 4 partitions
# (label, features) in their original order.
TOY_POINTS = [
    (1.0, [2.0, 3.0, 4.0]),
    (0.0, [5.0, 5.0, 5.0]),
    (1.0, [2.0, 3.0, 4.0]),
    (0.0, [5.0, 5.0, 5.0]),
    (1.0, [2.0, 3.0, 4.0]),
    (0.0, [5.0, 5.0, 5.0]),
    (1.0, [2.0, 3.0, 4.0]),
    (0.0, [5.0, 5.0, 5.0]),
    (1.0, [2.0, 3.0, 4.0]),
    (0.0, [5.0, 5.0, 5.0]),
    (1.0, [2.0, 3.0, 4.0]),
    (1.0, [2.0, 3.0, 4.0]),
    (0.0, [5.0, 5.0, 5.0]),
]


def labelled_points(spark: SparkSession, points=None, n: int = 4) -> DataFrame:
    """Literal rows + explicit schema -> table in ``n`` partitions."""
    rows = [(float(lbl), DenseVector(v)) for lbl, v in (points or TOY_POINTS)]
    return spark.createDataFrame(rows, POINT_SCHEMA).repartition(n)


def features(cols: list[str] | str) -> Column:
    """Numeric columns, or one numeric-array column, -> ``VectorUDT`` (R2)."""
    if isinstance(cols, str):
        return array_to_vector(F.col(cols).cast("array<double>"))
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in cols]))


def to_rows(df: DataFrame, label: Column | str, feature_cols: list[str] | str) -> DataFrame:
    """(label, features) rows from any table."""
    lbl = F.col(label) if isinstance(label, str) else label
    return df.select(lbl.cast("double").alias("label"), features(feature_cols).alias("features"))
