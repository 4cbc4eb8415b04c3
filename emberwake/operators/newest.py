"""Newest-N retention per class (W2, T2) for quotas of any size.

Rows of a class are ordered by the ``order`` columns, newest first, and rows
equal in all of them by a hash of the whole row, so the order is total up to
identical rows, of which any may stay: kept and evicted rows always part the
table.

* Small quotas: ``row_number() <= k``, planned as a partial top-k before the
  shuffle, so a hot class ships k rows a task.
* Larger ones: a selection in several passes. A histogram of the first order
  column per class (``CELLS`` cells between its least and greatest value, counted
  with a partial aggregate) tells in which cell the N-th newest row lies; the
  next pass looks into that cell alone, until it has few rows or one value. Rows
  newer than the cell stay by a filter; the cell's rows are ranked, or, where
  they share one value, selected by the next order column in the same way, at
  last by the hash. No class is sorted as a whole, and the state between passes
  is one written row a class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwake.session import scratch_path

#: Largest quota that Spark plans as a partial top-k.
TOP_K = 1000
CELLS = 1024
#: Classes whose bounds are broadcast; more are joined by a shuffle.
FEW_CLASSES = 200_000
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
HASH = "__row_hash"


def total_order(df: DataFrame) -> DataFrame:
    """``df`` with the hash that orders rows equal in the order columns."""
    plain = [F.to_json(F.struct(c)) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in df.columns]
    return df.withColumn(HASH, F.xxhash64(*plain))


def ranked(df: DataFrame, cls: str, order: Sequence[str], limit: int) -> DataFrame:
    """The newest ``limit`` rows of each class with their rank, ``__rn``."""
    w = Window.partitionBy(cls).orderBy(*[F.col(c).desc() for c in (*order, HASH)])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= limit)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _few(bounds: DataFrame) -> DataFrame:
    """One row a class: broadcast only while the classes are few."""
    return F.broadcast(bounds) if bounds.limit(FEW_CLASSES + 1).count() <= FEW_CLASSES else bounds


def _position(df: DataFrame, name: str) -> Column | None:
    """A long or double that orders like the column, null (which is oldest)
    apart; None where there is no such number."""
    kind = df.schema[name].dataType
    if isinstance(kind, TIMES):
        from emberwake.operators.events import epoch_micros
        return epoch_micros(df, name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = F.col(name).cast("double")  # beyond 8e307 all are one value: differences stay finite
        return F.when(F.isnan(c), F.lit(8e307)).otherwise(F.greatest(F.lit(-8e307), F.least(F.lit(8e307), c)))
    return F.col(name).cast("long") if isinstance(kind, INTEGERS) else None


def _apart(rows: DataFrame, a: str, b: str) -> Column:
    """How far two positions lie apart, positive where they differ."""
    exact = "double" if isinstance(rows.schema["__pos"].dataType, T.DoubleType) else "decimal(20,0)"
    return (F.col(a).cast(exact) - F.col(b).cast(exact)).cast("double")


def _narrowed(rows: DataFrame, bounds: DataFrame, few: int) -> DataFrame:
    """For each class the cell of ``__pos`` in which its quota ends: ``lo``,
    ``hi`` (both null: the rows without a position), ``need`` rows of the ``m``
    in it.

    ``bounds`` has ``__cls`` and ``need``. Classes with no more rows than needed
    keep all: their cell is the one of the oldest rows.
    """
    step = rows.groupBy("__cls").agg(F.min("__pos").alias("lo"), F.max("__pos").alias("hi"), F.count(F.lit(1)).alias("m"),
                                     F.count("__pos").alias("with_pos"))
    state = step.join(bounds, step["__cls"].eqNullSafe(bounds["__cls"])).select(
        step["__cls"], "need", "lo", "hi", "m", "with_pos")
    # a quota that reaches the rows without a position ends among them
    beyond = F.col("need") > F.col("with_pos")
    empty = F.lit(None).cast(state.schema["lo"].dataType)
    state = _written(state.select(
        "__cls", F.when(beyond, F.col("need") - F.col("with_pos")).otherwise(F.col("need")).alias("need"),
        F.when(beyond, empty).otherwise(F.col("lo")).alias("lo"), F.when(beyond, empty).otherwise(F.col("hi")).alias("hi"),
        F.when(beyond, F.col("m") - F.col("with_pos")).otherwise(F.col("with_pos")).alias("m")), "newest_bounds")
    while True:
        wide = (F.col("m") > few) & (F.col("lo") < F.col("hi")) & (F.col("need") < F.col("m"))
        open_ = state.filter(wide)
        if open_.isEmpty():
            return state
        width = _apart(rows, "hi", "lo") / CELLS
        cell = F.least(F.lit(CELLS - 1), F.floor(_apart(rows, "__pos", "lo") / width)).cast("int")
        some = _few(open_.withColumnRenamed("__cls", "__of"))
        counted = (rows.join(some, rows["__cls"].eqNullSafe(some["__of"]) & F.col("__pos").between(F.col("lo"), F.col("hi")))
                   .groupBy("__cls", "need", cell.alias("cell"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min("__pos").alias("low"), F.max("__pos").alias("high")))
        # at most CELLS rows a class
        newer = Window.partitionBy("__cls").orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
        at = counted.withColumn("before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
        at = at.filter((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("n")))
        at = at.select("__cls", (F.col("need") - F.col("before")).alias("need"), F.col("low").alias("lo"),
                       F.col("high").alias("hi"), F.col("n").alias("m"))
        state = _written(at.unionByName(state.filter(~F.coalesce(wide, F.lit(False)))), "newest_bounds")


def _parted(df: DataFrame, cls: str, quota: DataFrame, order: list[str], few: int) -> tuple[DataFrame, DataFrame]:
    """(kept, evicted) of rows whose class has a row (``__cls``, ``need`` > 0)
    in ``quota``. ``df`` has the hash; rows are equal in order columns that are
    no longer listed."""
    columns = df.columns
    if not order:
        # identical rows: so many copies of each
        copies = df.groupBy(*columns).agg(F.count(F.lit(1)).cast("int").alias("__n"))
        some = _few(quota.withColumnRenamed("__cls", "__of"))
        copies = copies.join(some, copies[cls].eqNullSafe(some["__of"]))
        stay = F.least(F.col("__n").cast("long"), F.col("need")).cast("int")
        kept, gone = (copies.filter(n > 0).withColumn("__k", F.explode(F.sequence(F.lit(1), n))).select(*columns)
                      for n in (stay, F.col("__n") - stay))
        return kept, gone
    position = _position(df, order[0])
    if position is None:  # nothing to count by: rank them
        return _by_rank(df, cls, quota, order)
    rows = df.withColumn("__pos", position).withColumn("__cls", F.col(cls))
    bounds = _narrowed(rows.select("__cls", "__pos"), quota, few)
    some = _few(bounds.withColumnRenamed("__cls", "__of"))
    placed = rows.join(some, rows["__cls"].eqNullSafe(some["__of"]))
    inside = F.when(F.col("lo").isNull(), F.col("__pos").isNull()).otherwise(F.col("__pos").between(F.col("lo"), F.col("hi")))
    inside = F.coalesce(inside, F.lit(False))
    newer = F.coalesce(F.when(F.col("lo").isNull(), F.col("__pos").isNotNull()).otherwise(F.col("__pos") > F.col("hi")),
                       F.lit(False))
    kept, gone = placed.filter(newer), placed.filter(~newer & ~inside)
    # the cell: all needed, or few rows to rank, or one value (or none) with many
    whole = inside & (F.col("need") >= F.col("m"))
    many = (F.col("m") > few) & (F.col("lo").isNull() | (F.col("lo") == F.col("hi"))) & (F.col("need") < F.col("m"))
    kept = kept.select(*columns).unionByName(placed.filter(whole).select(*columns))
    gone = gone.select(*columns)
    to_rank = bounds.filter((F.col("need") < F.col("m")) & ~many).select("__cls", "need")
    a, b = _by_rank(placed.filter(inside & (F.col("need") < F.col("m")) & ~many).select(*columns), cls, to_rank, order)
    kept, gone = kept.unionByName(a), gone.unionByName(b)
    deeper = bounds.filter(many).select("__cls", "need")
    if not deeper.isEmpty():
        a, b = _parted(placed.filter(inside & many).select(*columns), cls, deeper, order[1:], few)
        kept, gone = kept.unionByName(a), gone.unionByName(b)
    return kept, gone


def _by_rank(df: DataFrame, cls: str, quota: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    columns = df.columns
    w = Window.partitionBy(cls).orderBy(*[F.col(c).desc() for c in order])
    some = quota.select(F.col("__cls").alias("__of"), "need")
    numbered = df.withColumn("__rn", F.row_number().over(w))
    placed = numbered.join(_few(some), numbered[cls].eqNullSafe(some["__of"]))
    return (placed.filter(F.col("__rn") <= F.col("need")).select(*columns),
            placed.filter(F.col("__rn") > F.col("need")).select(*columns))


def parted(df: DataFrame, cls: str, quota: Column, order: Sequence[str], few: int = TOP_K) -> tuple[DataFrame, DataFrame]:
    """(kept, evicted) rows of every class for a quota of any size."""
    rows = total_order(df)
    quotas = rows.groupBy(F.col(cls).alias(cls)).agg(F.count(F.lit(1)).alias("__n"))
    quotas = quotas.withColumn("need", F.least(quota.cast("long"), F.col("__n"))).select(F.col(cls).alias("__cls"), "need")
    quotas = _written(quotas, "newest_quota")
    none = _few(quotas.filter("need <= 0").select(F.col("__cls").alias("__none")))
    some = quotas.filter("need > 0")
    emptied = rows.join(none, rows[cls].eqNullSafe(F.col("__none")), "left_semi")
    held = rows.join(none, rows[cls].eqNullSafe(F.col("__none")), "left_anti")
    kept, gone = _parted(held, cls, some, [*order, HASH], few)
    return kept.select(*df.columns), gone.unionByName(emptied).select(*df.columns)
