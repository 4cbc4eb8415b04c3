"""Sinks: table writes, schema listings, profiles, class-partitioned writes.

K1-K7. Writes count their rows with ``DataFrame.observe`` so that the source
is scanned exactly once (the count rides along with the write).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberwake.functions.scalars import item_key, second_key

PHOENIX = "org.apache.phoenix.spark"
PATH_FORMATS = ("parquet", "orc", "json", "csv")
DEST_FORMATS = (PHOENIX, "table") + PATH_FORMATS
#: Columns that write_by_class adds to items stored by class and second.
ITEM_COLUMNS = ("second_key", "item", "day")
SAVE_MODES = ("error", "errorifexists", "append", "overwrite", "ignore")


@dataclass(frozen=True)
class Destination:
    fmt: str
    table: str | None = None
    url: str | None = None
    path: str | None = None
    mode: str = "error"

    def check(self) -> "Destination":
        """Destination gate (K3): raise before any source data is read."""
        if self.fmt not in DEST_FORMATS:
            raise ValueError(f"Destination data format '{self.fmt}' is not supported")
        if self.mode.lower() not in SAVE_MODES:
            raise ValueError(f"Unknown write mode '{self.mode}'")
        if self.fmt == PHOENIX and not (self.table and self.url):
            raise ValueError("Phoenix destination needs a table and a URL")
        if self.fmt == "table" and not self.table:
            raise ValueError("Table destination needs a table name")
        if self.fmt in PATH_FORMATS and not self.path:
            raise ValueError(f"{self.fmt} destination needs a path")
        return self


def write_table(df: DataFrame, dest: Destination) -> int:
    """Write ``df`` to ``dest`` (K1, K2) and return the rows written (K6)."""
    dest.check()
    obs = Observation("emberwake_write")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = counted.write.mode(dest.mode)
    if dest.fmt == PHOENIX:
        w.format(PHOENIX).option("table", dest.table).option("zkUrl", dest.url).save()
    elif dest.fmt == "table":
        w.saveAsTable(dest.table)
    else:
        w.format(dest.fmt).save(dest.path)
    return int(obs.get["rows"])


def describe_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per field: ``position, name, type, nullable`` (K5)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def profile(df: DataFrame) -> DataFrame:
    """Schema listing plus row and null counts per column, in one scan (K5, K6).

    A single global aggregate (partial counts per task, one tiny final merge),
    reshaped to one row per column inside Spark.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count(F.col(f"`{f.name}`")).alias(f"__nn{i}") for i, f in enumerate(fields)]
    per_col = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.lit(f.nullable).alias("nullable"),
                 F.col(f"__nn{i}").alias("non_null"),
                 (F.col("__rows") - F.col(f"__nn{i}")).alias("nulls"))
        for i, f in enumerate(fields)])
    return df.agg(*aggs).select(F.explode(per_col).alias("c")).select("c.*")


def sample(df: DataFrame, n: int = 20) -> list:
    """First ``n`` rows for a look (K4); bounded by ``n``."""
    return df.limit(n).collect()


def write_by_class(df: DataFrame, path: str, cls: str = "class", mode: str = "error",
                   fmt: str = "parquet", ts: str | None = None) -> None:
    """Store items under their class (K7): one folder per class value.

    With a time column ``ts`` an item is kept under class and second: the columns
    ``second_key`` and ``item`` (its name) are added, a class is divided into
    folders by ``day``, and a file's rows are ordered by second, so that a look-up
    (:func:`read_item`) reads one folder and of its files the row groups around
    the second. Items of one second all stay. A row without a time lies in the
    class's folder of the null day; a table that has one of the added names
    already is an error.

    The rows are rebalanced by folder: AQE splits a hot folder by its measured size
    and puts small ones together, so the number of files follows the data and not
    the number of tasks that hold a class.
    """
    folders, order = [cls], [cls]
    if ts is not None:
        taken = {c.lower() for c in df.columns} & set(ITEM_COLUMNS)
        if taken:
            raise ValueError(f"columns {sorted(taken)} are added to stored items and exist already")
        key = second_key(F.col(ts))
        df = df.select("*", key.alias("second_key"), item_key(F.col(cls).cast("string"), key).alias("item"),
                       F.substring(key, 1, 8).alias("day"))
        folders, order = [cls, "day"], [cls, "day", "second_key"]
    (df.hint("rebalance", *folders).sortWithinPartitions(*order)
     .write.mode(mode).partitionBy(*folders).format(fmt).save(path))


def read_item(items: DataFrame, cls: str, value: str, second: str) -> DataFrame:
    """The items of one class and 14-digit second key in a table that
    :func:`write_by_class` stored with a time column."""
    return items.filter((F.col(cls) == value) & (F.col("day") == second[:8]) & (F.col("second_key") == second))
