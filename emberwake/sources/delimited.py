"""Strict delimited scans under a declared schema.

The scan is Spark's CSV source: inference off, ``FAILFAST`` on the first bad
row, header names checked against the schema by default. File sources drop
``nullable=False`` from the schema, so the not-null contract is a projection
of ``raise_error`` guards that runs inside whole-stage codegen on the
executors, never a pass of rows through Python.

Column pruning caveat: a bare ``count()`` over a CSV scan parses no column and
so validates nothing. Validate by consuming every column: a write (see
:mod:`emberwake.sinks.tables`) or :func:`validate`, which runs a ``noop`` sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keyword options forwarded to Spark's CSV reader.
CSV_OPTIONS = (
    "encoding", "quote", "escape", "comment", "header", "ignoreLeadingWhiteSpace",
    "ignoreTrailingWhiteSpace", "nullValue", "nanValue", "positiveInf", "negativeInf",
    "dateFormat", "timestampFormat", "timestampNTZFormat", "maxColumns",
    "maxCharsPerColumn", "multiLine", "lineSep", "emptyValue", "locale",
)
# Accepted for compatibility; Spark 4 no longer uses it.
IGNORED_OPTIONS = ("maxMalformedLogPerPartition",)

SOURCE_FORMATS = ("csv", "parquet", "orc", "json")


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   sep: str = ",", strict_header: bool = True, **options) -> DataFrame:
    """Scan delimited text with a declared schema; fail on the first bad row.

    ``path`` may hold Hadoop globs and any file system URL (S6).
    ``strict_header=False`` binds header columns by position instead of name.
    """
    unknown = set(options) - set(CSV_OPTIONS) - set(IGNORED_OPTIONS)
    if unknown:
        raise ValueError(f"Unknown CSV options {sorted(unknown)}")
    opts = {
        "sep": sep,
        "header": True,
        "inferSchema": False,
        "mode": "FAILFAST",
        "ignoreLeadingWhiteSpace": True,
        "ignoreTrailingWhiteSpace": True,
        "enforceSchema": not strict_header,
    }
    for k, v in options.items():
        if k in IGNORED_OPTIONS or v is None:
            continue
        opts[k] = v
    reader = spark.read.schema(schema)
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_source(spark: SparkSession, fmt: str, path, schema: T.StructType,
                sep: str = ",", **options) -> DataFrame:
    """Source format gate (S7): csv is the reference's format; parquet, orc
    and json are extensions read under the same declared schema."""
    f = (fmt or "").lower()
    if f not in SOURCE_FORMATS:
        raise ValueError(f"Source data format '{fmt}' is not supported.")
    if f == "csv":
        return read_delimited(spark, path, schema, sep=sep, **options)
    return spark.read.format(f).schema(schema).options(**options).load(path)


def not_null_guard(name: str) -> Column:
    """True, or an error on a null."""
    failed = F.raise_error(F.lit(f"NULL in not-null column '{name}'")).cast("boolean")
    return F.when(F.col(name).isNull(), failed).otherwise(F.lit(True))


def enforce_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise on a null in any column the schema declares not-null.

    The guards are one filter: column pruning cannot remove them, so every such
    column is read and checked whatever the query uses.
    """
    required = {f.name for f in schema.fields if not f.nullable}
    for c in df.columns:
        if c in required:
            df = df.filter(not_null_guard(c))
    return df


def validate(df: DataFrame) -> None:
    """Parse every column of every row without writing anything."""
    df.write.format("noop").mode("overwrite").save()
