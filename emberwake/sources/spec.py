"""Schema specs: a small delimited file with one row per field.

Columns ``name``, ``type``, ``nullable``; separator ``|`` by default. The spec
is a handful of rows (one per column of the data), so it is read with Spark's
own CSV reader and collected; the result is a ``StructType`` that drives a
distributed scan. Nothing about the *data* passes through the driver.

Type rules (match on the leading word, any case, cells trimmed):

* words with ``CHAR`` (``VARCHAR(n)``, ``NVARCHAR(n)``, ``VARCHAR2(n)``,
  ``CHARACTER(n)``), ``STRING``, ``TEXT`` -> string (length is not enforced)
* ``DOUBLE``, ``DOUBLE PRECISION`` -> double, ``FLOAT`` -> float, ``INTEGER`` ->
  int; a size is accepted and ignored
* extensions: ``BIGINT`` -> long, ``DECIMAL(p,s)``/``NUMERIC(p,s)`` -> decimal,
  ``DATE``, ``TIMESTAMP`` (no time zone), ``BOOLEAN``
* a parenthesis without its partner, unknown words or trailing text raise.

Nullable flag: ``true/1/t`` or ``false/0/f`` in any case; anything else raises.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPE_RE = re.compile(
    r"^(?P<word>[A-Za-z_]+2?(?:\s+PRECISION)?)\s*(?:\(\s*(?P<p>\d+)\s*(?:,\s*(?P<s>\d+)\s*)?\))?$", re.IGNORECASE)

_TRUE = ("true", "1", "t")
_FALSE = ("false", "0", "f")


def parse_type(text: str | None) -> T.DataType:
    """SQL type name -> Spark ``DataType``."""
    if text is None or not str(text).strip():
        raise ValueError("Missing SQL data type")
    raw = str(text).strip()
    has_l, has_r = "(" in raw, ")" in raw
    if has_l != has_r:
        raise ValueError(f"Invalid SQL data type {raw}")
    m = _TYPE_RE.match(raw)
    if not m:
        raise ValueError(f"Invalid SQL data type {raw}")
    word = " ".join(m.group("word").upper().split())
    p, s = m.group("p"), m.group("s")
    if "CHAR" in word or word in ("STRING", "TEXT"):
        return T.StringType()
    # a size means something to decimals alone; the others accept and ignore it
    if word in ("DOUBLE", "DOUBLE PRECISION"):
        return T.DoubleType()
    if word == "FLOAT":
        return T.FloatType()
    if word == "INTEGER":
        return T.IntegerType()
    if word == "BIGINT":
        return T.LongType()
    if word in ("DECIMAL", "NUMERIC"):
        precision = int(p) if p is not None else 10
        scale = int(s) if s is not None else 0
        if not (1 <= precision <= 38 and 0 <= scale <= precision):
            raise ValueError(f"Invalid SQL data type {raw}")
        return T.DecimalType(precision, scale)
    if word == "DATE":
        return T.DateType()
    if word == "TIMESTAMP":
        return T.TimestampNTZType()
    if word == "BOOLEAN":
        return T.BooleanType()
    raise ValueError(f"Not supported SQL data type '{raw}'.")


def parse_nullable(text: str | None) -> bool:
    """Nullable flag (S3)."""
    if text is None or not str(text).strip():
        raise ValueError("Missing nullable value")
    v = str(text).strip().lower()
    if v in _FALSE:
        return False
    if v in _TRUE:
        return True
    raise ValueError(f"Invalid nullable value {text}")


def fields_from_rows(rows) -> T.StructType:
    """(name, type, nullable) triples -> ``StructType``."""
    fields = []
    for name, typ, nullable in rows:
        if name is None or not str(name).strip():
            raise ValueError("Missing field name in schema spec")
        fields.append(T.StructField(str(name).strip(), parse_type(typ), parse_nullable(nullable)))
    return T.StructType(fields)


def schema_from_spec(spark: SparkSession, path: str, sep: str = "|") -> T.StructType:
    """Read a spec file (local, HDFS or any Hadoop path) into a ``StructType``."""
    spec = (spark.read.option("header", True).option("sep", sep)
            .option("inferSchema", False).option("mode", "FAILFAST")
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .csv(path))
    missing = {"name", "type", "nullable"} - {c.lower() for c in spec.columns}
    if missing:
        raise ValueError(f"Schema spec lacks columns {sorted(missing)}")
    cols = {c.lower(): c for c in spec.columns}
    # A spec has one row per data column: a tiny, bounded collect.
    rows = spec.select(cols["name"], cols["type"], cols["nullable"]).collect()
    return fields_from_rows(rows)


_SPARK_TO_SQL = {
    T.StringType: "VARCHAR",
    T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP",
    T.BooleanType: "BOOLEAN",
}


def sql_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    for cls, name in _SPARK_TO_SQL.items():
        if isinstance(dt, cls):
            return name
    raise ValueError(f"No spec type for {dt.simpleString()}")


def write_spec(spark: SparkSession, schema: T.StructType, path: str, sep: str = "|",
               not_null: tuple[str, ...] = ()) -> str:
    """Write a spec file describing ``schema`` (inverse of :func:`schema_from_spec`)."""
    rows = [(f.name, sql_type_name(f.dataType), "false" if f.name in not_null else "true")
            for f in schema.fields]
    spec: DataFrame = spark.createDataFrame(rows, "name string, type string, nullable string")
    spec.coalesce(1).write.mode("error").option("header", True).option("sep", sep).csv(path)
    return path
