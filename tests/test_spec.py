"""Schema spec parsing (S1-S3): FIXTURES.md section 1."""

import pytest
from pyspark.sql import types as T

from emberwake.sources.spec import (
    fields_from_rows, parse_nullable, parse_type, schema_from_spec, write_spec,
)


@pytest.mark.parametrize("text,expected", [
    ("varchar(10)", T.StringType()),
    ("VARCHAR(10)", T.StringType()),
    ("CHAR(3)", T.StringType()),
    ("  VARCHAR ( 10 )  ", T.StringType()),
    ("DOUBLE", T.DoubleType()),
    ("double", T.DoubleType()),
    ("FLOAT", T.FloatType()),
    ("INTEGER", T.IntegerType()),
    ("BIGINT", T.LongType()),
    ("DECIMAL(12,2)", T.DecimalType(12, 2)),
    ("DATE", T.DateType()),
    ("TIMESTAMP", T.TimestampNTZType()),
    ("BOOLEAN", T.BooleanType()),
    ("FLOAT(24)", T.FloatType()),
    ("INTEGER(11)", T.IntegerType()),
    ("DOUBLE(10,2)", T.DoubleType()),
    ("double  precision", T.DoubleType()),
    ("VARCHAR2(20)", T.StringType()),
    ("NVARCHAR(5)", T.StringType()),
    ("CHARACTER(3)", T.StringType()),
])
def test_types_accepted(text, expected):
    assert parse_type(text) == expected


@pytest.mark.parametrize("text", [
    "VARCHAR(10", "VARCHAR 10)", "BLOB", "", None, "DECIMAL(40,2)", "VARCHAR(10) extra",
    "FLOAT PRECISION", "DOUBLE(3",
])
def test_types_rejected(text):
    with pytest.raises(ValueError):
        parse_type(text)


@pytest.mark.parametrize("text,expected", [
    ("true", True), ("1", True), ("T", True), ("TRUE", True), (" t ", True),
    ("false", False), ("0", False), ("F", False), ("False", False),
])
def test_nullable(text, expected):
    assert parse_nullable(text) is expected


@pytest.mark.parametrize("text", ["maybe", "", None, "yes"])
def test_nullable_rejected(text):
    with pytest.raises(ValueError):
        parse_nullable(text)


def test_fields_from_rows():
    s = fields_from_rows([("id", "INTEGER", "0"), ("name", "VARCHAR(5)", "true")])
    assert s == T.StructType([T.StructField("id", T.IntegerType(), False),
                              T.StructField("name", T.StringType(), True)])


def test_spec_file_round_trip(spark, tmp_dir):
    schema = T.StructType([
        T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType()),
        T.StructField("c", T.DoubleType()), T.StructField("d", T.TimestampNTZType()),
        T.StructField("e", T.DecimalType(10, 3)),
    ])
    path = write_spec(spark, schema, f"{tmp_dir}/spec", not_null=("a",))
    assert schema_from_spec(spark, path) == schema


def test_spec_file_written_by_hand(spark, tmp_dir):
    p = f"{tmp_dir}/spec.psv"
    with open(p, "w") as f:
        f.write("name|type|nullable\nid|INTEGER|0\nname|varchar(10)|true\nv|DOUBLE|1\n")
    s = schema_from_spec(spark, p)
    assert [(x.name, x.dataType, x.nullable) for x in s.fields] == [
        ("id", T.IntegerType(), False), ("name", T.StringType(), True),
        ("v", T.DoubleType(), True)]


def test_spec_bad_type_raises(spark, tmp_dir):
    p = f"{tmp_dir}/bad.psv"
    with open(p, "w") as f:
        f.write("name|type|nullable\nid|BLOB|0\n")
    with pytest.raises(ValueError):
        schema_from_spec(spark, p)


def test_spec_round_trip_other_types(spark, tmp_dir):
    schema = T.StructType([
        T.StructField("i", T.IntegerType(), False), T.StructField("f", T.FloatType()),
        T.StructField("d", T.DateType()), T.StructField("b", T.BooleanType()),
    ])
    path = write_spec(spark, schema, f"{tmp_dir}/spec2", not_null=("i",))
    assert schema_from_spec(spark, path) == schema
