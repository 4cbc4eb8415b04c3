"""The load job (E1, E4): schema spec + delimited data -> checked table.

One pass over the source: the destination is checked before anything is
read, the sample is a bounded ``limit``, and the record count is observed
during the write instead of being a second scan.

Run as a job::

    spark-submit --py-files emberwake.zip emberwake/plans/load.py \
        --src_data_file 'hdfs:///in/*.csv' --src_schema_file spec.psv \
        --dest_format parquet --dest_path out/ ...

or locally with ``python -m emberwake.plans.load ...``.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from emberwake.session import scratch_path
from emberwake.sinks.tables import Destination, describe_schema, write_table
from emberwake.sources.delimited import SOURCE_FORMATS, enforce_not_null, read_source
from emberwake.sources.spec import schema_from_spec, write_spec

log = logging.getLogger(__name__)

# Written with microsecond precision so timestamps survive a CSV round trip.
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@dataclass
class LoadSpec:
    src_data: str
    src_schema: str
    dest: Destination
    src_format: str = "csv"
    sep: str = ","
    spec_sep: str = "|"
    options: dict = field(default_factory=dict)


@dataclass
class LoadResult:
    rows: int
    schema: T.StructType
    sample: list


def open_source(spark: SparkSession, spec: LoadSpec) -> tuple[T.StructType, DataFrame]:
    """Spec -> schema -> strict, not-null-checked DataFrame (lazy)."""
    if spec.src_format.lower() not in SOURCE_FORMATS:
        raise ValueError(f"Source data format '{spec.src_format}' is not supported.")
    schema = schema_from_spec(spark, spec.src_schema, spec.spec_sep)
    df = read_source(spark, spec.src_format, spec.src_data, schema, sep=spec.sep, **spec.options)
    return schema, enforce_not_null(df, schema)


def load(spark: SparkSession, spec: LoadSpec, sample_rows: int = 20) -> LoadResult:
    spec.dest.check()
    schema, df = open_source(spark, spec)
    log.info("schema:\n%s", "\n".join(f"{f.name} {f.dataType.simpleString()} {f.nullable}"
                                      for f in schema.fields))
    sample = df.limit(sample_rows).collect() if sample_rows else []
    rows = write_table(df, spec.dest)
    log.info("wrote %d records to %s", rows, spec.dest)
    return LoadResult(rows, schema, sample)


def stage_as_csv(spark: SparkSession, df: DataFrame, name: str,
                 not_null: tuple[str, ...] = (), sep: str = ",",
                 options: dict | None = None) -> tuple[str, str]:
    """Write ``df`` as headed CSV plus a spec file below the shared folder.

    Returns ``(data_folder, spec_path)``. Used to feed the loader from tables.
    """
    base = scratch_path(spark, name)
    data = f"{base}/data"
    (df.write.mode("error").option("header", True).option("sep", sep)
     .option("timestampNTZFormat", TS_NTZ_FORMAT).options(**(options or {})).csv(data))
    spec = write_spec(spark, df.schema, f"{base}/spec", not_null=not_null)
    return data, spec


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description="Strict delimited loader.")
    p.add_argument("--src_format", default="csv")
    p.add_argument("--src_data_file", required=True)
    p.add_argument("--src_schema_file", required=True)
    p.add_argument("--sep", default=",")
    p.add_argument("--dest_format", default="org.apache.phoenix.spark")
    p.add_argument("--dest_table")
    p.add_argument("--dest_url")
    p.add_argument("--dest_path")
    p.add_argument("--write_mode", default="error")
    p.add_argument("--header_by_position", action="store_true",
                   help="take the spec's names in order, whatever the header says")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO,
                        format="%(asctime)s %(levelname)s %(name)s %(message)s")
    dest = Destination(a.dest_format, a.dest_table, a.dest_url, a.dest_path, a.write_mode).check()
    spark = SparkSession.builder.enableHiveSupport().getOrCreate()
    options = {"strict_header": False} if a.header_by_position else {}
    res = load(spark, LoadSpec(a.src_data_file, a.src_schema_file, dest, a.src_format, a.sep,
                               options=options))
    for r in describe_schema(spark, spark.createDataFrame([], res.schema)).collect():
        log.info("%s", r)
    log.info("records: %d", res.rows)


if __name__ == "__main__":
    main()
