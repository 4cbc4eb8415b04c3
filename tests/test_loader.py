"""Strict delimited scans, sinks and the load job."""

import math
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paths import SF_SMALL
from emberwake.plans.load import TS_NTZ_FORMAT, LoadSpec, load, open_source, stage_as_csv
from emberwake.sinks.tables import (
    PHOENIX, Destination, describe_schema, profile, read_item, write_by_class, write_table,
)
import __spark_entry__ as entry_mod
from paths import SF_SMALL
from emberwake.sources.delimited import enforce_not_null, read_delimited, read_source, validate
from emberwake.sources.files import list_files, list_tree

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("v", T.DoubleType(), True),
])


def _csv(tmp_dir, name, text):
    p = f"{tmp_dir}/{name}"
    with open(p, "w") as f:
        f.write(text)
    return p


def test_trim_empty_null(spark, tmp_dir):
    p = _csv(tmp_dir, "a.csv", "id,name,v\n1, ann ,2.5\n2,,3.5\n")
    rows = read_delimited(spark, p, SCHEMA).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "ann", 2.5), (2, None, 3.5)]


def test_bad_row_fails_when_columns_are_read(spark, tmp_dir):
    p = _csv(tmp_dir, "b.csv", "id,name,v\n1,a,1.0\nx,bob,oops\n")
    df = read_delimited(spark, p, SCHEMA)
    with pytest.raises(Exception):
        df.collect()
    with pytest.raises(Exception):
        validate(df)


@pytest.mark.parametrize("line", ["3,c", "3,c,1.0,9"])
def test_wrong_field_count_fails(spark, tmp_dir, line):
    p = _csv(tmp_dir, "c.csv", f"id,name,v\n1,a,1.0\n{line}\n")
    with pytest.raises(Exception):
        validate(read_delimited(spark, p, SCHEMA))


def test_nan_inf(spark, tmp_dir):
    p = _csv(tmp_dir, "d.csv", "id,name,v\n1,a,NaN\n2,b,Inf\n3,c,-Inf\n")
    vals = [r.v for r in read_delimited(spark, p, SCHEMA).orderBy("id").collect()]
    assert math.isnan(vals[0]) and vals[1] == math.inf and vals[2] == -math.inf


def test_header_order_is_checked(spark, tmp_dir):
    p = _csv(tmp_dir, "e.csv", "name,id,v\nann,1,2.0\n")
    with pytest.raises(Exception):
        read_delimited(spark, p, SCHEMA).collect()
    positional = T.StructType([T.StructField("name", T.StringType()),
                               T.StructField("id", T.IntegerType()),
                               T.StructField("v", T.DoubleType())])
    assert read_delimited(spark, p, positional, strict_header=False).collect()[0].id == 1


def test_not_null_contract(spark, tmp_dir):
    p = _csv(tmp_dir, "f.csv", "id,name,v\n1,a,1.0\n,b,2.0\n")
    df = enforce_not_null(read_delimited(spark, p, SCHEMA), SCHEMA)
    with pytest.raises(Exception, match="not-null"):
        df.collect()
    # the column itself need not be asked for
    with pytest.raises(Exception, match="not-null"):
        df.groupBy("name").count().collect()


def test_not_null_contract_stays_in_the_flagship_plan(spark):
    df = entry_mod.queries()["load_orders"](spark, SF_SMALL)
    assert "raise_error" in df._jdf.queryExecution().optimizedPlan().toString()


def test_glob_and_options(spark, tmp_dir):
    _csv(tmp_dir, "g1.csv", "id;name;v\n1;a;1.0\n")
    _csv(tmp_dir, "g2.csv", "id;name;v\n# a comment\n2;NA;2.0\n")
    df = read_delimited(spark, f"{tmp_dir}/g*.csv", SCHEMA, sep=";", comment="#",
                        nullValue="NA", maxMalformedLogPerPartition=5)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a", 1.0), (2, None, 2.0)]
    with pytest.raises(ValueError):
        read_delimited(spark, f"{tmp_dir}/g*.csv", SCHEMA, nonsense=1)


def test_source_format_gate(spark, tmp_dir):
    with pytest.raises(ValueError):
        read_source(spark, "xml", tmp_dir, SCHEMA)


def test_destination_gate():
    with pytest.raises(ValueError):
        Destination("avro", path="/x").check()
    with pytest.raises(ValueError):
        Destination(PHOENIX, table="t").check()
    with pytest.raises(ValueError):
        Destination("parquet").check()
    Destination(PHOENIX, table="t", url="zk:2181").check()


def test_write_modes_and_count(spark, tmp_dir):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    dest = Destination("parquet", path=f"{tmp_dir}/out")
    assert write_table(df, dest) == 100
    with pytest.raises(AnalysisException):
        write_table(df, dest)             # mode "error" is the default
    assert write_table(df, Destination("parquet", path=f"{tmp_dir}/out", mode="append")) == 100
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 200


def test_phoenix_connector_absent(spark):
    df = spark.range(3)
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND|phoenix"):
        write_table(df, Destination(PHOENIX, table="T", url="localhost:2181"))


def test_profile_and_schema_listing(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (None, "c")], "a int, b string")
    prof = {r.name: (r.non_null, r.nulls, r.type) for r in profile(df).collect()}
    assert prof == {"a": (2, 1, "int"), "b": (2, 1, "string")}
    listing = [tuple(r) for r in describe_schema(spark, df).collect()]
    assert listing == [(0, "a", "int", True), (1, "b", "string", True)]


def test_load_round_trip(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    data, spec = stage_as_csv(spark, orders, "t_load", not_null=("o_orderkey",))
    from emberwake.session import scratch_path
    out = scratch_path(spark, "t_load_out")
    res = load(spark, LoadSpec(data, spec, Destination("parquet", path=out),
                               options={"timestampNTZFormat": TS_NTZ_FORMAT}))
    assert res.rows == orders.count() and len(res.sample) == 20
    back = spark.read.parquet(out)
    assert back.schema.simpleString() == orders.schema.simpleString()
    assert back.exceptAll(orders).count() == 0 and orders.exceptAll(back).count() == 0


def test_load_checks_destination_before_reading(spark):
    with pytest.raises(ValueError):
        load(spark, LoadSpec("/does/not/exist", "/nor/this", Destination("avro", path="/x")))


def test_open_source_reads_spec(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    data, spec = stage_as_csv(spark, orders, "t_open")
    schema, df = open_source(spark, LoadSpec(data, spec, Destination("parquet", path="-"),
                                             options={"timestampNTZFormat": TS_NTZ_FORMAT}))
    assert [f.name for f in schema.fields] == orders.columns
    assert df.count() == orders.count()


def test_write_by_class_and_listing(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = f"{tmp_dir}/by_class"
    write_by_class(ev, out, cls="event_type")
    back = spark.read.parquet(out)
    assert back.count() == ev.count()
    assert {r.event_type for r in back.select("event_type").distinct().collect()} == \
        {r.event_type for r in ev.select("event_type").distinct().collect()}
    files = list_files(spark, out, "*.parquet")
    assert files.count() >= 5
    assert set(files.columns) == {"path", "name", "modified", "length"}


def _files(folder):
    return sorted(os.path.relpath(os.path.join(at, n), folder) for at, _, names in os.walk(folder)
                  for n in names if n.endswith(".parquet"))


def test_files_of_a_class_follow_its_size_not_the_tasks(spark, tmp_dir):
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("class"))
    for tasks in (2, 40):
        write_by_class(rows.repartition(tasks), f"{tmp_dir}/{tasks}")
    assert len(_files(f"{tmp_dir}/2")) == len(_files(f"{tmp_dir}/40")) == 6
    wide = rows.repartition(8).withColumn("text", F.when(F.col("class") == "hot", F.repeat(F.sha2(F.col("id").cast("string"), 256), 8)))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "128k")
    try:
        write_by_class(wide, f"{tmp_dir}/split")
    finally:
        spark.conf.unset(key)
    made = _files(f"{tmp_dir}/split")
    assert sum(f.startswith("class=hot/") for f in made) >= 3  # split by its size
    # a small class is one file, or shares the hot class's pieces where it hashes to the same partition
    assert sum(sum(f.startswith(f"class=c{k}/") for f in made) == 1 for k in range(5)) >= 3
    assert spark.read.parquet(f"{tmp_dir}/split").count() == 40_000


def test_items_by_class_and_second(spark, tmp_dir):
    rows = spark.sql("""SELECT * FROM VALUES (1, 'facial', timestamp_ntz'2024-01-31 23:59:59.9'), (2, 'facial', timestamp_ntz'2024-01-31 23:59:59.1'),
        (3, 'nonfacial', timestamp_ntz'2024-01-31 23:59:59'), (4, 'facial', timestamp_ntz'2024-02-01 00:00:00'),
        (5, 'facial', null), (6, null, timestamp_ntz'2024-02-01 00:00:00') AS t(id, class, at)""")
    out = f"{tmp_dir}/items"
    write_by_class(rows, out, ts="at")
    back = spark.read.option("basePath", out).parquet(out)
    got = {r.id: (r["class"], r.second_key, r.item, r.at) for r in back.collect()}
    assert got[1][:3] == ("facial", "20240131235959", "webcam-facial-20240131235959")
    assert got[5][:3] == ("facial", None, "webcam-facial") and got[6][0] is None
    assert {r.id: (r["class"], r.at) for r in rows.collect()} == {k: (v[0], v[3]) for k, v in got.items()}
    found = read_item(back, "class", "facial", "20240131235959")
    assert sorted(r.id for r in found.collect()) == [1, 2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(class" in plan and "second_key" in plan.split("PushedFilters")[1]
    empty = f"{tmp_dir}/none"
    write_by_class(rows.limit(0), empty, ts="at")
    assert _files(empty) == [] or spark.read.parquet(empty).count() == 0
    with pytest.raises(ValueError, match="item"):
        write_by_class(rows.withColumn("Item", F.lit(1)), f"{tmp_dir}/clash", ts="at")


def test_tree_is_listed_level_by_level(spark, tmp_dir):
    root, names = f"{tmp_dir}/tree", ["a.png", "x/b.png", "x/y/c.PNG", "x/y/z/d e%20.png", "_hidden/e.png", "x/.f.png",
                                      "x/_g.png", "w/h.txt", "ü/i.png"]
    for n in names:
        os.makedirs(os.path.dirname(f"{root}/{n}"), exist_ok=True)
        with open(f"{root}/{n}", "w") as f:
            f.write("12345")
    os.makedirs(f"{root}/empty/below")
    listed = list_tree(spark, root, "*.png").collect()
    assert sorted(r.path for r in listed) == ["a.png", "x/b.png", "x/y/z/d e%20.png", "ü/i.png"]
    assert {r.length for r in listed} == {5}
    scanned = list_files(spark, root, "*.png").collect()
    assert sorted(r.name for r in listed) == sorted(r.name for r in scanned)
    assert {(r.name, r.modified.replace(microsecond=0)) for r in listed} == {(r.name, r.modified.replace(microsecond=0)) for r in scanned}
    assert list_tree(spark, f"{root}/empty").count() == 0
    with pytest.raises(FileNotFoundError):
        list_tree(spark, f"{root}/absent")


def test_console_and_foreach_batch_sinks(spark, tmp_dir):
    from emberwake.streaming import pipelines as ST
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.write.parquet(f"{tmp_dir}/in")
    st = ST.event_stream(spark, f"{tmp_dir}/in", ev.schema, files_per_trigger=1)
    assert dict(st.dtypes)["ts"] == "timestamp"
    q = st.writeStream.format("console").trigger(availableNow=True) \
        .option("checkpointLocation", f"{tmp_dir}/ck_console").option("numRows", 1).start()
    q.awaitTermination()
    seen = []
    ST.for_each_batch(st, lambda df, i: seen.append(df.count()), f"{tmp_dir}/ck_feb").awaitTermination()
    assert sum(seen) == ev.count()


def test_table_destination(spark):
    import uuid
    name = f"ew_t_{uuid.uuid4().hex[:8]}"
    df = spark.range(10).withColumn("v", F.col("id") * 1.5)
    assert write_table(df, Destination("table", table=name)) == 10
    assert spark.table(name).count() == 10
    with pytest.raises(AnalysisException):
        write_table(df, Destination("table", table=name))
    spark.sql(f"DROP TABLE {name}")


def test_reader_options(spark, tmp_dir):
    schema = T.StructType([
        T.StructField("d", T.DateType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("v", T.DoubleType()), T.StructField("s", T.StringType()),
    ])
    p = f"{tmp_dir}/opts.csv"
    with open(p, "w", encoding="latin-1") as f:
        f.write("d;ts;v;s\n"
                "31/12/2024;2024-12-31 23:59:58;nix;'caf\xe9 ''x'''\n"
                "01/01/2025;2025-01-01 00:00:01;plus;'a;b'\n"
                "02/01/2025;2025-01-02 10:00:00;minus;plain\n")
    df = read_delimited(spark, p, schema, sep=";", dateFormat="dd/MM/yyyy",
                        timestampNTZFormat="yyyy-MM-dd HH:mm:ss", nanValue="nix",
                        positiveInf="plus", negativeInf="minus", quote="'", escape="'",
                        encoding="iso-8859-1", maxColumns=10, maxCharsPerColumn=100)
    rows = df.orderBy("d").collect()
    import datetime as dt
    assert rows[0].d == dt.date(2024, 12, 31) and rows[0].ts == dt.datetime(2024, 12, 31, 23, 59, 58)
    assert math.isnan(rows[0].v) and rows[1].v == math.inf and rows[2].v == -math.inf
    assert rows[0].s == "caf\xe9 'x'" and rows[1].s == "a;b" and rows[2].s == "plain"


def test_load_job_command_line(spark, tmp_dir):
    """The spark-submit entry point, here with a parquet destination."""
    from emberwake.plans.load import main
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    data, spec = stage_as_csv(spark, orders, "t_cli")
    out = f"{tmp_dir}/cli_out"
    main(["--src_data_file", data, "--src_schema_file", spec, "--dest_format", "parquet",
          "--dest_path", out, "--write_mode", "error"])
    assert spark.read.parquet(out).count() == orders.count()
    with pytest.raises(ValueError):
        main(["--src_data_file", data, "--src_schema_file", spec, "--dest_format", "avro",
              "--dest_path", out])
