"""Streaming helpers that are not covered by the stream = batch queries."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from emberwake.plans import catalog
from emberwake.operators import events as E
from emberwake.operators.events import retain_newest
from emberwake.streaming.pipelines import (
    MergeSink, RetainSink, displacement_sink, last_per_second_sink, take_until_sink, throttle_sink,
)


def test_retain_sink_is_replay_safe(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    first = ev.filter(F.col("event_id") % 3 == 0)
    second = ev.filter(F.col("event_id") % 3 == 1)
    third = ev.filter(F.col("event_id") % 3 == 2)
    sink = RetainSink(f"{tmp_dir}/kept", "event_type", 7)
    sink(first, 0)
    sink(second, 1)
    sink(second, 1)        # the same micro-batch delivered again after a failure
    sink(third, 2)
    got = {r.event_id for r in sink.result(spark).collect()}
    want = {r.event_id for r in retain_newest(ev, "event_type", 7).collect()}
    assert got == want and len(got) == 7 * ev.select("event_type").distinct().count()


def test_retain_sink_fails_without_the_kept_table(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sink = RetainSink(f"{tmp_dir}/kept", "event_type", 7)
    sink(ev, 0)
    shutil.move(sink.path(0), f"{tmp_dir}/elsewhere")
    with pytest.raises(Exception):
        sink(ev, 1)
    assert not sink.complete(spark)


def test_staging_keeps_rows_without_a_time(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.col("ts"))).write.parquet(f"{tmp_dir}/events.parquet")
    path, schema, _, _ = catalog.stage_event_files(spark, tmp_dir, "staging_test")
    assert spark.read.schema(schema).parquet(path).count() == ev.count()


SAMPLES = "event_id long, key long, ts timestamp, value double, kind string"


def _samples(spark, n=600, seed=1, keys=(None, 1, 1, 1, 2, 3)):
    rnd = random.Random(seed)
    rows = sorted((rnd.randrange(200_000), i, rnd.choice(keys), rnd.choice("abcdefghij")) for i in range(n))
    return [spark.createDataFrame(
        [(i, k, t, float(i % 13), c) for t, i, k, c in rows[lo:lo + n // 4]],
        SAMPLES.replace("timestamp", "long")).withColumn("ts", F.timestamp_seconds("ts")) for lo in range(0, n, n // 4)]


def _all(batches):
    out = batches[0]
    for b in batches[1:]:
        out = out.union(b)
    return out


@pytest.mark.parametrize("kind", ["displacement", "take_until", "throttle"])
def test_state_carried_from_batch_to_batch(spark, tmp_dir, kind):
    """Batches in time order, one of them delivered twice, equal the whole table."""
    batches = _samples(spark)
    whole, order = _all(batches), ("ts", "event_id")
    if kind == "displacement":
        sink, want = displacement_sink(tmp_dir, "key", "value", "value"), E.displacement(whole, "key", "value", "value")
    elif kind == "take_until":
        stop = (F.col("kind") == "a") & (F.col("key") != 3)
        sink, want = take_until_sink(tmp_dir, "key", stop), E.take_until(whole, "key", stop, order)
    else:
        flags = dict(eligible=F.col("kind") != "b", force=F.col("kind") == "c", rewind=F.col("kind") == "d", rewind_delay=500)
        sink, want = throttle_sink(tmp_dir, "key", 3000, **flags), E.throttle(whole, "key", 3000, **flags)
    for n, b in enumerate(batches):
        sink(b, n)
        if n == 2:
            sink(b, n)
    got = sink.result(spark)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sink.kept.complete(spark) == [2, 3]


def test_state_expires(spark, tmp_dir):
    def rows(*found):
        return spark.createDataFrame([(i, k, t, 0.0, "a") for i, k, t in found], SAMPLES.replace("timestamp", "long")) \
            .withColumn("ts", F.timestamp_seconds("ts"))

    sink = throttle_sink(tmp_dir, "key", 10, ttl_seconds=100)
    sink(rows((1, 1, 0), (2, 2, 0)), 0)
    sink(rows((3, 2, 150)), 1)     # key 1 has been silent for more than 100 s
    assert {r.key for r in sink.state(spark, 1).collect()} == {2}
    sink(rows((4, 1, 160), (5, 1, 175), (6, 2, 165)), 2)
    assert {r.event_id for r in sink.result(spark).collect()} == {3, 5, 6}  # 4 starts key 1 anew


def test_half_a_batch_on_one_key_is_spread(spark, tmp_dir):
    rows = spark.range(8000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("key"),
                                    F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit(0.0).alias("value"))
    sink = throttle_sink(tmp_dir, "key", 600)
    own = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        sink(rows.limit(4000), 0)
        sink(rows.filter("event_id >= 4000"), 1)
        step = displacement_sink(tmp_dir + "/d", "key", "value", "value").step
        spread = step(rows, None)[0].filter("key = 1").groupBy(F.spark_partition_id()) \
            .agg(F.count("dx").alias("n")).filter("n > 0").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.parquet(sink.out.path(1)).filter("key = 1").select(F.input_file_name().alias("f")).distinct()
    assert out.count() > 4 and spread > 4


def test_merge_sink_keeps_few_folders(spark, tmp_dir):
    batches = _samples(spark, 200, seed=3) + _samples(spark, 200, seed=4) + _samples(spark, 200, seed=5)
    whole = _all(batches)
    sink = last_per_second_sink(f"{tmp_dir}/m", "kind")
    sink.fan = 2
    for n, b in enumerate(batches):
        sink(b, n)
        if n in (3, 7):
            sink(b, n)             # delivered again: the same folder and tiers
        assert len(sink.cover(spark, n)) == bin(n + 1).count("1")
    # 12 batches: tiers of 8 and 4, and what the last batch merged
    assert len(sink.cover(spark, 11)) == 2 and len(sink.folders(spark)) <= 8
    assert sorted(map(str, sink.result(spark).collect())) == sorted(map(str, E.last_per_second(whole, "kind").collect()))


def test_merge_sink_fails_when_a_folder_is_lost(spark, tmp_dir):
    sink = MergeSink(f"{tmp_dir}/m", lambda b: b, lambda r: r.groupBy("id").count().select("id"))
    for n in range(3):
        sink(spark.range(3), n)
    shutil.move(sink.path(1), f"{tmp_dir}/elsewhere")
    with pytest.raises(FileNotFoundError):
        sink(spark.range(3), 3)


def test_results_of_streams_without_a_batch(spark, tmp_dir):
    schema = _samples(spark, 8)[0].schema
    assert last_per_second_sink(f"{tmp_dir}/a", "kind").result(spark, schema).count() == 0
    assert RetainSink(f"{tmp_dir}/b", "kind").result(spark, schema).count() == 0
    assert throttle_sink(f"{tmp_dir}/c", "key", 5).result(spark, schema).count() == 0
    with pytest.raises(ValueError):
        RetainSink(f"{tmp_dir}/b", "kind").result(spark)
