"""One key holding a large share of the rows must not land in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberwake.operators import events as E

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def _no_coalescing(spark):
    # tiny test data would be coalesced into a few partitions; keep all 8 so
    # partition ids show how rows are spread
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def _hot(spark, n=20_000, hot_every=2):
    # key 0 holds half the rows, spread over ~2 days; other keys share the rest
    return (spark.range(n)
            .select(F.col("id").alias("event_id"),
                    F.when(F.col("id") % hot_every == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1)
                    .alias("user_id"),
                    (F.lit(T0) + F.make_interval(secs=F.col("id") * 9)).cast("timestamp_ntz").alias("ts"),
                    (F.col("id") % 7).cast("double").alias("value"),
                    F.when(F.col("id") % 5 == 0, "error").otherwise("view").alias("event_type")))


def test_displacement_spreads_hot_key(spark):
    df = _hot(spark)
    out = E.displacement(df, "user_id", "value", "value", bucket_width=60) \
        .withColumn("pid", F.spark_partition_id())
    # collect the unfiltered plan: a filter on the key would be pushed below the window
    rows = [r for r in out.select("user_id", "ts", "event_id", "value", "dx", "pid").collect()
            if r.user_id == 0]
    assert len({r.pid for r in rows}) > 4
    # exact: each hot-key row's delta equals the previous hot-key row's value difference
    rows.sort(key=lambda r: (r.ts, r.event_id))
    assert rows[0].dx is None
    assert all(b.dx == b.value - a.value for a, b in zip(rows, rows[1:]))


def test_throttle_spreads_dense_hot_key(spark):
    df = _hot(spark)
    # hot-key events are 18 s apart and the period is 100 s: the rule chains
    # through the whole key; its ranges still run in parallel, exactly
    out = E.throttle(df, "user_id", 100, partitions=16).withColumn("pid", F.spark_partition_id())
    hot = sorted((r for r in out.select("user_id", "ts", "pid").collect() if r.user_id == 0),
                 key=lambda r: r.ts)
    assert len({r.pid for r in hot}) > 4
    times = sorted(r.ts for r in df.filter("user_id = 0").select("ts").collect())
    want, last = [], times[0]
    for t in times[1:]:
        if (t - last).total_seconds() > 100:
            want.append(t)
            last = t
    assert [r.ts for r in hot] == want


def test_retain_newest_plans_partial_top_k(spark):
    df = _hot(spark)
    plan = E.retain_newest(df, "user_id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
