"""Structured Streaming forms of the event operators.

* Stateless stages (masks, labels, look-ups) are the batch expressions applied
  to a streaming DataFrame; the key dimension is a stream-static broadcast join.
* Per-key sequence state (previous sample, stop flag, throttle timer) is a
  table of one row per key. Each micro-batch runs the batch operator over its
  rows and the state (``foreachBatch``), so a key with half of a micro-batch is
  spread like in a batch, and no frame of a key is ever built. Output and state
  are folders per batch: a retried batch reads the state before it and writes
  its own folders again. Keys silent for ``ttl_seconds`` of event time are
  forgotten and start anew.
* Aggregates that merge (tick flags, last per second) keep partial rows per
  batch, merged in tiers so that the number of folders grows with the logarithm
  of the batches.
* Retention keeps the newest N in a table rewritten per micro-batch; a batch
  never overwrites what it reads, and a retried batch rewrites the same folder.

Event time must be a ``TIMESTAMP`` (with zone); NTZ columns are cast in the
session zone by :func:`event_stream`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from emberwake.functions.scalars import DEFAULT_QUOTA
from emberwake.operators.events import (
    displacement, epoch_micros, last_per_second, retain_newest, take_until, tick_flags,
)
from emberwake.operators.throttle import throttle_from


# ---------------------------------------------------------------------------
# S12 source, K8/K9 sinks
# ---------------------------------------------------------------------------

def event_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 files_per_trigger: int | None = None, time_col: str = "ts") -> DataFrame:
    """Unbounded event source over a folder (S12). NTZ event time is cast to
    ``TIMESTAMP`` so watermarks can use it."""
    r = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(files_per_trigger))
    df = r.load(path)
    if time_col in df.columns and isinstance(df.schema[time_col].dataType, T.TimestampNTZType):
        df = df.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return df


def to_console(stream: DataFrame, name: str | None = None, checkpoint: str | None = None,
               mode: str = "append") -> StreamingQuery:
    """Print every event (K8)."""
    w = stream.writeStream.format("console").outputMode(mode).option("truncate", False)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.start()


def for_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Hand every micro-batch to a handler (K9)."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
             available_now: bool = True) -> StreamingQuery:
    """Exactly-once file sink in append mode."""
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


# ---------------------------------------------------------------------------
# Folders per micro-batch
# ---------------------------------------------------------------------------

class _BatchFolders:
    """One folder per micro-batch below ``base``: a retried batch overwrites its
    own folder, whatever was written of it."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def path(self, batch_id: int) -> str:
        return f"{self.base}/batch-{batch_id:012d}"

    def _files(self, spark: SparkSession):
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.base)
        return root.getFileSystem(spark._jsc.hadoopConfiguration()), root

    def complete(self, spark: SparkSession) -> list[int]:
        """Ids of the batches whose folder was written to the end."""
        fs, root = self._files(spark)
        if not fs.exists(root):
            return []
        found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "batch-*/_SUCCESS"))
        return sorted(int(f.getPath().getParent().getName().removeprefix("batch-")) for f in found)

    def expire(self, spark: SparkSession, below: int) -> None:
        fs, _ = self._files(spark)
        for b in self.complete(spark):
            if b < below:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(self.path(b)), True)


    def read(self, spark: SparkSession, paths: list[str], schema: T.StructType | None) -> DataFrame:
        """The folders' rows; without any, an empty table of ``schema``."""
        if paths:
            return spark.read.parquet(*paths)
        if schema is None:
            raise ValueError("the stream has had no batch: give the schema of the result")
        return spark.createDataFrame([], schema)


# ---------------------------------------------------------------------------
# State per key, carried by the batch operators
# ---------------------------------------------------------------------------

Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


class KeyedSink:
    """``foreachBatch`` handler for operators with a state per key.

    ``step(batch, state)`` gives the batch's output and the state after it; the
    state is None for the first batch, and its column ``seen`` holds the
    microsecond of the key's last event.
    """

    def __init__(self, base: str, step: Step, ttl_seconds: float | None = None):
        self.step, self.ttl = step, None if ttl_seconds is None else int(ttl_seconds * 1_000_000)
        self.out, self.kept = _BatchFolders(f"{base.rstrip('/')}/out"), _BatchFolders(f"{base.rstrip('/')}/state")

    def state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state after a batch, without the keys that have expired."""
        rows = spark.read.parquet(self.kept.path(batch_id))
        if self.ttl is None:
            return rows
        newest = rows.agg(F.max("seen")).first()[0]
        return rows if newest is None else rows.filter(F.col("seen") >= newest - self.ttl)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            out, after = self.step(batch, self.state(spark, batch_id - 1) if batch_id else None)
            out.write.mode("overwrite").parquet(self.out.path(batch_id))
            after.write.mode("overwrite").parquet(self.kept.path(batch_id))
        finally:
            batch.unpersist()
        self.kept.expire(spark, batch_id - 1)

    def result(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        return self.out.read(spark, [self.out.path(b) for b in self.out.complete(spark)], schema)


def _without(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key, null included, is not among ``keys``."""
    return rows.join(keys.select(F.col(key).alias("__gone")), F.col(key).eqNullSafe(F.col("__gone")), "left_anti")


def displacement_sink(base: str, key: str, x: str, y: str, order: Sequence[str] = ("ts", "event_id"),
                      bucket_width=60, ttl_seconds: float | None = None) -> KeyedSink:
    """Delta to the key's previous sample, across micro-batches. The state,
    a key's last sample, enters the batch ahead of the key's first row."""
    time, *rest = order

    def step(batch: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        rows = batch.withColumn("__own", F.lit(1))
        if state is not None:
            first = batch.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*order)).alias("__first"))
            carried = (state.join(first, F.col(key).eqNullSafe(F.col("__key")))
                       .select(key, *(F.col(last).alias(c) for c, last in {x: "last_x", y: "last_y"}.items()), "__first.*",
                               F.lit(0).alias("__own")))
            rows = rows.unionByName(carried, allowMissingColumns=True)
        out = (displacement(rows, key, x, y, (time, "__own", *rest), bucket_width)
               .filter("__own = 1").drop("__own"))
        point = F.struct(F.col(x).alias("last_x"), F.col(y).alias("last_y"))
        last = (batch.groupBy(key).agg(F.max_by(point, F.struct(*order)).alias("__last"),
                                       F.max(epoch_micros(batch, time)).alias("seen"))
                .select(key, "__last.*", "seen"))
        return out, last if state is None else last.unionByName(_without(state, key, last))

    return KeyedSink(base, step, ttl_seconds)


def take_until_sink(base: str, key: str, is_stop: Column, order: Sequence[str] = ("ts", "event_id"),
                    ttl_seconds: float | None = None) -> KeyedSink:
    """D3: rows until each key's first sentinel, inclusive. The state is the
    keys that have stopped."""
    def step(batch: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        live = batch if state is None else _without(batch, key, state)
        stopped = (live.filter(F.coalesce(is_stop, F.lit(False))).groupBy(key)
                   .agg(F.max(epoch_micros(batch, order[0])).alias("seen")))
        return take_until(live, key, is_stop, order), stopped if state is None else state.unionByName(stopped)

    return KeyedSink(base, step, ttl_seconds)


def throttle_sink(base: str, key: str, every_seconds: float, order: Sequence[str] = ("ts", "event_id"),
                  eligible: Column | None = None, force: Column | None = None, rewind: Column | None = None,
                  rewind_delay: float = 1.0, ttl_seconds: float | None = None) -> KeyedSink:
    """D3: the per-key throttle of ``operators.events.throttle`` on a stream;
    the state is the keys' timers."""
    def step(batch: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        time = epoch_micros(batch, order[0])
        passed, timers = throttle_from(batch, key, every_seconds, time, list(order), eligible, force, rewind, rewind_delay,
                                       None if state is None else state.select(key, "timer"))
        seen = batch.filter(time.isNotNull()).select(key, time.alias("seen"))
        seen = (seen if state is None else seen.unionByName(state.select(key, "seen"))) \
            .groupBy(F.col(key).alias("__key")).agg(F.max("seen").alias("seen"))
        return passed, timers.join(seen, F.col(key).eqNullSafe(F.col("__key"))).select(key, "timer", "seen")

    return KeyedSink(base, step, ttl_seconds)


# ---------------------------------------------------------------------------
# Retention on a stream
# ---------------------------------------------------------------------------

class RetainSink(_BatchFolders):
    """``foreachBatch`` handler keeping the newest ``quota`` rows per class.

    Batch b reads the table kept by batch b-1, and nothing else: a missing or
    unreadable one fails the batch. The folders of b-1 and b stay, older ones go.
    """

    def __init__(self, base: str, cls: str, quota=DEFAULT_QUOTA,
                 order: Sequence[str] = ("ts", "event_id")):
        super().__init__(base)
        self.cls, self.quota, self.order = cls, quota, list(order)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if batch_id > 0:
            rows = spark.read.parquet(self.path(batch_id - 1)).unionByName(batch)
        kept = retain_newest(rows, self.cls, self.quota, self.order)
        kept.write.mode("overwrite").parquet(self.path(batch_id))
        self.expire(spark, batch_id - 1)

    def result(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        return self.read(spark, [self.path(b) for b in self.complete(spark)[-1:]], schema)


# ---------------------------------------------------------------------------
# D4 / D5 without lateness: every group of every micro-batch, merged on reading
# ---------------------------------------------------------------------------

class MergeSink(_BatchFolders):
    """``foreachBatch`` handler for aggregates that merge.

    Each batch writes ``partial(batch)``; ``fan`` folders of a tier in a row are
    merged into one of the next, so that after n batches at most ``fan - 1``
    folders of each of log(n) tiers are read. ``result`` is ``merge`` of these.
    No group waits for a watermark and no late row is dropped. A retried batch
    writes its own folder and tiers again; folders that a tier holds go with the
    batch after.
    """

    def __init__(self, base: str, partial: Callable[[DataFrame], DataFrame],
                 merge: Callable[[DataFrame], DataFrame], fan: int = 8):
        super().__init__(base)
        self.partial, self.merge, self.fan = partial, merge, fan

    def tier(self, level: int, batch_id: int) -> str:
        """The folder of the ``fan ** level`` batches that end with this one."""
        return self.path(batch_id) if not level else f"{self.base}/tier-{level:03d}-{batch_id:012d}"

    def folders(self, spark: SparkSession) -> set[str]:
        """Folders that were written to the end."""
        fs, root = self._files(spark)
        if not fs.exists(root):
            return set()
        found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "*/_SUCCESS"))
        return {f"{self.base}/{f.getPath().getParent().getName()}" for f in found}

    def cover(self, spark: SparkSession, batch_id: int, have: set[str] | None = None) -> list[str]:
        """The folders that hold all batches up to this one, the widest first."""
        have, out, end = self.folders(spark) if have is None else have, [], batch_id
        while end >= 0:
            # the tiers below the widest one may be gone, so a gap in them ends nothing
            level, wider = 0, 1
            while (end + 1) % self.fan ** wider == 0:
                level, wider = wider if self.tier(wider, end) in have else level, wider + 1
            if self.tier(level, end) not in have:
                raise FileNotFoundError(self.tier(level, end))
            out.append(self.tier(level, end))
            end -= self.fan ** level
        return out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        have = self.folders(spark)
        if batch_id:
            used = set(self.cover(spark, batch_id - 1, have))
            fs, _ = self._files(spark)
            for folder in have:
                if folder not in used and int(folder.rsplit("-", 1)[1]) < batch_id:
                    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
        self.partial(batch).write.mode("overwrite").parquet(self.path(batch_id))
        level = 1
        while (batch_id + 1) % self.fan ** level == 0:
            below = [self.tier(level - 1, batch_id - k * self.fan ** (level - 1)) for k in range(self.fan)]
            self.merge(spark.read.parquet(*below)).write.mode("overwrite").parquet(self.tier(level, batch_id))
            level += 1

    def result(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """Without a batch so far, an empty table for a stream of ``schema``."""
        done = [int(f.rsplit("-", 1)[1]) for f in self.folders(spark)]
        if not done:
            return self.merge(self.partial(self.read(spark, [], schema)))
        return self.merge(spark.read.parquet(*self.cover(spark, max(done))))


def tick_flags_sink(base: str, key: str, ts: str, every: str, flags: dict[str, Column]) -> MergeSink:
    """Every tick's flags, the last open one and late rows included."""
    return MergeSink(
        base, lambda batch: tick_flags(batch, key, ts, every, flags),
        lambda rows: rows.groupBy(key, "tick_start", "tick_end").agg(*[F.bool_or(n).alias(n) for n in flags]))


def last_per_second_sink(base: str, cls: str, ts: str = "ts",
                         order: Sequence[str] = ("ts", "event_id")) -> MergeSink:
    """The newest row of every (class, second)."""
    return MergeSink(base, lambda batch: last_per_second(batch, cls, ts, order),
                     lambda rows: last_per_second(rows.drop("second_key"), cls, ts, order))
