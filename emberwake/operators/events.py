"""Event-table operators.

Scale rules followed throughout (one key may hold a third of all rows):

* Per-key "first/last/newest" questions are answered with partial aggregates
  (``max_by``/``min`` with map-side combine) or ``row_number() <= k``, which
  Spark plans as a partial ``WindowGroupLimit`` before the shuffle. A hot key
  then contributes at most k rows per task to the exchange.
* Per-row answers that depend on a per-key fact (take-until, eviction) join
  the rows with a small per-key table instead of a per-key window; AQE
  broadcasts that table when its measured size allows and otherwise splits
  skewed join partitions.
* Sequence questions (previous row, running maximum) are computed inside
  range buckets of (key, time) and stitched at bucket borders with a carry-in
  table, so a hot key is spread over as many tasks as it has buckets.
* The throttle is sequential by nature; ranges of rows exchange only their
  timers, through step functions that compose, so ranges run in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwake.functions.scalars import (
    DEFAULT_QUOTA, draw_hash, key_code_dimension, key_override, mask_match, mask_union as _mask_union, mask_without,
    norm, second_key,
)
from emberwake.operators import newest


def _cols(order: Sequence[str] | str) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def range_bucket(df: DataFrame, col: str, width) -> Column:
    """A bucket number that never decreases along ``col``.

    Time columns: ``width`` minutes (fractions allowed) of epoch microseconds,
    with no time-zone arithmetic for NTZ values. Numbers: ``width`` units.
    """
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.floor(epoch_micros(df, col) / F.lit(float(width) * 60_000_000))
    return F.floor(F.col(col) / F.lit(width))


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 of a time column (no zone arithmetic for NTZ)."""
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    return c.cast("long")


# ---------------------------------------------------------------------------
# Per-key sequence helpers that never put a whole key into one task
# ---------------------------------------------------------------------------

BUCKET = "__b"


def with_previous(df: DataFrame, key: str, values: Mapping[str, Column],
                  order: Sequence[str], bucket_width=60, out: str = "__prev") -> DataFrame:
    """Add ``out``: a struct of ``values`` taken from the key's previous row in
    ``order`` (null for the key's first row).

    ``lag`` runs inside (key, range bucket) windows. Each bucket's carry-in,
    the last row of the key's previous non-empty bucket, comes from a
    per-(key, bucket) summary (partial ``max_by``, ``lag`` over the small
    summary) and enters the bucket's window as a marker row ordered first, so
    the first real row lags onto it; markers are dropped afterwards. A hot key
    is spread over as many tasks as it has buckets, and a null key is one
    group, as in any window.
    """
    order = _cols(order)
    base = df.withColumn(BUCKET, range_bucket(df, order[0], bucket_width))
    point = F.struct(*[c.alias(n) for n, c in values.items()])
    last = base.groupBy(key, BUCKET).agg(F.max_by(point, F.struct(*order)).alias("__pt"))
    carry = (last.select(key, BUCKET, F.lag("__pt").over(
        Window.partitionBy(key).orderBy(BUCKET)).alias("__pt"))
        .filter(F.col("__pt").isNotNull())
        .withColumn("__mk", F.lit(0)))
    rows = base.withColumn("__pt", point).withColumn("__mk", F.lit(1))
    w = Window.partitionBy(key, BUCKET).orderBy("__mk", *order)
    return (rows.unionByName(carry, allowMissingColumns=True)
            .withColumn(out, F.lag("__pt").over(w))
            .filter(F.col("__mk") == 1)
            .drop("__pt", "__mk", BUCKET))


# ---------------------------------------------------------------------------
# Displacement between consecutive samples of a key
# ---------------------------------------------------------------------------

def displacement(df: DataFrame, key: str, x: str, y: str,
                 order: Sequence[str] = ("ts", "event_id"), bucket_width=60) -> DataFrame:
    """Add ``dx, dy, distance`` to every row: the delta to the key's previous
    sample in ``order``. A key's first sample only seeds (nulls)."""
    prev = with_previous(df, key, {"x": F.col(x), "y": F.col(y)}, order, bucket_width)
    dx = F.col(x) - F.col("__prev.x")
    dy = F.col(y) - F.col("__prev.y")
    return (prev.withColumn("dx", dx).withColumn("dy", dy)
            .withColumn("distance", norm(F.col("dx"), F.col("dy")))
            .select(*df.columns, "dx", "dy", "distance"))


def moved(df: DataFrame, distance: str = "distance") -> DataFrame:
    """Keep rows with a positive displacement."""
    return df.filter(F.col(distance) > 0)


# ---------------------------------------------------------------------------
# Newest-N retention per class
# ---------------------------------------------------------------------------

def _quota(cls: str, quota) -> tuple[Column, int]:
    if isinstance(quota, Mapping):
        expr = None
        for k, v in quota.items():
            expr = (F.when(F.col(cls) == F.lit(k), F.lit(int(v))) if expr is None
                    else expr.when(F.col(cls) == F.lit(k), F.lit(int(v))))
        default = DEFAULT_QUOTA if None not in quota else int(quota[None])
        expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
        return expr, max([default] + [int(v) for v in quota.values()])
    return F.lit(int(quota)), int(quota)


def retain_newest(df: DataFrame, cls: str, quota=DEFAULT_QUOTA,
                  order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Keep the newest ``quota`` rows per class (``quota`` may be a per-class
    mapping; 0 keeps none). Up to ``newest.TOP_K`` ``row_number() <= k`` is
    planned as a partial top-k before the shuffle, so a hot class ships only k
    rows per task; larger quotas are selected by histograms, without sorting a
    class (see :mod:`emberwake.operators.newest`; these passes run when this is
    called). Rows equal in ``order`` are told apart by a hash of the whole row."""
    order = _cols(order)
    q, qmax = _quota(cls, quota)
    if qmax > newest.TOP_K:
        return newest.parted(df, cls, q, order)[0]
    ranked = newest.ranked(newest.total_order(df), cls, order, qmax)
    return ranked.filter(F.col("__rn") <= q).select(*df.columns)


def evicted(df: DataFrame, cls: str, quota=DEFAULT_QUOTA,
            order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The complement of :func:`retain_newest`: rows past the quota (the
    delete list). Per class, the oldest kept row is a threshold; rows older
    than it go. Built from the kept rows (k per class), never a full-class
    window. Of identical rows at the threshold as many go as were not kept."""
    order = _cols(order)
    q, qmax = _quota(cls, quota)
    if qmax > newest.TOP_K:
        return newest.parted(df, cls, q, order)[1]
    rows = newest.total_order(df)
    place = F.struct(*order, newest.HASH)
    kept = (newest.ranked(rows, cls, order, qmax).filter(F.col("__rn") <= q)
            .groupBy(cls, place.alias("__at")).agg(F.count(F.lit(1)).alias("__stay")))
    oldest = (kept.groupBy(cls).agg(F.min(F.struct("__at", "__stay")).alias("__oldest"))
              .select(F.col(cls).alias("__tcls"), "__oldest.*"))
    joined = rows.join(oldest, rows[cls].eqNullSafe(oldest["__tcls"]), "left")
    older = joined.filter((q <= 0) | (place < F.col("__at"))).select(*df.columns)
    tied = (joined.filter((q > 0) & (place == F.col("__at"))).groupBy(*df.columns, "__stay")
            .agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > F.col("__stay"))
            .withColumn("__k", F.explode(F.sequence(F.lit(1), (F.col("__n") - F.col("__stay")).cast("int")))))
    return older.unionByName(tied.select(*df.columns))


def draw_rows(df: DataFrame, n: int, ids: Sequence[str] | str, seed: int = 0, cls: str | None = None) -> DataFrame:
    """``n`` rows drawn without replacement (T3), of each class with ``cls``: those
    whose number drawn by ``seed`` and ``ids`` is largest, so the sample is the same
    under any partitioning and merges from parts (a part's ``n`` largest hold all
    that it can give). Fewer rows than ``n``: all of them. Rows that share their
    ``ids`` have one number and are told apart by a hash of the whole row.

    A selection like :func:`retain_newest`: a partial top-k, or histogram passes
    for a large ``n``; no class is sorted.
    """
    drawn = df.withColumn("__draw", draw_hash(seed, *[F.col(c) for c in _cols(ids)]))
    if cls is None:
        drawn = drawn.withColumn("__all", F.lit(0))
    return retain_newest(drawn, cls or "__all", n, order=("__draw",)).select(*df.columns)


def excess_counts(df: DataFrame, cls: str, quota=DEFAULT_QUOTA) -> DataFrame:
    """Rows per class and how many exceed the quota (A2)."""
    q, _ = _quota(cls, quota)
    return (df.groupBy(cls).agg(F.count(F.lit(1)).alias("n_items"))
            .withColumn("quota", q)
            .withColumn("excess", F.greatest(F.col("n_items") - F.col("quota"), F.lit(0)).cast("long")))


# ---------------------------------------------------------------------------
# Last write wins within class + second
# ---------------------------------------------------------------------------

def last_per_second(df: DataFrame, cls: str, ts: str = "ts",
                    order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """One row per (class, second): the newest row of that second.

    A partial ``max_by`` aggregate: each task combines its rows before the
    shuffle, so the exchange carries at most one row per (class, second, task).
    """
    order = _cols(order)
    rest = [c for c in df.columns if c != cls]
    # group by the integer second; the 14-digit key is formatted once per group
    # from the kept row's own time (same second), not once per row
    keyed = df.withColumn("__sec", F.floor(epoch_micros(df, ts) / F.lit(1_000_000)))
    return (keyed.groupBy(cls, "__sec")
            .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__last"))
            .select(cls, second_key(F.col(f"__last.{ts}")).alias("second_key"), "__last.*"))


# ---------------------------------------------------------------------------
# Take rows until a sentinel, inclusive
# ---------------------------------------------------------------------------

def take_until(df: DataFrame, key: str | None, is_stop: Column,
               order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Rows of each key up to and including its first sentinel row; keys with
    no sentinel keep every row.

    The first sentinel per key is a partial ``min`` aggregate over the sentinel
    rows only; rows are then joined with it (AQE broadcasts the per-key table
    when small, splits skewed partitions otherwise). Without a key the first
    sentinel is one row and is broadcast.
    """
    order = _cols(order)
    pos = F.struct(*[F.col(c) for c in order])
    # a filter drops null predicates, and a plain comparison reaches the scan
    stop_rows = df.filter(is_stop)
    if key is None:
        first = stop_rows.agg(F.min(pos).alias("__stop")).withColumn("__one", F.lit(1))
        joined = df.withColumn("__one", F.lit(1)).join(F.broadcast(first), "__one", "left")
        joined = joined.drop("__one")
    else:
        first = (stop_rows.groupBy(key).agg(F.min(pos).alias("__stop"))
                 .withColumnRenamed(key, "__skey"))
        # null-safe: a null key is a group of its own, as in a window
        joined = df.join(first, df[key].eqNullSafe(first["__skey"]), "left").drop("__skey")
    keep = F.col("__stop").isNull() | (pos <= F.col("__stop"))
    return joined.filter(keep).select(*df.columns)


# ---------------------------------------------------------------------------
# First item per owner by a two-tier priority
# ---------------------------------------------------------------------------

def top_priority(items: DataFrame, owner: str, low_prio: Column, pos: str) -> DataFrame:
    """Per owner, the first item among high-priority items (``low_prio`` false)
    by ``pos``, else the first low-priority one (W5). Partial ``min_by``."""
    rest = [c for c in items.columns if c != owner]
    tiered = items.withColumn("__low", F.coalesce(low_prio, F.lit(True)))
    return (tiered.groupBy(owner)
            .agg(F.min_by(F.struct(*rest), F.struct("__low", pos)).alias("__top"))
            .select(owner, "__top.*"))


def first_item_of_active(owners: DataFrame, items: DataFrame, owner: str, active: Column,
                         owner_pos: str, low_prio: Column, pos: str) -> DataFrame:
    """The top item of the *first* active owner only.

    The first active owner is one row (a global ``min_by``), broadcast into a
    semi join, so items are filtered where they lie without a shuffle.
    """
    first = (owners.filter(F.coalesce(active, F.lit(False)))
             .agg(F.min_by(F.col(owner), F.col(owner_pos)).alias(owner))
             .filter(F.col(owner).isNotNull()))
    mine = items.join(F.broadcast(first), owner, "left_semi")
    return top_priority(mine, owner, low_prio, pos)


# ---------------------------------------------------------------------------
# Code -> name look-up with the code itself as fallback
# ---------------------------------------------------------------------------

def label_lookup(df: DataFrame, code: str, dim: DataFrame | None = None,
                 out: str = "key_name") -> DataFrame:
    """Left join with a code -> name dimension; unknown codes keep their own
    value as the name. The built-in key dimension has a fixed 74 rows and is
    broadcast; how a caller's dimension is joined follows from Spark's own size
    threshold and the measured sizes (AQE)."""
    custom = dim is not None
    if dim is None:
        dim = F.broadcast(key_code_dimension(df.sparkSession))
    d = dim.select(F.col("code").alias("__code"), F.col("name").alias("__name"))
    if custom:  # a code given several times has its smallest name
        d = d.groupBy("__code").agg(F.min("__name").alias("__name"))
    joined = df.join(d, F.col(code) == F.col("__code"), "left")
    return (joined.withColumn(out, F.coalesce(F.col("__name"), F.col(code).cast("string")))
            .drop("__code", "__name"))


def key_names(df: DataFrame, key_code: str, char: str, out: str = "key_name") -> DataFrame:
    """The name of a key event (R19, then J1): two key codes override the
    character; a character of one sign is then looked up in the built-in
    dimension by its code point, and one without a name there is its own name."""
    d = F.broadcast(key_code_dimension(df.sparkSession))
    d = d.select(F.col("code").alias("__code"), F.col("name").alias("__name"))
    said = df.withColumn("__char", key_override(F.col(key_code), F.col(char)))
    point = F.when(F.length("__char") == 1, F.ascii("__char"))
    return (said.withColumn("__point", point).join(d, F.col("__point") == F.col("__code"), "left")
            .withColumn(out, F.coalesce("__name", "__char")).drop("__char", "__point", "__code", "__name"))


# ---------------------------------------------------------------------------
# Type masks
# ---------------------------------------------------------------------------

def mask_filter(df: DataFrame, code: str, mask: int, drop_types=()) -> DataFrame:
    """Keep events whose type bit is in ``mask`` after XOR-removing ``drop_types``."""
    return df.filter(mask_match(F.col(code), mask_without(mask, drop_types)))


def mask_union(df: DataFrame, key: str | None, code: str, out: str = "mask") -> DataFrame:
    """OR of type bits per key (partial ``bit_or``)."""
    agg = _mask_union(F.col(code)).alias(out)
    return df.agg(agg) if key is None else df.groupBy(key).agg(agg)


# ---------------------------------------------------------------------------
# A4: per-tick flags
# ---------------------------------------------------------------------------

def tick_flags(df: DataFrame, key: str, ts: str, every: str,
               flags: Mapping[str, Column]) -> DataFrame:
    """Per key and tumbling tick: whether any event of each kind happened.

    Flags reset at each tick because each tick is its own group. Partial
    ``bool_or`` aggregates; no per-key window.
    """
    aggs = [F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()]
    return (df.groupBy(key, F.window(ts, every).alias("__tick")).agg(*aggs)
            .select(key, F.col("__tick.start").alias("tick_start"),
                    F.col("__tick.end").alias("tick_end"), *flags.keys()))


# ---------------------------------------------------------------------------
# Throttle -- pass at most one event per period, the timer resetting on pass
# ---------------------------------------------------------------------------

def throttle(df: DataFrame, key: str, every_seconds: float,
             order: Sequence[str] = ("ts", "event_id"),
             eligible: Column | None = None, force: Column | None = None,
             rewind: Column | None = None, rewind_delay: float = 1.0,
             partitions: int | None = None, fan: int = 64) -> DataFrame:
    """Events that pass a per-key throttle (W6): the key's first event starts
    the timer and is not emitted; a later ``eligible`` event passes when more
    than ``every_seconds`` have elapsed since the timer was last set, and sets
    it. ``force`` rows pass without touching the timer; ``rewind`` rows pass
    and set the timer so the next timed pass is due ``rewind_delay`` seconds
    later. Ineligible rows never pass by time (the key-up rule).

    The first ``order`` column is the time: a timestamp, a date, or a number
    taken as microseconds.

    Exact, and parallel inside a key: rows are dealt evenly to ``partitions``
    ranges (the session's shuffle partitions unless given), whose effects on the
    timer are composed ``fan`` at a time (see :mod:`emberwake.operators.throttle`).
    The first pass runs when this is called.
    """
    from emberwake.operators.throttle import throttle as by_ranges
    order = _cols(order)
    return by_ranges(df, key, every_seconds, epoch_micros(df, order[0]), order,
                     eligible=eligible, force=force, rewind=rewind,
                     rewind_delay=rewind_delay, partitions=partitions, fan=fan)
