"""Per-key throttle (W6) over row-balanced ranges, as a parallel prefix.

Rule, per key in (time, id) order, with timer ``L``:

* the key's first event seeds the timer (``L = t``) and is not emitted;
* an ``eligible`` event with ``t - L > period`` passes and sets ``L = t``;
* a ``force`` event passes without touching the timer;
* a ``rewind`` event passes and sets ``L = t - period + rewind_delay``, so the
  next timed pass is due ``rewind_delay`` later.

The rule is sequential, but what a stretch of rows does to the timer is a step
function: the entry timer decides which row passes first, and from there the
chain is fixed; an entry too late for any row of the stretch leaves as it came.
Such functions compose.

1. Rows are range-partitioned and sorted by (key, time, order), so partitions
   are even in rows and a key with a third of them has a third of the
   partitions. A key that starts inside a partition is replayed at once. Only
   the first key of a partition may have begun before it: its rows are kept as
   they are, with the step function of the stretch. All of this is one written
   table.
2. Functions are composed in groups of ``FAN`` neighbours, and these again,
   until one group is left for a key; then the entries are handed down the same
   way, each level in parallel. There is one function a partition; it is stored
   in rows of at most ``SEGMENT`` steps.
3. The kept rows, at most one key's of a partition, are replayed from their
   entries, one task for a partition.

Rows without a time neither pass by time nor set the timer; a forced one passes.
A null key is a group, as in Spark's grouping. ``initial`` timers (one row a key)
stand for the rows before; :func:`throttle_from` returns the timers afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwake.session import scratch_path

OLD = -(1 << 62)          # a timer so old that every eligible row passes
SAME = 1 << 62            # the step whose entries leave as they came
FAN = 64                  # functions that one task composes
SEGMENT = 1 << 16         # steps of a stored row
ROW, KEPT, STEPS, TIMER = range(4)   # kinds of rows that step 1 writes
STEP_FIELDS = [("__part", T.IntegerType()), ("__segment", T.IntegerType()), ("__seed_exit", T.LongType()),
               ("__dom", T.ArrayType(T.LongType())), ("__cod", T.ArrayType(T.LongType()))]
RULE_FIELDS = [("__t", T.LongType()), ("__elig", T.BooleanType()), ("__force", T.BooleanType()),
               ("__rewind", T.BooleanType())]
Steps = tuple[np.ndarray, np.ndarray]


def _arrow_type(dt: T.DataType):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(dt)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


def _batch(schema: T.StructType, columns: dict[str, object], rows: int):
    """A record batch of ``schema``; columns not given are null."""
    import pyarrow as pa
    types = {f.name: _arrow_type(f.dataType) for f in schema.fields}
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns.get(n), pa.Array) else pa.nulls(rows, t) if c is None else pa.array(c, type=t)
         for n, t in types.items()], names=list(types))


def _runs(column) -> list[tuple[int, int]]:
    """Runs of equal values of a column. Values are compared by dictionary
    codes, so integers beside a null keep all their digits and NaN equals
    itself, as in Spark's grouping."""
    code = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
    start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return list(zip(start.tolist(), [*start[1:].tolist(), len(code)]))


def _same(a, b) -> bool:
    """Whether two keys are one group: null and NaN equal themselves."""
    return a == b or (a != a and b != b)


def _next_true(mask: np.ndarray) -> np.ndarray:
    """Index of the next True at or after each position; ``len`` if none. One
    extra trailing entry (``len``) so ``i + 1`` lookups stay in range."""
    n = len(mask)
    idx = np.where(mask, np.arange(n), n)
    out = np.empty(n + 1, dtype=np.int64)
    out[n] = n
    out[:n] = np.minimum.accumulate(idx[::-1])[::-1]
    return out


# ---------------------------------------------------------------------------
# step functions of the timer
# ---------------------------------------------------------------------------

def steps_of(t, elig, rew, period, rewind_us) -> Steps:
    """(starts, exits) of the steps of a stretch of rows: an entry timer leaves
    with the exit of the last step that starts at or before it."""
    n = len(t)
    lval = np.where(rew, t - period + rewind_us, t)
    next_elig, next_rew = _next_true(elig), _next_true(rew)
    # where the chain that sets the timer at a row ends: the next setter, doubled
    after = np.maximum(np.searchsorted(t, lval + period, side="right"), np.arange(1, n + 1))
    nxt = np.minimum(next_rew[1:], next_elig[after])
    end = np.where(nxt < n, nxt, np.arange(n))
    while True:
        further = end[end]
        if np.array_equal(further, end):
            break
        end = further
    exits = lval[end]
    first_rew = int(next_rew[0])
    due = np.flatnonzero(elig[:first_rew])
    due = due[np.r_[True, t[due][1:] != t[due][:-1]]] if len(due) else due
    dom = np.r_[OLD, t[due] - period].astype(np.int64)
    cod = np.r_[exits[due], exits[first_rew] if first_rew < n else SAME].astype(np.int64)
    return merged(dom, cod)


def merged(dom: np.ndarray, cod: np.ndarray) -> Steps:
    """Neighbouring steps of one exit as one."""
    first = np.r_[True, cod[1:] != cod[:-1]]
    return dom[first], cod[first]


def applied(g: Steps, timers: np.ndarray) -> np.ndarray:
    out = g[1][np.searchsorted(g[0], timers, side="right") - 1]
    return np.where(out == SAME, timers, out)


def composed(f: Steps, g: Steps) -> Steps:
    """First ``f``, then ``g``. Only the last step can be SAME."""
    dom, cod = f
    if cod[-1] != SAME:
        return merged(dom, applied(g, cod))
    at = int(np.searchsorted(g[0], dom[-1], side="right")) - 1
    return merged(np.r_[dom, g[0][at + 1:]], np.r_[applied(g, cod[:-1]), g[1][at:]])


def replay(t, elig, force, rew, seed_first, last, period, rewind_us):
    """Keep flags of one run of rows from timer ``last``; returns (keep, last)."""
    n = len(t)
    keep = np.zeros(n, dtype=bool)
    lval = np.where(rew, t - period + rewind_us, t)
    next_elig = _next_true(elig)
    next_rew = _next_true(rew)
    i = 0
    if seed_first and n:
        last = int(lval[0])
        keep[0] = bool(rew[0])
        i = 1
    while i < n:
        j = i + int(np.searchsorted(t[i:], last + period, side="right"))
        j = int(next_elig[j]) if j < n else n
        r = int(next_rew[i])
        if r < min(j, n):              # a rewind before the next timed pass
            last = int(lval[r])
            keep[r] = True
            i = r + 1
        elif j < n:                    # the next timed pass
            last = int(lval[j])
            keep[j] = True
            i = j + 1
        else:
            break
    return keep | force, last


# ---------------------------------------------------------------------------
# step 1: one pass over a sorted range
# ---------------------------------------------------------------------------

def _rule_columns(rb) -> list[np.ndarray]:
    return [rb.column(rb.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n, _ in RULE_FIELDS]


def _step_rows(key: str, names: list, found: list[tuple]) -> dict:
    """Columns of step rows of (key, position, seed exit, steps)."""
    rows = []
    for k, pos, seed, (dom, cod) in found:
        rows += [(k, pos, at // SEGMENT, seed, dom[at:at + SEGMENT], cod[at:at + SEGMENT])
                 for at in range(0, len(dom), SEGMENT)]
    return dict(zip([key, *names], map(list, zip(*rows)))) if rows else {n: [] for n in [key, *names]}


def _first_pass(key: str, schema: T.StructType, out_cols: list[str], period: int, rewind_us: int):
    import pyarrow as pa

    step_names = [n for n, _ in STEP_FIELDS]

    def stretch(k, part, last, steps):
        rows = _step_rows(key, step_names, [(k, part, last, steps)])
        return _batch(schema, rows | {"__kind": [STEPS] * len(rows[key])}, len(rows[key]))

    def run(batches: Iterator) -> Iterator:
        part = TaskContext.get().partitionId()
        started = is_open = False       # is_open: the run may have begun before this partition
        now = steps = None              # the run's key; its steps, if it is open
        last, timers = OLD, []          # its timer, of an open run as if it began here
        for rb in batches:
            if not rb.num_rows:
                continue
            column = rb.column(rb.schema.get_field_index(key))
            t, elig, force, rew = _rule_columns(rb)
            mark = rb.column(rb.schema.get_field_index("__initial")).to_numpy(zero_copy_only=False)
            keep, kept = np.zeros(rb.num_rows, bool), np.zeros(rb.num_rows, bool)
            for a, b in _runs(column):
                value = column[a].as_py()
                begins = not (started and _same(value, now))
                if begins:
                    if is_open:
                        yield stretch(now, part, last, steps)
                    elif started:
                        timers.append((now, last))
                    is_open = not started and not mark[a]
                    started, now, steps = True, value, None
                    if mark[a]:
                        last, a, begins = int(t[a]), a + 1, False
                    if a == b:
                        continue
                rows = slice(a, b)
                flags, last = replay(t[rows], elig[rows], force[rows], rew[rows], begins, last, period, rewind_us)
                if is_open:
                    kept[rows] = True
                    f = steps_of(t[rows], elig[rows], rew[rows], period, rewind_us)
                    steps = f if steps is None else composed(steps, f)
                else:
                    keep[rows] = flags
            for kind, which in ((ROW, keep), (KEPT, kept)):
                if which.any():
                    some = rb.filter(pa.array(which))
                    names = out_cols + ([n for n, _ in RULE_FIELDS] if kind == KEPT else [])
                    columns = {n: some.column(some.schema.get_field_index(n)) for n in names}
                    if kind == KEPT:
                        columns["__part"] = [part] * some.num_rows
                    yield _batch(schema, columns | {"__kind": [kind] * some.num_rows}, some.num_rows)
        if started:
            # the last run may go on in the next partition; a timer that is known is a constant function
            yield stretch(now, part, last, steps if is_open else (np.array([OLD]), np.array([last])))
        if timers:
            yield _batch(schema, {key: [k for k, _ in timers], "__seed_exit": [x for _, x in timers],
                                  "__kind": [TIMER] * len(timers)}, len(timers))

    return run


# ---------------------------------------------------------------------------
# step 2: composing functions up, handing entries down
# ---------------------------------------------------------------------------

def _stretches(batches: Iterator, key: str) -> Iterator[tuple]:
    """(key, group, position, entry, seed, seed exit, steps) of each stretch of
    sorted step rows, its segments put together; steps are None for a marker."""
    held = None
    for rb in batches:
        for r in rb.to_pylist():
            dom, cod = (None, None) if r["__dom"] is None else (np.array(r["__dom"], np.int64), np.array(r["__cod"], np.int64))
            if held and dom is not None and held[6] is not None and held[2] == r["__part"] and _same(held[0], r[key]):
                held = (*held[:6], (np.r_[held[6][0], dom], np.r_[held[6][1], cod]))
                continue
            if held:
                yield held
            held = (r[key], r["__group"], r["__part"], r["__entry"], r["__seed"], r["__seed_exit"],
                    None if dom is None else (dom, cod))
    if held:
        yield held


def _up(key: str, schema: T.StructType):
    """One function per (key, group) of those of its members."""
    names = [n for n, _ in STEP_FIELDS]

    def run(batches: Iterator) -> Iterator:
        now, seed, steps = None, OLD, None
        for k, group, _, _, _, seed_exit, f in _stretches(batches, key):
            if now and now[1] == group and _same(now[0], k):
                seed, steps = int(applied(f, np.array([seed]))[0]), composed(steps, f)
                continue
            if now:
                rows = _step_rows(key, names, [(*now, seed, steps)])
                yield _batch(schema, rows, len(rows[key]))
            now, seed, steps = (k, group), seed_exit, f
        if now:
            rows = _step_rows(key, names, [(*now, seed, steps)])
            yield _batch(schema, rows, len(rows[key]))

    return run


def _down(key: str, schema: T.StructType):
    """Entry and exit of every member of a group; a group without a marker
    begins with its key's first stretch."""
    def run(batches: Iterator) -> Iterator:
        out: list[tuple] = []
        now, timer, seed = None, OLD, True
        for k, group, pos, entry, is_seed, seed_exit, f in _stretches(batches, key):
            if not (now and now[1] == group and _same(now[0], k)):
                now, timer, seed = (k, group), OLD, True
            if f is None:
                timer, seed = entry, is_seed
                continue
            leaves = seed_exit if seed else int(applied(f, np.array([timer]))[0])
            out.append((k, pos, timer, seed, leaves))
            timer, seed = leaves, False
            if len(out) >= 4096:
                yield _batch(schema, dict(zip(schema.names, map(list, zip(*out)))), len(out))
                out = []
        if out:
            yield _batch(schema, dict(zip(schema.names, map(list, zip(*out)))), len(out))

    return run


def _entries(steps: DataFrame, key: str, positions: int, fan: int) -> DataFrame:
    """key, __part, __entry, __seed, __exit of every stretch; positions are
    below ``positions``."""
    kind = steps.schema[key].dataType
    up_schema = _schema((key, kind), *STEP_FIELDS)
    entry_schema = _schema((key, kind), ("__part", T.IntegerType()), ("__entry", T.LongType()),
                           ("__seed", T.BooleanType()), ("__exit", T.LongType()))
    members = (steps.withColumn("__group", F.expr(f"__part div {fan}").cast("int"))
               .withColumn("__entry", F.lit(None).cast("long")).withColumn("__seed", F.lit(None).cast("boolean"))
               .select(key, "__group", "__part", "__segment", "__entry", "__seed", "__seed_exit", "__dom", "__cod"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(key, "__group").sortWithinPartitions(
            key, "__group", F.col("__part").asc_nulls_first(), "__segment")

    if positions > fan:
        above = dealt(members).mapInArrow(_up(key, up_schema), up_schema)
        markers = _entries(above, key, -(-positions // fan), fan)
        members = members.unionByName(
            markers.select(key, F.col("__part").alias("__group"), "__entry", "__seed"), allowMissingColumns=True)
    return dealt(members).mapInArrow(_down(key, entry_schema), entry_schema)


# ---------------------------------------------------------------------------
# step 3: the kept rows from their entries
# ---------------------------------------------------------------------------

def _replay_fn(period: int, rewind_us: int, out_cols: list[str]):
    """Rows sorted by partition of step 1 and order; each holds its entry."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        now, last = None, OLD
        for rb in batches:
            if not rb.num_rows:
                continue
            ix = rb.schema.get_field_index
            t, elig, force, rew = _rule_columns(rb)
            part, entry, seed = (rb.column(ix(c)).to_numpy(zero_copy_only=False) for c in ("__part", "__entry", "__seed"))
            keep = np.zeros(rb.num_rows, dtype=bool)
            for a, b in _runs(rb.column(ix("__part"))):
                begins = now != part[a]
                if begins:
                    now, last = part[a], int(entry[a])
                rows = slice(a, b)
                keep[rows], last = replay(t[rows], elig[rows], force[rows], rew[rows],
                                          begins and bool(seed[a]), last, period, rewind_us)
            if keep.any():
                passed = rb.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([passed.column(ix(c)) for c in out_cols], names=out_cols)
    return run


# ---------------------------------------------------------------------------
# the operator
# ---------------------------------------------------------------------------

def throttle_from(df: DataFrame, key: str, every_seconds: float, time_micros: Column,
                  order: Sequence[str], eligible: Column | None = None,
                  force: Column | None = None, rewind: Column | None = None,
                  rewind_delay: float = 1.0, initial: DataFrame | None = None,
                  partitions: int | None = None, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(the rows that pass, the timers afterwards: the key and ``timer``, one
    row for every key of ``df`` and ``initial``). Step 1 runs at once; its table
    lies in the shared folder."""
    if rewind_delay > every_seconds:
        raise ValueError("rewind_delay must not exceed the period")
    period = int(round(every_seconds * 1_000_000))
    rewind_us = int(round(rewind_delay * 1_000_000))
    if period <= 0:
        raise ValueError("the period must be positive")
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    flag = (lambda c, d: F.lit(d) if c is None else F.coalesce(c, F.lit(False)))
    out_cols, kind = list(df.columns), df.schema[key].dataType
    base = (df.filter(time_micros.isNotNull()).withColumn("__t", time_micros)
            .withColumn("__elig", flag(eligible, True))
            .withColumn("__force", flag(force, False))
            .withColumn("__rewind", flag(rewind, False))
            .withColumn("__initial", F.lit(False)))
    if initial is not None:
        base = base.unionByName(
            initial.select(F.col(key).cast(kind).alias(key), F.col("timer").alias("__t"),
                           *(F.lit(False).alias(n) for n, _ in RULE_FIELDS[1:]), F.lit(True).alias("__initial")),
            allowMissingColumns=True)
    place = [F.col(key), F.col("__initial").desc(), F.col("__t"), *map(F.col, order)]
    fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    schema = T.StructType(fields + list(_schema(("__kind", T.IntegerType()), *STEP_FIELDS, *RULE_FIELDS).fields))
    path = scratch_path(spark, "throttle")
    (base.repartitionByRange(partitions, *place).sortWithinPartitions(*place)
     .mapInArrow(_first_pass(key, schema, out_cols, period, rewind_us), schema).write.parquet(path))
    made = spark.read.schema(schema).parquet(path)
    steps = made.filter(F.col("__kind") == STEPS).select(key, *(n for n, _ in STEP_FIELDS))
    entries = _entries(steps, key, partitions, fan)
    # one row a partition, so the broadcast is bounded by their number. A partition's last key may be another
    # than the one whose rows it keeps; that one is its first
    kept = (made.filter(F.col("__kind") == KEPT).select(*out_cols, "__part", *(n for n, _ in RULE_FIELDS))
            .join(F.broadcast(entries.select(F.col(key).alias("__key"), "__part", "__entry", "__seed")
                              .withColumnRenamed("__part", "__of")),
                  (F.col("__part") == F.col("__of")) & F.col(key).eqNullSafe(F.col("__key"))))
    later = (kept.repartitionById(partitions, F.col("__part")).sortWithinPartitions("__part", "__t", *order)
             .mapInArrow(_replay_fn(period, rewind_us, out_cols), T.StructType(fields)))
    passed = made.filter(F.col("__kind") == ROW).select(*out_cols).unionByName(later)
    if force is not None:
        # rows without a time are outside the timer: only a forced one passes
        passed = passed.unionByName(df.filter(time_micros.isNull() & flag(force, False)))
    timers = made.filter(F.col("__kind") == TIMER).select(key, F.col("__seed_exit").alias("timer")).unionByName(
        entries.groupBy(key).agg(F.max_by("__exit", "__part").alias("timer")))
    return passed, timers


def throttle(df: DataFrame, key: str, every_seconds: float, time_micros: Column,
             order: Sequence[str], eligible: Column | None = None,
             force: Column | None = None, rewind: Column | None = None,
             rewind_delay: float = 1.0, partitions: int | None = None, fan: int = FAN) -> DataFrame:
    """The rows of ``df`` that pass."""
    return throttle_from(df, key, every_seconds, time_micros, order, eligible, force, rewind, rewind_delay,
                         None, partitions, fan)[0]
