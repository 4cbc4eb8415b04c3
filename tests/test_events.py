"""Event operators against brute-force Python on small fixtures (W1-W6, A2-A4,
J1, J2, R5-R19), including the edge cases listed in FIXTURES.md section 4 and a
hot key whose rows span many time buckets."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emberwake.functions import scalars as S
from emberwake.operators import events as E

T0 = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")


def _random_rows(n=600, users=5, hot_share=0.5, seed=7, span_hours=30):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = 0 if rnd.random() < hot_share else rnd.randint(1, users)
        ts = T0 + dt.timedelta(seconds=rnd.randint(0, span_hours * 3600))
        if i % 17 == 0 and rows:      # equal timestamps inside a key
            ts = rows[-1][1]
            u = rows[-1][2]
        et = rnd.choice(["click", "view", "error", "purchase", "signup"])
        rows.append((i, ts, u, et, float(rnd.randint(0, 5))))
    return rows


def _by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        out.setdefault(r[2], []).append(r)
    return out


def test_displacement_matches_sequential(spark):
    rows = _random_rows()
    df = _events(spark, rows).withColumn("y", F.col("event_id") % 3)
    got = {r.event_id: (r.dx, r.dy) for r in
           E.displacement(df, "user_id", "value", "y", bucket_width=60).collect()}
    for key, rs in _by_key(rows).items():
        prev = None
        for r in rs:
            if prev is None:
                assert got[r[0]] == (None, None)
            else:
                assert got[r[0]] == (r[4] - prev[4], float(r[0] % 3 - prev[0] % 3))
            prev = r
    moved = E.moved(E.displacement(df, "user_id", "value", "y"))
    assert all(r.distance > 0 for r in moved.collect())


def test_retain_and_evict_partition_the_rows(spark):
    rows = _random_rows()
    df = _events(spark, rows)
    for quota in (0, 3, 1000):
        kept = {r.event_id for r in E.retain_newest(df, "event_type", quota).collect()}
        gone = {r.event_id for r in E.evicted(df, "event_type", quota).collect()}
        assert kept.isdisjoint(gone) and kept | gone == {r[0] for r in rows}
        for cls in {r[3] for r in rows}:
            mine = sorted((r for r in rows if r[3] == cls), key=lambda r: (r[1], r[0]),
                          reverse=True)
            assert {r[0] for r in mine[:quota]} == {i for i in kept if rows[i][3] == cls}


def test_retain_with_per_class_quota(spark):
    rows = _random_rows()
    df = _events(spark, rows)
    kept = E.retain_newest(df, "event_type", {"click": 2, "view": 0, None: 1})
    counts = {r.event_type: r["count"] for r in kept.groupBy("event_type").count().collect()}
    assert counts == {"click": 2, "error": 1, "purchase": 1, "signup": 1}


def test_excess_counts(spark):
    rows = _random_rows()
    got = {r.event_type: (r.n_items, r.excess) for r in
           E.excess_counts(_events(spark, rows), "event_type", 100).collect()}
    for cls in {r[3] for r in rows}:
        n = sum(1 for r in rows if r[3] == cls)
        assert got[cls] == (n, max(n - 100, 0))


def test_last_per_second(spark):
    rows = _random_rows()
    got = {(r.event_type, r.second_key): r.event_id for r in
           E.last_per_second(_events(spark, rows), "event_type").collect()}
    want = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        want[(r[3], r[1].strftime("%Y%m%d%H%M%S"))] = r[0]
    assert got == want


@pytest.mark.parametrize("first_is_stop", [False, True])
def test_take_until(spark, first_is_stop):
    rows = _random_rows()
    if first_is_stop:
        first = min((r for r in rows if r[2] == 0), key=lambda r: (r[1], r[0]))
        rows = [(r[0], r[1], r[2], "error" if r is first else r[3], r[4]) for r in rows]
    rows.append((10_000, T0, 99, "view", 1.0))    # a key with no sentinel
    got = {r.event_id for r in
           E.take_until(_events(spark, rows), "user_id", F.col("event_type") == "error").collect()}
    want = set()
    for key, rs in _by_key(rows).items():
        for r in rs:
            want.add(r[0])
            if r[3] == "error":
                break
    assert got == want
    assert 10_000 in got


def test_take_until_without_key(spark):
    rows = _random_rows(50)
    got = {r.event_id for r in
           E.take_until(_events(spark, rows), None, F.col("event_type") == "error").collect()}
    want = set()
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        want.add(r[0])
        if r[3] == "error":
            break
    assert got == want


@pytest.mark.parametrize("period", [60, 900, 7200])
def test_throttle_matches_sequential(spark, period):
    rows = _random_rows(800)
    got = {r.event_id for r in E.throttle(_events(spark, rows), "user_id", period).collect()}
    want = set()
    for key, rs in _by_key(rows).items():
        last = None
        for r in rs:
            t = r[1].timestamp()
            if last is None:
                last = t
            elif t - last > period:
                last = t
                want.add(r[0])
    assert got == want


def test_tick_flags(spark):
    rows = _random_rows(300)
    got = {(r.user_id, r.tick_start): (r.clicked, r.viewed) for r in E.tick_flags(
        _events(spark, rows), "user_id", "ts", "1 hour",
        {"clicked": F.col("event_type") == "click", "viewed": F.col("event_type") == "view"}
    ).collect()}
    want = {}
    for r in rows:
        k = (r[2], r[1].replace(minute=0, second=0, microsecond=0))
        c, v = want.get(k, (False, False))
        want[k] = (c or r[3] == "click", v or r[3] == "view")
    assert got == want


def test_label_lookup_and_override(spark):
    df = spark.createDataFrame([(0xF700,), (0xF704,), (0xF747,), (9,), (5,), (None,)], "code int")
    got = [r.key_name for r in E.label_lookup(df, "code").orderBy(F.col("code").asc_nulls_last()).collect()]
    assert got == ["5", "Tab", "Up", "F1", "ModeSwitch", None]
    assert len(S.key_code_rows()) == 74
    ov = df.select(S.key_override(F.col("code"), F.lit("x")).alias("c")).collect()
    assert [r.c for r in ov] == ["x"] * 6
    ov2 = spark.createDataFrame([(36,), (51,), (7,)], "code int").select(
        S.key_override(F.col("code"), F.lit("q")).alias("c")).collect()
    assert [r.c for r in ov2] == ["Enter", "Backspace", "q"]


def test_label_lookup_custom_dimension(spark):
    df = spark.createDataFrame([(1,), (2,)], "code int")
    dim = spark.createDataFrame([(1, "one")], "code int, name string")
    got = sorted((r.code, r.key_name) for r in E.label_lookup(df, "code", dim).collect())
    assert got == [(1, "one"), (2, "2")]


def test_masks(spark):
    df = spark.createDataFrame([(u, c) for u in (1, 2) for c in range(0, 24, u)], "u int, code int")
    kept = {r.code for r in E.mask_filter(df, "code", S.FULL_MASK, drop_types=(S.KEY_UP,)).collect()}
    assert S.KEY_UP not in kept and kept == set(range(24)) - {S.KEY_UP}
    # XOR on a bit that is not set sets it
    assert S.mask_without(0, (3,)) == 8
    masks = {r.u: r.mask for r in E.mask_union(df, "u", "code").collect()}
    assert masks == {1: (1 << 24) - 1, 2: sum(1 << c for c in range(0, 24, 2))}


def test_key_label_and_modifiers(spark):
    df = spark.createDataFrame([("a", None, False), (None, "Key.esc", False), ("b", None, True),
                                (None, "Key.f1", True)], "ch string, name string, rel boolean")
    got = [r.l for r in df.select(S.key_label(F.col("ch"), F.col("name"), F.col("rel")).alias("l")).collect()]
    assert got == ["alphanumeric key a pressed", "special key Key.esc pressed", "b released",
                   "Key.f1 released"]
    flags = spark.createDataFrame([(0,), (S.CONTROL_BIT | S.SHIFT_BIT,), (S.ALPHA_SHIFT_BIT,),
                                   (S.CONTROL_BIT | S.ALTERNATE_BIT | S.COMMAND_BIT,)], "f long")
    mods = [r.m for r in flags.select(S.modifiers(F.col("f")).alias("m")).collect()]
    assert mods == [[], ["Ctrl", "Shift"], ["Shift"], ["Ctrl", "Alt", "Cmd"]]


def test_dispatch(spark):
    df = spark.createDataFrame([("left_down", 0, 0), ("right_down", 0, 0), ("scroll", 0, 1),
                                ("scroll", 0, -1), ("scroll", 1, 1), ("scroll", -1, -1),
                                ("scroll", 0, 0), ("other", 1, 1)], "k string, dx int, dy int")
    got = [r.b for r in df.select(S.dispatch(F.col("k"), F.col("dx"), F.col("dy")).alias("b")).collect()]
    assert got == [1, 3, 4, 5, 6, 7, None, None]


def test_classify_second_key_pick(spark):
    df = spark.createDataFrame([(0, T0), (2, T0 + dt.timedelta(seconds=61.5))], "n int, ts timestamp_ntz")
    got = df.select(S.classify(F.col("n")).alias("c"), S.second_key(F.col("ts")).alias("k"),
                    S.item_key(S.classify(F.col("n")), S.second_key(F.col("ts"))).alias("i"),
                    S.pick(S.GREETINGS, F.col("n")).alias("g"),
                    S.pick(S.GREETINGS, seed=3).alias("r")).collect()
    assert [(r.c, r.k, r.i, r.g) for r in got] == [
        ("nonfacial", "20240101000000", "webcam-nonfacial-20240101000000", "Hello."),
        ("facial", "20240101000101", "webcam-facial-20240101000101", "May I help you?")]
    assert all(r.r in S.GREETINGS for r in got)
    assert math.isclose(df.select(S.norm(F.lit(3.0), F.lit(4.0)).alias("d")).first().d, 5.0)


def test_top_priority_and_first_active(spark):
    items = spark.createDataFrame(
        [(1, 10, 1, "w"), (1, 11, 0, "x"), (1, 12, 0, ""), (2, 20, 1, "y"), (2, 21, 1, "z"),
         (3, 30, 0, None)], "owner int, pos int, layer int, name string")
    low = (F.col("layer") != 0) | F.coalesce(F.col("name") == "", F.lit(True))
    got = {r.owner: r.pos for r in E.top_priority(items, "owner", low, "pos").collect()}
    assert got == {1: 11, 2: 20, 3: 30}
    owners = spark.createDataFrame([(1, False, 0), (2, True, 1), (3, True, 2)],
                                   "owner int, active boolean, p int")
    first = E.first_item_of_active(owners, items, "owner", F.col("active"), "p", low, "pos").collect()
    assert [(r.owner, r.pos) for r in first] == [(2, 20)]


@pytest.mark.parametrize("period,delay", [(120, 30), (1800, 1800)])
def test_throttle_with_force_rewind_and_ineligible(spark, period, delay):
    rows = _random_rows(800)
    got = {r.event_id for r in E.throttle(
        _events(spark, rows), "user_id", period, eligible=F.col("event_type") != "signup",
        force=F.col("event_type") == "click", rewind=F.col("event_type") == "purchase",
        rewind_delay=delay).collect()}
    want = set()
    for key, rs in _by_key(rows).items():
        last = None
        for r in rs:
            t, et = r[1].timestamp(), r[3]
            keep = False
            if last is None:
                last = t
            elif et != "signup" and t - last > period:
                last, keep = t, True
            if et == "click":
                keep = True
            if et == "purchase":
                last, keep = t - period + delay, True
            if keep:
                want.add(r[0])
    assert got == want


def test_throttle_rejects_long_rewind(spark):
    with pytest.raises(ValueError):
        E.throttle(_events(spark, _random_rows(5)), "user_id", 10, rewind_delay=20)


def _sequential(rows, period, delay, last=None):
    """(places that pass, timer) of (t, eligible, force, rewind) rows."""
    passed = set()
    for i, (t, elig, force, rew) in enumerate(rows):
        keep = False
        if last is None:
            last = t
        elif elig and t - last > period:
            last, keep = t, True
        if rew:
            last, keep = t - period + delay, True
        if keep or force:
            passed.add(i)
    return passed, last


@pytest.mark.parametrize("seed", range(8))
def test_throttle_steps_compose(seed):
    """Step functions of stretches, and of their compositions, against the rule."""
    import numpy as np
    from emberwake.operators import throttle as TH
    rnd = random.Random(seed)
    period, delay = rnd.choice([(50, 20), (7, 7), (400, 1)])
    rows, t = [], 0
    for _ in range(300):
        t += rnd.choice([0, 1, 3, 7, 20, 60, 400])
        rows.append((t, rnd.random() < 0.7, rnd.random() < 0.05, rnd.random() < rnd.choice([0, 0.05])))
    cuts = [0, *sorted(rnd.sample(range(1, 300), 7)), 300]
    whole = None
    for a, b in zip(cuts, cuts[1:]):
        cols = [np.array(c) for c in zip(*rows[a:b])]
        f = TH.steps_of(cols[0].astype(np.int64), cols[1], cols[3], period, delay)
        assert (np.diff(f[0]) > 0).all() and (f[1][:-1] != TH.SAME).all()
        entries = [TH.OLD, rows[a][0], *(rows[a][0] - rnd.randint(-20, 2 * period) for _ in range(20))]
        got = TH.applied(f, np.array(entries)).tolist()
        assert got == [_sequential(rows[a:b], period, delay, e)[1] for e in entries]
        whole = f if whole is None else TH.composed(whole, f)
    entries = [TH.OLD, *(rows[0][0] + k for k in range(-2 * period, 30))]
    assert TH.applied(whole, np.array(entries)).tolist() == [_sequential(rows, period, delay, e)[1] for e in entries]


@pytest.mark.parametrize("partitions,fan", [(1, 64), (5, 64), (40, 2), (23, 3)])
def test_throttle_by_ranges_with_timers(spark, partitions, fan, monkeypatch):
    """One key holds most rows and lies on many ranges; fans of two and three
    make several levels; segments of four steps split the stored functions."""
    from emberwake.operators import throttle as TH
    rnd = random.Random(partitions)
    keys = [None, 1, 2, *range(10, 30)]
    rows = [(i, 1 if rnd.random() < 0.6 else rnd.choice(keys), rnd.randrange(100_000), rnd.random() < 0.8,
             rnd.random() < 0.03, rnd.random() < 0.03) for i in range(3000)]
    first = {k: rnd.randrange(-500, 100) for k in (1, 2, 77, None)}
    schema = "event_id long, k long, t long, elig boolean, force boolean, rew boolean"
    df = spark.createDataFrame(rows, schema).repartition(3)
    initial = spark.createDataFrame(list(first.items()), "k long, timer long")
    for given in (None, initial):
        passed, timers = TH.throttle_from(df, "k", 0.0004, F.col("t"), ["t", "event_id"], F.col("elig"), F.col("force"),
                                          F.col("rew"), 0.0001, given, partitions, fan)
        want, left = set(), {} if given is None else dict(first)
        for k in keys:
            own = sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0]))
            if own:
                at, left[k] = _sequential([r[2:] for r in own], 400, 100, None if given is None else first.get(k))
                want |= {own[i][0] for i in at}
        assert sorted(r.event_id for r in passed.collect()) == sorted(want)
        assert {r.k: r.timer for r in timers.collect()} == left
        assert timers.count() == len(left)


def test_throttle_functions_are_stored_in_segments(spark):
    from emberwake.operators import throttle as TH
    from pyspark.sql import types as T
    import numpy as np
    kind = TH._schema(("k", T.LongType()), *TH.STEP_FIELDS)
    dom, cod = np.arange(2 * TH.SEGMENT + 5) - 9, np.arange(2 * TH.SEGMENT + 5) * 2
    rows = TH._step_rows("k", [n for n, _ in TH.STEP_FIELDS], [(7, 3, 1, (dom, cod))])
    assert [len(d) for d in rows["__dom"]] == [TH.SEGMENT, TH.SEGMENT, 5]
    df = spark.createDataFrame([(7, 3, i, 1, d.tolist(), c.tolist()) for i, (d, c) in
                                enumerate(zip(rows["__dom"], rows["__cod"]))], kind)
    got = TH._entries(df, "k", 8, 2).collect()
    assert [(r["__part"], r["__seed"], r["__exit"]) for r in got] == [(3, True, 1)]


@pytest.mark.parametrize("quota", [0, 1, 3, 50, 400, 1500, 10_000])
def test_kept_and_evicted_part_the_rows_on_ties(spark, quota):
    """Few distinct times and ids, identical rows, null times, a null class; the
    selection for large quotas (histograms, then the next column) equals the rank."""
    from emberwake.operators import newest
    rnd = random.Random(quota)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, *range(9)]), rnd.randrange(4), rnd.randrange(3))
            for _ in range(1500)]
    df = spark.createDataFrame(rows, "cls string, t long, event_id int, value int").repartition(5)
    order = ("t", "event_id")

    def tally(found):
        return Counter(tuple(r) for r in found.collect())

    kept, gone = newest.parted(df, "cls", F.lit(quota), order, few=7)
    small = (E.retain_newest(df, "cls", quota, order), E.evicted(df, "cls", quota, order))
    for a, b in ((kept, gone), small):
        a, b = tally(a), tally(b)
        assert a + b == Counter(rows)
        for c in ("a", "b", None):
            own = sorted(((-1 if r[1] is None else r[1], r[2]) for r in rows if r[0] == c), reverse=True)
            assert sorted(((-1 if r[1] is None else r[1], r[2]) for r in a.elements() if r[0] == c), reverse=True) == own[:quota]
    assert tally(kept) == tally(small[0])


def test_a_large_quota_sorts_no_class(spark):
    from emberwake.operators import newest
    df = spark.range(30_000).select(F.lit("x").alias("cls"), (F.col("id") * 7 % 30_011).alias("t"), "id")
    kept = E.retain_newest(df, "cls", 12_345, ("t", "id"))
    assert kept.count() == 12_345 and E.evicted(df, "cls", 12_345, ("t", "id")).count() == 30_000 - 12_345
    cut = sorted((r.t for r in df.collect()), reverse=True)[12_344]
    assert {r.t >= cut for r in kept.collect()} == {True}
    bounds = newest._narrowed(df.select(F.col("cls").alias("__cls"), F.col("t").alias("__pos")),
                              spark.createDataFrame([("x", 12_345)], "__cls string, need long"), 1000).first()
    assert bounds["m"] <= 1000 and bounds["need"] <= bounds["m"]


def test_key_names_chain(spark):
    """Key code first, then the character's name, then the character itself."""
    rows = [(36, "x"), (51, None), (48, "\t"), (53, "\x1b"), (126, "\uf700"), (1, "\uf704"), (0, "a"), (7, "ab"), (9, None),
            (None, "\t"), (2, "")]
    df = spark.createDataFrame(rows, "code int, character string")
    got = {(r.code, r.character): r.key_name for r in E.key_names(df, "code", "character").collect()}
    assert [got[r] for r in rows] == ["Enter", "Backspace", "Tab", "Escape", "Up", "F1", "a", "ab", None, "Tab", ""]


def test_throttle_of_an_empty_table(spark):
    df = spark.createDataFrame([], "event_id long, user_id long, ts timestamp")
    assert E.throttle(df, "user_id", 5).count() == 0


@pytest.mark.parametrize("partitions,period,delay", [(30, 60, 30), (50, 7, 3), (12, 600, 600)])
def test_throttle_small_ranges(spark, partitions, period, delay):
    """Many borders: entries cross ranges through the step functions."""
    rows = _random_rows(900, seed=3, span_hours=6)
    got = {r.event_id for r in E.throttle(
        _events(spark, rows), "user_id", period, eligible=F.col("event_type") != "signup",
        force=F.col("event_type") == "click", rewind=F.col("event_type") == "purchase",
        rewind_delay=delay, partitions=partitions, fan=4).collect()}
    want = set()
    for key, rs in _by_key(rows).items():
        last = None
        for r in rs:
            t, et = r[1].timestamp(), r[3]
            keep = False
            if last is None:
                last = t
            elif et != "signup" and t - last > period:
                last, keep = t, True
            if et == "click":
                keep = True
            if et == "purchase":
                last, keep = t - period + delay, True
            if keep:
                want.add(r[0])
    assert got == want


def test_throttle_null_key_is_a_group(spark):
    rows = _random_rows(300, seed=5)
    rows = [(r[0], r[1], None if r[2] == 1 else r[2], r[3], r[4]) for r in rows]
    got = {r.event_id for r in E.throttle(_events(spark, rows), "user_id", 600).collect()}
    want = set()
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        groups.setdefault(r[2], []).append(r)
    for rs in groups.values():
        last = None
        for r in rs:
            t = r[1].timestamp()
            if last is None:
                last = t
            elif t - last > 600:
                last = t
                want.add(r[0])
    assert None in groups and got == want


def test_null_key_is_a_group_for_joined_operators(spark):
    rows = _random_rows(400, seed=9)
    rows = [(r[0], r[1], None if r[2] == 2 else r[2], r[3], r[4]) for r in rows]
    df = _events(spark, rows)
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        groups.setdefault(r[2], []).append(r)
    assert None in groups
    # displacement: previous row inside the null group too
    got = {r.event_id: r.dx for r in E.displacement(df, "user_id", "value", "value").collect()}
    for rs in groups.values():
        assert got[rs[0][0]] is None
        assert all(got[b[0]] == b[4] - a[4] for a, b in zip(rs, rs[1:]))
    # take-until: the null group stops at its own first sentinel
    got = {r.event_id for r in E.take_until(df, "user_id", F.col("event_type") == "error").collect()}
    want = set()
    for rs in groups.values():
        for r in rs:
            want.add(r[0])
            if r[3] == "error":
                break
    assert got == want
    # eviction: retained and evicted rows partition a null class as well
    classed = df.withColumn("cls", F.when(F.col("event_type") == "view", F.lit(None))
                            .otherwise(F.col("event_type")))
    kept = {r.event_id for r in E.retain_newest(classed, "cls", 3).collect()}
    gone = {r.event_id for r in E.evicted(classed, "cls", 3).collect()}
    assert kept.isdisjoint(gone) and kept | gone == {r[0] for r in rows}


def test_is_sentinel_is_null_safe(spark):
    df = spark.createDataFrame([("esc",), ("a",), (None,)], "k string")
    got = [r.s for r in df.select(S.is_sentinel(F.col("k"), "esc").alias("s")).collect()]
    assert got == [True, False, False]


def test_time_helpers_on_other_time_types(spark):
    rows = _random_rows(300, seed=11)
    ntz = _events(spark, rows)
    tz = ntz.withColumn("ts", F.col("ts").cast("timestamp"))
    d1 = {r.event_id: r.dx for r in E.displacement(ntz, "user_id", "value", "value").collect()}
    d2 = {r.event_id: r.dx for r in E.displacement(tz, "user_id", "value", "value").collect()}
    assert d1 == d2
    t1 = {r.event_id for r in E.throttle(ntz, "user_id", 900).collect()}
    t2 = {r.event_id for r in E.throttle(tz, "user_id", 900).collect()}
    assert t1 == t2
    # numeric order column: buckets of ``width`` units
    num = ntz.withColumn("seq", F.col("event_id").cast("double"))
    d3 = {r.event_id: r.dx for r in
          E.displacement(num, "user_id", "value", "value", ("seq",), bucket_width=25).collect()}
    for rs in {k: sorted(v, key=lambda r: r[0]) for k, v in _by_key(rows).items()}.values():
        assert d3[rs[0][0]] is None
        assert all(d3[b[0]] == b[4] - a[4] for a, b in zip(rs, rs[1:]))
    # dates: one bucket per day, never decreasing
    dates = ntz.withColumn("day", F.to_date("ts"))
    b = dates.select("day", E.range_bucket(dates, "day", 1440).alias("b")).orderBy("day").collect()
    assert all(x.b <= y.b for x, y in zip(b, b[1:]))
    assert len({r.b for r in b}) == len({r.day for r in b})


def test_a_callers_dimension_is_not_hinted(spark):
    dim = spark.createDataFrame([(i, str(i)) for i in range(10)], "code int, name string")
    df = spark.createDataFrame([(1,), (20,)], "code int")
    found = E.label_lookup(df, "code", dim)
    assert "broadcast" not in found._jdf.queryExecution().analyzed().toString().lower()
    assert sorted((r.code, r.key_name) for r in found.collect()) == [(1, "1"), (20, "20")]


def test_throttle_of_large_keys_beside_a_null_key(spark):
    a = 1 << 60
    rows = [(1, a, 0), (2, a + 1, 1), (3, None, 2), (4, a, 40), (5, a + 1, 45), (6, None, 50), (7, a, 60)]
    df = spark.createDataFrame([(i, k, t * 1_000_000) for i, k, t in rows], "event_id long, k long, t long")
    got = E.throttle(df, "k", 30, ("t", "event_id"), partitions=5, fan=2).collect()
    assert sorted(r.event_id for r in got) == [4, 5, 6]
    nan = spark.createDataFrame([(i, float("nan"), i * 20_000_000) for i in range(6)], "event_id long, k double, t long")
    assert sorted(r.event_id for r in E.throttle(nan, "k", 30, ("t", "event_id"), partitions=5, fan=2).collect()) == [2, 4]


def test_throttle_of_times_beyond_doubles_and_null_times(spark):
    base = (1 << 55) + 1
    rows = [(i, 1, base + i) for i in range(6)] + [(9, 1, None), (10, 1, None)]
    df = spark.createDataFrame(rows, "event_id long, k long, t long")
    got = E.throttle(df, "k", 1e-6, ("t", "event_id"), rewind_delay=1e-6).collect()
    assert sorted(r.event_id for r in got) == [2, 4]  # more than one microsecond later
    forced = E.throttle(df, "k", 1e-6, ("t", "event_id"), force=F.col("event_id") == 10, rewind_delay=1e-6).collect()
    assert sorted(r.event_id for r in forced) == [2, 4, 10]


def test_masks_have_no_bit_outside_the_word(spark):
    df = spark.createDataFrame([(1,), (63,), (65,), (70,), (-63,), (None,)], "code int")
    assert [r.code for r in E.mask_filter(df, "code", 0b10).collect()] == [1]
    assert E.mask_union(df.filter("code > 63 or code < 0"), None, "code").first()[0] == 0


def test_label_lookup_of_a_repeated_code(spark):
    df = spark.createDataFrame([(1,), (2,)], "code int")
    dim = spark.createDataFrame([(1, "b"), (1, "a")], "code int, name string")
    got = sorted((r.code, r.key_name) for r in E.label_lookup(df, "code", dim).collect())
    assert got == [(1, "a"), (2, "2")]


def test_drawn_rows_and_picks_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).select((F.col("id") % 2500).alias("id"), F.col("id").alias("row"), F.when(F.col("id") % 3 > 0, "a").alias("cls"))
    for n in (0, 10, 1500, 9000):
        first = sorted(map(tuple, E.draw_rows(rows.repartition(3), n, "id", 5, "cls").collect()), key=repr)
        again = sorted(map(tuple, E.draw_rows(rows.repartition(17, "row"), n, "id", 5, "cls").collect()), key=repr)
        assert first == again
        assert len(first) == sum(min(n, k) for k in (1667, 3333))
    assert E.draw_rows(rows, 10, "id", 5).exceptAll(E.draw_rows(rows, 10, "id", 6)).count() > 0
    assert E.draw_rows(rows.limit(0), 10, "id").count() == 0
    picked = rows.select("row", S.pick(S.GREETINGS, seed=3, key=F.col("row")).alias("g"))
    assert sorted(picked.collect()) == sorted(
        rows.repartition(5).select("row", S.pick(S.GREETINGS, seed=3, key=F.col("row")).alias("g")).collect())
    shares = [r["count"] for r in picked.groupBy("g").count().collect()]
    assert len(shares) == len(S.GREETINGS) and max(shares) < 1.3 * min(shares)
    null = rows.limit(1).select(S.pick(["x", "y"], seed=1, key=F.lit(None).cast("string")).alias("g")).first().g
    assert null in ("x", "y")
