"""Query catalogue: every operator as a query over the driver's tables, each
with the equivalent DuckDB SQL where one exists.

class = ``event_type`` (or a detection count of ``k mod 3``), sentinel =
``'error'``, event-type code = ``k mod 24``, key code = ``0xF700 + k``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwake.functions import scalars as S
from emberwake.operators import boost as B
from emberwake.operators import events as E
from emberwake.operators import newton as N
from emberwake.sources import points as P
from emberwake.plans.load import LoadSpec, TS_NTZ_FORMAT, load, open_source, stage_as_csv
from emberwake.session import scratch_path
from emberwake.sinks.tables import Destination, profile, write_by_class
from emberwake.sources.files import list_files, list_tree
from emberwake.streaming import pipelines as ST

QUOTA = 20
SENTINEL = "error"
TICK = "1 second"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


EV = ("WITH ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k "
      "FROM events) ")


# ---------------------------------------------------------------------------
# Loader
# ---------------------------------------------------------------------------

def q_load_orders(spark, sf_dir):
    """Flagship: orders -> CSV + spec -> strict scan -> per-status summary."""
    orders = table(spark, sf_dir, "orders")
    data, spec = stage_as_csv(spark, orders, "load_orders", not_null=("o_orderkey",))
    _, df = open_source(spark, LoadSpec(data, spec, Destination("parquet", path="-"),
                                        options={"timestampNTZFormat": TS_NTZ_FORMAT}))
    return (df.groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 # exact decimal sum: the same total whatever the summation order
                 F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
                 .alias("total_price"),
                 F.min("o_orderdate").alias("first_order"),
                 F.max("o_orderdate").alias("last_order")))


SQL_LOAD_ORDERS = """
SELECT o_orderstatus, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
FROM orders GROUP BY o_orderstatus
"""


def q_load_write_read(spark, sf_dir):
    """Full load job: CSV + spec -> checked scan -> parquet (count observed) -> read back."""
    orders = table(spark, sf_dir, "orders")
    data, spec = stage_as_csv(spark, orders, "load_write", not_null=("o_orderkey", "o_custkey"))
    out = scratch_path(spark, "load_write_out")
    res = load(spark, LoadSpec(data, spec, Destination("parquet", path=out, mode="error"),
                               options={"timestampNTZFormat": TS_NTZ_FORMAT}))
    back = spark.read.parquet(out)
    return back.withColumn("rows_written", F.lit(res.rows).cast("long"))


SQL_LOAD_WRITE_READ = """
SELECT *, (SELECT count(*) FROM orders) AS rows_written FROM orders
"""


# Text with quotes and line breaks: one record may span lines (multiLine), and
# quotes inside a field are doubled (RFC 4180). multiLine files are read one
# task per file, so parallelism comes from the number of staged part files.
TEXT_CSV = {"multiLine": True, "escape": '"'}


def _load_text_table(spark, sf_dir, name: str, key: str):
    src = table(spark, sf_dir, name)
    data, spec = stage_as_csv(spark, src, f"load_{name}", not_null=(key,), options=TEXT_CSV)
    _, df = open_source(spark, LoadSpec(data, spec, Destination("parquet", path="-"),
                                        options=TEXT_CSV))
    return df


def q_load_documents(spark, sf_dir):
    return _load_text_table(spark, sf_dir, "documents", "doc_id")


def q_load_pages(spark, sf_dir):
    return _load_text_table(spark, sf_dir, "pages", "page_id")


def q_schema_profile(spark, sf_dir):
    return profile(table(spark, sf_dir, "lineitem"))


LINEITEM_COLS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]
SQL_SCHEMA_PROFILE = "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{n}' AS name, '{t}' AS type, true AS nullable, "
    f"count({n}) AS non_null, count(*) - count({n}) AS nulls FROM lineitem"
    for i, (n, t) in enumerate(LINEITEM_COLS))


def q_write_by_class(spark, sf_dir):
    """Items stored under their class folder, read back with the class restored."""
    ev = table(spark, sf_dir, "events")
    out = scratch_path(spark, "by_class")
    write_by_class(ev, out, cls="event_type")
    return spark.read.parquet(out).select(*ev.columns)


SQL_WRITE_BY_CLASS = "SELECT * FROM events"


def q_file_listing(spark, sf_dir):
    """Items stored under class folders, then listed by name pattern."""
    ev = table(spark, sf_dir, "events")
    out = scratch_path(spark, "listing")
    write_by_class(ev, out, cls="event_type")
    files = list_files(spark, out, "*.parquet")
    return files.select(F.regexp_extract("path", r"event_type=([^/]+)/", 1).alias("event_type"),
                        "name", "length")


def _stored_items(spark, sf_dir, name: str) -> str:
    out = scratch_path(spark, name)
    write_by_class(table(spark, sf_dir, "events"), out, cls="event_type", ts="ts")
    return out


def q_write_by_second(spark, sf_dir):
    """Items stored under class and second (K7), read back with the keys."""
    items = spark.read.parquet(_stored_items(spark, sf_dir, "by_second"))
    return items.select("event_id", "user_id", "ts", "event_type", "value", "second_key", "item",
                        F.col("day").cast("string").alias("day"))


SQL_WRITE_BY_SECOND = """
SELECT event_id, user_id, ts, event_type, value, strftime(ts, '%Y%m%d%H%M%S') AS second_key,
       concat_ws('-', 'webcam', event_type, strftime(ts, '%Y%m%d%H%M%S')) AS item, strftime(ts, '%Y%m%d') AS day
FROM events
"""


def q_item_folders(spark, sf_dir):
    """The folders of stored items and the classes' items by a listing in tasks
    (S11): a folder for each class and day that has items, and no other."""
    files = list_tree(spark, _stored_items(spark, sf_dir, "item_tree"), "*.parquet")
    return files.select(F.regexp_extract("path", r"event_type=([^/]+)/", 1).alias("event_type"),
                        F.regexp_extract("path", r"day=([^/]+)/", 1).alias("day"),
                        F.regexp_replace("path", r"/[^/]+$", "").alias("folder")).distinct()


SQL_ITEM_FOLDERS = """
SELECT DISTINCT event_type, strftime(ts, '%Y%m%d') AS day,
       'event_type=' || event_type || '/day=' || strftime(ts, '%Y%m%d') AS folder
FROM events
"""


# ---------------------------------------------------------------------------
# Event operators
# ---------------------------------------------------------------------------

def q_displacement(spark, sf_dir):
    ev = device_events(spark, sf_dir).withColumn("y", F.col("k").cast("double"))
    d = E.moved(E.displacement(ev, "user_id", "value", "y", ("ts", "event_id")))
    return d.select("event_id", "user_id", "ts",
                    F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"),
                    F.round("distance", 6).alias("distance"))


SQL_DISPLACEMENT = EV + """,
d AS (SELECT event_id, user_id, ts,
             value - lag(value) OVER w AS dx,
             CAST(k AS DOUBLE) - lag(CAST(k AS DOUBLE)) OVER w AS dy
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, ts, round(dx, 6) AS dx, round(dy, 6) AS dy,
       round(sqrt(dx * dx + dy * dy), 6) AS distance
FROM d WHERE sqrt(dx * dx + dy * dy) > 0
"""


def q_class_route(spark, sf_dir):
    """Classify by detection count, key by second, last write wins, name the item."""
    ev = device_events(spark, sf_dir).withColumn("class", S.classify(F.pmod("k", F.lit(3))))
    last = E.last_per_second(ev.select("class", "event_id", "ts", "user_id", "event_type", "value"),
                             "class", "ts", ("ts", "event_id"))
    return last.withColumn("item_key", S.item_key(F.col("class"), F.col("second_key")))


SQL_CLASS_ROUTE = EV + """,
c AS (SELECT *, CASE WHEN k % 3 > 0 THEN 'facial' ELSE 'nonfacial' END AS class,
             strftime(ts, '%Y%m%d%H%M%S') AS second_key FROM ev),
r AS (SELECT *, row_number() OVER (PARTITION BY class, second_key
                                   ORDER BY ts DESC, event_id DESC) AS rn FROM c)
SELECT class, second_key, event_id, ts, user_id, event_type, value,
       'webcam-' || class || '-' || second_key AS item_key
FROM r WHERE rn = 1
"""


def q_retain_newest(spark, sf_dir):
    return E.retain_newest(table(spark, sf_dir, "events"), "event_type", QUOTA)


SQL_RETAIN_NEWEST = f"""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn <= {QUOTA}
"""


def q_evict_list(spark, sf_dir):
    return E.evicted(table(spark, sf_dir, "events"), "event_type", QUOTA) \
        .select("event_id", "event_type", "ts")


SQL_EVICT_LIST = f"""
SELECT event_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn > {QUOTA}
"""


def q_excess_counts(spark, sf_dir):
    return E.excess_counts(table(spark, sf_dir, "events"), "event_type", QUOTA)


SQL_EXCESS_COUNTS = f"""
SELECT event_type, count(*) AS n_items, {QUOTA} AS quota,
       CAST(greatest(count(*) - {QUOTA}, 0) AS BIGINT) AS excess
FROM events GROUP BY event_type
"""


def q_take_until(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return E.take_until(ev, "user_id", F.col("event_type") == SENTINEL,
                        ("ts", "event_id")).select("event_id", "user_id", "ts", "event_type")


SQL_TAKE_UNTIL = f"""
SELECT event_id, user_id, ts, event_type FROM (
  SELECT *, coalesce(sum(CASE WHEN event_type = '{SENTINEL}' THEN 1 ELSE 0 END) OVER (
      PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stops_before
  FROM events) WHERE stops_before = 0
"""


def q_take_until_turns(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    kept = E.take_until(conv, "conv_id", F.col("role") == "assistant", ("turn",))
    return kept.select("conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars"))


SQL_TAKE_UNTIL_TURNS = """
SELECT conv_id, turn, role, length(text) AS n_chars FROM (
  SELECT *, coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (
      PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stops_before
  FROM conversations) WHERE stops_before = 0
"""

MASK = S.mask_without(S.FULL_MASK, (S.KEY_UP,))


def q_mask_filter(spark, sf_dir):
    ev = device_events(spark, sf_dir).withColumn("code", F.pmod("k", F.lit(24)))
    return E.mask_filter(ev, "code", S.FULL_MASK, drop_types=(S.KEY_UP,)) \
        .select("event_id", "user_id", "code")


SQL_MASK_FILTER = EV + f"""
SELECT event_id, user_id, k % 24 AS code FROM ev
WHERE ((CAST(1 AS BIGINT) << (k % 24)) & {MASK}) <> 0
"""


def q_mask_union(spark, sf_dir):
    ev = device_events(spark, sf_dir).withColumn("code", F.pmod("k", F.lit(24)))
    return E.mask_union(ev, "user_id", "code")


SQL_MASK_UNION = EV + """
SELECT user_id, bit_or(CAST(1 AS BIGINT) << (k % 24)) AS mask FROM ev GROUP BY user_id
"""


def q_label_lookup(spark, sf_dir):
    ev = device_events(spark, sf_dir).withColumn("code", F.lit(S.FUNCTION_AREA_START) + F.col("k"))
    return E.label_lookup(ev, "code").select("event_id", "code", "key_name")


def _key_values_sql() -> str:
    return ", ".join(f"({c}, '{n}')" for c, n in S.key_code_rows())


SQL_LABEL_LOOKUP = EV + f""",
dim(code, name) AS (VALUES {_key_values_sql()})
SELECT ev.event_id, {S.FUNCTION_AREA_START} + ev.k AS code,
       coalesce(dim.name, CAST({S.FUNCTION_AREA_START} + ev.k AS VARCHAR)) AS key_name
FROM ev LEFT JOIN dim ON dim.code = {S.FUNCTION_AREA_START} + ev.k
"""


def q_key_label(spark, sf_dir):
    """Key events: printable keys for k < 26, named special keys otherwise,
    releases for 'view' rows, Enter/Backspace override on the raw code."""
    ev = device_events(spark, sf_dir).withColumn("code", F.lit(S.FUNCTION_AREA_START) + F.col("k"))
    named = E.label_lookup(ev, "code")
    ch = F.when(F.col("k") < 26, F.char(F.col("k") + 97))
    return named.select(
        "event_id",
        S.key_label(ch, F.col("key_name"), F.col("event_type") == "view").alias("label"),
        S.key_override(F.col("k"), ch).alias("character"))


def q_key_names(spark, sf_dir):
    """Key events by their character: letters for k < 26, signs of the function
    area from there on, none for 'view' rows; k is the key code."""
    sign = F.decode(F.unhex(F.hex(F.lit(S.FUNCTION_AREA_START) + F.col("k"))), "UTF-16BE")
    ev = device_events(spark, sf_dir).withColumn(
        "character", F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .when(F.col("k") < 26, F.char(F.col("k") + 97)).otherwise(sign))
    return E.key_names(ev, "k", "character").select("event_id", "k", "key_name")


SQL_KEY_NAMES = EV + f""",
dim(code, name) AS (VALUES {_key_values_sql()}),
c AS (SELECT event_id, k, CASE k WHEN 36 THEN 'Enter' WHEN 51 THEN 'Backspace'
        ELSE CASE WHEN event_type = 'view' THEN NULL WHEN k < 26 THEN chr(CAST(97 + k AS INTEGER))
                  ELSE chr(CAST({S.FUNCTION_AREA_START} + k AS INTEGER)) END END AS ch FROM ev)
SELECT event_id, k, coalesce(dim.name, ch) AS key_name
FROM c LEFT JOIN dim ON length(ch) = 1 AND dim.code = unicode(ch)
"""

KEY_VIEW_SQL = EV + f""",
dim(code, name) AS (VALUES {_key_values_sql()}),
kv AS (SELECT ev.*, CASE WHEN k < 26 THEN chr(k + 97) END AS ch,
              coalesce(dim.name, CAST({S.FUNCTION_AREA_START} + k AS VARCHAR)) AS key_name
       FROM ev LEFT JOIN dim ON dim.code = {S.FUNCTION_AREA_START} + ev.k)
"""
KEY_LABEL_SQL = """CASE WHEN event_type = 'view' THEN coalesce(ch, key_name) || ' released'
            WHEN ch IS NOT NULL THEN 'alphanumeric key ' || ch || ' pressed'
            ELSE 'special key ' || key_name || ' pressed' END AS label"""

SQL_KEY_LABEL = KEY_VIEW_SQL + f"""
SELECT event_id, {KEY_LABEL_SQL},
       CASE WHEN k = 36 THEN 'Enter' WHEN k = 51 THEN 'Backspace' ELSE ch END AS character
FROM kv
"""


def q_pick_choice(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", S.pick(S.GREETINGS, F.col("event_id")).alias("greeting"))


SQL_PICK_CHOICE = (
    "SELECT event_id, ["
    + ", ".join("'" + g.replace("'", "''") + "'" for g in S.GREETINGS)
    + f"][event_id % {len(S.GREETINGS)} + 1] AS greeting FROM events")


DRAW_SQL = "CAST('0x' || substr(md5('{seed}|=' || event_id), 1, 15) AS BIGINT)"


def q_pick_random(spark, sf_dir):
    """The drawn form of R10: a greeting per row by a seed and the row's id, the
    same under any partitioning."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", S.pick(S.GREETINGS, seed=42, key=F.col("event_id")).alias("greeting"))


SQL_PICK_RANDOM = (
    "SELECT event_id, ["
    + ", ".join("'" + g.replace("'", "''") + "'" for g in S.GREETINGS)
    + f"][{DRAW_SQL.format(seed=42)} % {len(S.GREETINGS)} + 1] AS greeting FROM events")

DRAW = 1200


def q_draw_rows(spark, sf_dir):
    """A seeded sample of each class without replacement."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return E.draw_rows(ev, DRAW, "event_id", seed=7, cls="event_type")


SQL_DRAW_ROWS = f"""
SELECT event_id, event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY {DRAW_SQL.format(seed=7)} DESC) <= {DRAW}
"""


def q_tick_flags(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return E.tick_flags(ev, "user_id", "ts", TICK, {
        "moved": F.col("event_type") == "view",
        "clicked": F.col("event_type") == "click",
        "scrolled": F.col("event_type") == "purchase",
    })


SQL_TICK_FLAGS = """
SELECT user_id, date_trunc('second', ts) AS tick_start,
       date_trunc('second', ts) + INTERVAL 1 SECOND AS tick_end,
       bool_or(event_type = 'view') AS moved, bool_or(event_type = 'click') AS clicked,
       bool_or(event_type = 'purchase') AS scrolled
FROM events GROUP BY user_id, date_trunc('second', ts)
"""


def q_dispatch(spark, sf_dir):
    ev = device_events(spark, sf_dir)
    kind = (F.when(F.col("event_type") == "click", "left_down")
            .when(F.col("event_type") == "purchase", "right_down")
            .when(F.col("event_type") == "view", "scroll").otherwise("other"))
    dx = F.pmod("k", F.lit(3)) - 1
    dy = F.pmod("event_id", F.lit(3)) - 1
    flags = F.shiftleft(F.col("k").cast("long"), 14)
    return (ev.select("event_id", kind.alias("kind"), dx.alias("dx"), dy.alias("dy"),
                      flags.alias("flags"))
            .select("event_id", "kind", "dx", "dy",
                    S.dispatch(F.col("kind"), F.col("dx"), F.col("dy")).alias("button"),
                    F.array_join(S.modifiers(F.col("flags")), ",").alias("modifiers")))


SQL_DISPATCH = EV + """,
p AS (SELECT event_id, k,
             CASE event_type WHEN 'click' THEN 'left_down' WHEN 'purchase' THEN 'right_down'
                             WHEN 'view' THEN 'scroll' ELSE 'other' END AS kind,
             k % 3 - 1 AS dx, event_id % 3 - 1 AS dy,
             CAST(k AS BIGINT) << 14 AS flags FROM ev)
SELECT event_id, kind, dx, dy,
       CASE WHEN kind = 'left_down' THEN 1 WHEN kind = 'right_down' THEN 3
            WHEN kind = 'scroll' AND dx > 0 THEN 6 WHEN kind = 'scroll' AND dx < 0 THEN 7
            WHEN kind = 'scroll' AND dy > 0 THEN 4 WHEN kind = 'scroll' AND dy < 0 THEN 5
       END AS button,
       concat_ws(',', CASE WHEN flags & 262144 <> 0 THEN 'Ctrl' END,
                      CASE WHEN flags & 524288 <> 0 THEN 'Alt' END,
                      CASE WHEN flags & 1048576 <> 0 THEN 'Cmd' END,
                      CASE WHEN flags & 196608 <> 0 THEN 'Shift' END) AS modifiers
FROM p
"""


def _order_items(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def q_top_priority(spark, sf_dir):
    """Active customers joined with their orders; per customer the first open
    order by key, else the first other order."""
    cust = table(spark, sf_dir, "customer")
    active = cust.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    items = _order_items(spark, sf_dir).join(active, "o_custkey", "left_semi")
    return E.top_priority(items, "o_custkey", F.col("o_orderstatus") != "O", "o_orderkey")


SQL_TOP_PRIORITY = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM (
  SELECT o.*, row_number() OVER (PARTITION BY o_custkey
             ORDER BY CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END, o_orderkey) AS rn
  FROM orders o WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
WHERE rn = 1
"""


def q_first_item_of_active(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return E.first_item_of_active(cust, _order_items(spark, sf_dir), "o_custkey",
                                  F.col("c_acctbal") > 0, "o_custkey",
                                  F.col("o_orderstatus") != "O", "o_orderkey")


SQL_FIRST_ITEM_OF_ACTIVE = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM (
  SELECT o.*, row_number() OVER (ORDER BY CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END,
                                          o_orderkey) AS rn
  FROM orders o
  WHERE o_custkey = (SELECT min(c_custkey) FROM customer WHERE c_acctbal > 0))
WHERE rn = 1
"""


THROTTLE_SECONDS = 86_400


def q_throttle(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return E.throttle(ev, "user_id", THROTTLE_SECONDS)


SQL_THROTTLE = f"""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r(user_id, rn, last_ts, passed) AS (
  SELECT user_id, rn, ts, false FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn,
         CASE WHEN e.ts - r.last_ts > INTERVAL {THROTTLE_SECONDS} SECOND THEN e.ts ELSE r.last_ts END,
         e.ts - r.last_ts > INTERVAL {THROTTLE_SECONDS} SECOND
  FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
SELECT e.event_id, e.user_id, e.ts FROM r JOIN e USING (user_id, rn) WHERE r.passed
"""


# Stand-ins: 'signup' never triggers by time (key-up), 'click' forces a pass
# (button press), 'purchase' rewinds the timer (modifier change).
REWIND_SECONDS = 3_600


def _throttle_flags():
    return dict(eligible=F.col("event_type") != "signup", force=F.col("event_type") == "click",
                rewind=F.col("event_type") == "purchase", rewind_delay=REWIND_SECONDS)


def q_throttle_forced(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return E.throttle(ev, "user_id", THROTTLE_SECONDS, **_throttle_flags()) \
        .select("event_id", "user_id", "ts")


SQL_THROTTLE_FORCED = f"""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, ts, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r(user_id, rn, last_ts, passed) AS (
  SELECT user_id, rn,
         CASE WHEN event_type = 'purchase'
              THEN ts - INTERVAL {THROTTLE_SECONDS} SECOND + INTERVAL {REWIND_SECONDS} SECOND
              ELSE ts END,
         event_type IN ('click', 'purchase')
  FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn,
         CASE WHEN e.event_type = 'purchase'
                THEN e.ts - INTERVAL {THROTTLE_SECONDS} SECOND + INTERVAL {REWIND_SECONDS} SECOND
              WHEN e.event_type <> 'signup' AND e.ts - r.last_ts > INTERVAL {THROTTLE_SECONDS} SECOND
                THEN e.ts
              ELSE r.last_ts END,
         (e.event_type <> 'signup' AND e.ts - r.last_ts > INTERVAL {THROTTLE_SECONDS} SECOND)
           OR e.event_type IN ('click', 'purchase')
  FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
SELECT e.event_id, e.user_id, e.ts FROM r JOIN e USING (user_id, rn) WHERE r.passed
"""


def q_stream_throttle_forced(spark, sf_dir):
    st, base = _events_stream(spark, sf_dir, "stream_throttle_forced")
    sink = ST.throttle_sink(base, "user_id", THROTTLE_SECONDS, **_throttle_flags())
    out = _through(st.select("event_id", "user_id", "ts", "event_type"), sink, base)
    return out.select("event_id", "user_id", _ntz("ts"))


# ---------------------------------------------------------------------------
# Streams: events staged as time-ordered file groups, one group per micro-batch
# ---------------------------------------------------------------------------

STREAM_BATCHES = 3
FILES_PER_BATCH = 2


def stage_event_files(spark, sf_dir, name: str):
    """Write ``events`` as STREAM_BATCHES time ranges, appended in time order (rows
    without a time go first), each in as many files as the table's scan has
    partitions, FILES_PER_BATCH at least. A file stream that takes that many
    files per trigger replays the table in event-time order."""
    ev = table(spark, sf_dir, "events")
    files = max(FILES_PER_BATCH, ev.rdd.getNumPartitions())  # a plain scan: known from the plan
    t = E.epoch_micros(ev, "ts")
    probs = [i / STREAM_BATCHES for i in range(1, STREAM_BATCHES)]
    cuts = [int(c) for c in ev.select(t.alias("t")).approxQuantile("t", probs, 0.001)]
    place = sum((F.coalesce(t >= F.lit(c), F.lit(False)).cast("int") for c in cuts), F.lit(0))
    base = scratch_path(spark, name)
    for k in range(STREAM_BATCHES):
        ev.filter(place == k).repartition(files).write.mode("append").parquet(f"{base}/in")
    return f"{base}/in", ev.schema, base, files


def _run_to_files(stream: DataFrame, base: str) -> str:
    out, ck = f"{base}/out", f"{base}/checkpoint"
    q = ST.to_files(stream, out, ck)
    q.awaitTermination()
    return out


def _events_stream(spark, sf_dir, name):
    path, schema, base, files = stage_event_files(spark, sf_dir, name)
    return ST.event_stream(spark, path, schema, files_per_trigger=files), base


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


def q_stream_mask_label(spark, sf_dir):
    """Stateless stream -- mask filter, key look-up, key label -- to a file sink."""
    st, base = _events_stream(spark, sf_dir, "stream_mask_label")
    st = st.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    st = E.mask_filter(st.withColumn("code", F.pmod("k", F.lit(24))), "code", S.FULL_MASK,
                       drop_types=(S.KEY_UP,))
    st = E.label_lookup(st.withColumn("key_code", F.lit(S.FUNCTION_AREA_START) + F.col("k")),
                        "key_code")
    ch = F.when(F.col("k") < 26, F.char(F.col("k") + 97))
    st = st.select("event_id", "code",
                   S.key_label(ch, F.col("key_name"), F.col("event_type") == "view").alias("label"))
    return spark.read.parquet(_run_to_files(st, base))


SQL_STREAM_MASK_LABEL = KEY_VIEW_SQL + f"""
SELECT event_id, k % 24 AS code, {KEY_LABEL_SQL}
FROM kv WHERE ((CAST(1 AS BIGINT) << (k % 24)) & {MASK}) <> 0
"""


def q_stream_displacement(spark, sf_dir):
    st, base = _events_stream(spark, sf_dir, "stream_displacement")
    st = st.withColumn("y", F.get_json_object("props", "$.k").cast("double"))
    out = _through(st.select("event_id", "user_id", "ts", "value", "y"),
                   ST.displacement_sink(base, "user_id", "value", "y"), base)
    return E.moved(out).select("event_id", "user_id", _ntz("ts"),
                               F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"),
                               F.round("distance", 6).alias("distance"))


def q_stream_take_until(spark, sf_dir):
    st, base = _events_stream(spark, sf_dir, "stream_take_until")
    out = _through(st.select("event_id", "user_id", "ts", "event_type"),
                   ST.take_until_sink(base, "user_id", F.col("event_type") == SENTINEL), base)
    return out.select("event_id", "user_id", _ntz("ts"), "event_type")


def q_stream_throttle(spark, sf_dir):
    st, base = _events_stream(spark, sf_dir, "stream_throttle")
    out = _through(st.select("event_id", "user_id", "ts"),
                   ST.throttle_sink(base, "user_id", THROTTLE_SECONDS), base)
    return out.select("event_id", "user_id", _ntz("ts"))


def _through(stream, sink, base):
    ST.for_each_batch(stream, sink, f"{base}/checkpoint").awaitTermination()
    return sink.result(stream.sparkSession)


def q_stream_tick_flags(spark, sf_dir):
    st, base = _events_stream(spark, sf_dir, "stream_tick_flags")
    out = _through(st, ST.tick_flags_sink(f"{base}/flags", "user_id", "ts", TICK, {
        "moved": F.col("event_type") == "view",
        "clicked": F.col("event_type") == "click",
        "scrolled": F.col("event_type") == "purchase",
    }), base)
    return out.select("user_id", _ntz("tick_start"), _ntz("tick_end"), "moved", "clicked", "scrolled")


def q_stream_last_per_second(spark, sf_dir):
    st, base = _events_stream(spark, sf_dir, "stream_last_per_second")
    st = (st.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
          .withColumn("class", S.classify(F.pmod("k", F.lit(3))))
          .select("class", "event_id", "ts", "user_id", "event_type", "value"))
    last = _through(st, ST.last_per_second_sink(f"{base}/last", "class", "ts"), base)
    return last.select("class", "second_key", "event_id", _ntz("ts"), "user_id", "event_type",
                       "value", S.item_key(F.col("class"), F.col("second_key")).alias("item_key"))


def q_stream_retain(spark, sf_dir):
    st, base = _events_stream(spark, sf_dir, "stream_retain")
    sink = ST.RetainSink(f"{base}/kept", "event_type", QUOTA)
    out = _through(st, sink, base)
    return out.select("event_id", _ntz("ts"), "user_id", "event_type", "value", "props")


# ---------------------------------------------------------------------------
# Boosting (label: returned lines)
# ---------------------------------------------------------------------------

BOOST_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BOOST_ROUNDS = 10
HIST_THRESHOLDS = [[5.0 * i for i in range(1, 11)], [0.02, 0.04, 0.06, 0.08]]


def _returned(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("label", (F.col("l_returnflag") == "R").cast("double"))


def q_boost_fit_predict(spark, sf_dir):
    """GBT with the reference's parameter map, fitted and applied to all lines."""
    data = _returned(spark, sf_dir).withColumn("features", P.features(BOOST_FEATURES))
    model = B.fit_boosted(data, B.BoostParams(rounds=BOOST_ROUNDS))
    return B.predict(model, data).select("l_orderkey", "l_linenumber", "label", "prediction")


def q_feature_score(spark, sf_dir):
    data = _returned(spark, sf_dir).withColumn("features", P.features(BOOST_FEATURES))
    model = B.fit_boosted(data, B.BoostParams(rounds=BOOST_ROUNDS))
    return B.feature_score(spark, model)


def q_boost_embeddings(spark, sf_dir):
    """Array column -> vector (R2), GBT on label class 0 vs the rest."""
    emb = table(spark, sf_dir, "embeddings")
    data = emb.select("vec_id", (F.col("label") == 0).cast("double").alias("label"),
                      P.features("embedding").alias("features"))
    model = B.fit_boosted(data, B.BoostParams(rounds=BOOST_ROUNDS))
    return B.predict(model, data).select("vec_id", "label", "prediction")


def q_newton_labels(spark, sf_dir):
    """Documents joined with their quality label; features from whole texts
    (length, lines, words, digits); second-order fit applied to labelled docs."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    text = F.col("text")
    feats = docs.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        F.size(F.split(F.trim(text), "\\s+")).cast("double").alias("n_words"),
        (F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))).cast("double")
        .alias("n_digits"))
    data = feats.join(labels.select("doc_id", F.col("quality").cast("double").alias("label")),
                      "doc_id")
    cols = ["n_chars", "n_lines", "n_words", "n_digits"]
    # the features of the labelled documents, worked out once: texts are not read again to fit and to score
    path = scratch_path(spark, "newton_labels")
    data.write.parquet(path)
    data = spark.read.schema(data.schema).parquet(path)
    model = N.newton_fit(data, "label", cols, N.NewtonParams(rounds=BOOST_ROUNDS))
    return model.transform(data).select("doc_id", "label", F.round("probability", 6)
                                        .alias("probability"), "prediction")


def q_newton_histogram(spark, sf_dir):
    """Round-1 gradient histogram (margin 0: g = 0.5 - y, h = 0.25)."""
    li = _returned(spark, sf_dir)
    binned = N.binned_table(li, "label", ["l_quantity", "l_discount"], HIST_THRESHOLDS)
    hist = N.gradient_histogram(binned, 2, F.lit(0), F.lit(0.5) - F.col("__y"), F.lit(0.25))
    return hist.select("node", "feature", "bin", "n", F.round("sum_g", 6).alias("sum_g"),
                       F.round("sum_h", 6).alias("sum_h"))


def _bin_sql(col: str, ts: list[float]) -> str:
    return "(" + " + ".join(f"CASE WHEN {col} >= {t} THEN 1 ELSE 0 END" for t in ts) + ")"


SQL_NEWTON_HISTOGRAM = f"""
WITH b AS (SELECT CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS y,
                  {_bin_sql('l_quantity', HIST_THRESHOLDS[0])} AS bin0,
                  {_bin_sql('l_discount', HIST_THRESHOLDS[1])} AS bin1 FROM lineitem),
e AS (SELECT 0 AS feature, bin0 AS bin, y FROM b UNION ALL SELECT 1 AS feature, bin1 AS bin, y FROM b)
SELECT 0 AS node, feature, bin, count(*) AS n,
       round(sum(CAST(0.5 AS DOUBLE) - y), 6) AS sum_g, round(sum(CAST(0.25 AS DOUBLE)), 6) AS sum_h
FROM e GROUP BY feature, bin
"""


def q_newton_round(spark, sf_dir):
    """One round of depth one at given thresholds; each tenth line's quantity is
    unknown, so the split also says on which side the unknown go."""
    li = _returned(spark, sf_dir).withColumn(
        "quantity", F.when(F.col("l_orderkey") % 10 != 0, F.col("l_quantity")))
    model = N.newton_fit(li, "label", ["quantity", "l_discount"], N.NewtonParams(rounds=1, max_depth=1, min_child_weight=0.5),
                         HIST_THRESHOLDS)
    return model.transform(li).select("l_orderkey", "l_linenumber", "label",
                                      F.round("probability", 6).alias("probability"), "prediction")


def _bin_or_null_sql(col: str, ts: list[float]) -> str:
    return f"CASE WHEN {col} IS NULL THEN -1 ELSE {_bin_sql(col, ts)} END"


SQL_NEWTON_ROUND = f"""
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS DOUBLE) AS y,
                   CASE WHEN l_orderkey % 10 <> 0 THEN l_quantity END AS quantity, l_discount FROM lineitem),
b AS (SELECT *, {_bin_or_null_sql('quantity', HIST_THRESHOLDS[0])} AS bin0,
             {_bin_or_null_sql('l_discount', HIST_THRESHOLDS[1])} AS bin1 FROM li),
e AS (SELECT 0 AS f, bin0 AS bin, y FROM b UNION ALL SELECT 1, bin1, y FROM b),
hist AS (SELECT f, bin, sum(CAST(0.5 AS DOUBLE) - y) AS g, sum(CAST(0.25 AS DOUBLE)) AS h FROM e GROUP BY f, bin),
t AS (SELECT sum(g) AS g, sum(h) AS h FROM hist WHERE f = 0),
nul AS (SELECT f, sum(CASE WHEN bin = -1 THEN g ELSE 0 END) AS g, sum(CASE WHEN bin = -1 THEN h ELSE 0 END) AS h,
               max(bin) AS top FROM hist GROUP BY f),
cum AS (SELECT f, bin, sum(g) OVER w AS g, sum(h) OVER w AS h FROM hist WHERE bin >= 0
        WINDOW w AS (PARTITION BY f ORDER BY bin)),
side AS (SELECT true AS left_nulls UNION ALL SELECT false),
cand AS (SELECT cum.f, cum.bin, left_nulls, cum.g + CASE WHEN left_nulls THEN nul.g ELSE 0 END AS gl,
                cum.h + CASE WHEN left_nulls THEN nul.h ELSE 0 END AS hl
         FROM cum JOIN nul USING (f) CROSS JOIN side
         WHERE (nul.h > 0 OR left_nulls) AND (cum.bin < nul.top OR (NOT left_nulls AND nul.h > 0))),
gain AS (SELECT cand.*, t.g - gl AS gr, t.h - hl AS hr,
                0.5 * (gl * gl / (hl + 1) + (t.g - gl) * (t.g - gl) / (t.h - hl + 1) - t.g * t.g / (t.h + 1)) AS gain
         FROM cand, t WHERE hl >= 0.5 AND t.h - hl >= 0.5),
best AS (SELECT * FROM gain WHERE gain > 1e-6 ORDER BY round(gain, 7) DESC, f, bin, left_nulls DESC LIMIT 1),
m AS (SELECT b.*, -0.1 * CASE
          WHEN CASE WHEN (CASE WHEN best.f = 0 THEN bin0 ELSE bin1 END) = -1 THEN left_nulls
                    ELSE (CASE WHEN best.f = 0 THEN bin0 ELSE bin1 END) <= best.bin END
          THEN gl / (hl + 1) ELSE gr / (hr + 1) END AS margin FROM b, best)
SELECT l_orderkey, l_linenumber, y AS label, round(1 / (1 + exp(-margin)), 6) AS probability,
       CAST(1 / (1 + exp(-margin)) > 0.5 AS DOUBLE) AS prediction FROM m
"""


def q_newton_fit(spark, sf_dir):
    """Second-order boosted trees on all lines, applied to all lines."""
    li = _returned(spark, sf_dir)
    model = N.newton_fit(li, "label", BOOST_FEATURES, N.NewtonParams(rounds=BOOST_ROUNDS))
    return model.transform(li).select("l_orderkey", "l_linenumber", "label",
                                      F.round("probability", 6).alias("probability"),
                                      "prediction")


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "load_orders": (q_load_orders, SQL_LOAD_ORDERS),
    "load_write_read": (q_load_write_read, SQL_LOAD_WRITE_READ),
    "load_documents": (q_load_documents, "SELECT * FROM documents"),
    "load_pages": (q_load_pages, "SELECT * FROM pages"),
    "schema_profile": (q_schema_profile, SQL_SCHEMA_PROFILE),
    "write_by_class": (q_write_by_class, SQL_WRITE_BY_CLASS),
    "file_listing": (q_file_listing, None),
    "write_by_second": (q_write_by_second, SQL_WRITE_BY_SECOND),
    "item_folders": (q_item_folders, SQL_ITEM_FOLDERS),
    "displacement": (q_displacement, SQL_DISPLACEMENT),
    "class_route": (q_class_route, SQL_CLASS_ROUTE),
    "retain_newest": (q_retain_newest, SQL_RETAIN_NEWEST),
    "evict_list": (q_evict_list, SQL_EVICT_LIST),
    "excess_counts": (q_excess_counts, SQL_EXCESS_COUNTS),
    "take_until": (q_take_until, SQL_TAKE_UNTIL),
    "take_until_turns": (q_take_until_turns, SQL_TAKE_UNTIL_TURNS),
    "mask_filter": (q_mask_filter, SQL_MASK_FILTER),
    "mask_union": (q_mask_union, SQL_MASK_UNION),
    "label_lookup": (q_label_lookup, SQL_LABEL_LOOKUP),
    "key_label": (q_key_label, SQL_KEY_LABEL),
    "key_names": (q_key_names, SQL_KEY_NAMES),
    "pick_choice": (q_pick_choice, SQL_PICK_CHOICE),
    "pick_random": (q_pick_random, SQL_PICK_RANDOM),
    "draw_rows": (q_draw_rows, SQL_DRAW_ROWS),
    "tick_flags": (q_tick_flags, SQL_TICK_FLAGS),
    "dispatch": (q_dispatch, SQL_DISPATCH),
    "top_priority": (q_top_priority, SQL_TOP_PRIORITY),
    "first_item_of_active": (q_first_item_of_active, SQL_FIRST_ITEM_OF_ACTIVE),
    "throttle": (q_throttle, SQL_THROTTLE),
    "throttle_forced": (q_throttle_forced, SQL_THROTTLE_FORCED),
    "stream_mask_label": (q_stream_mask_label, SQL_STREAM_MASK_LABEL),
    "stream_displacement": (q_stream_displacement, SQL_DISPLACEMENT),
    "stream_take_until": (q_stream_take_until, SQL_TAKE_UNTIL),
    "stream_throttle": (q_stream_throttle, SQL_THROTTLE),
    "stream_throttle_forced": (q_stream_throttle_forced, SQL_THROTTLE_FORCED),
    "stream_tick_flags": (q_stream_tick_flags, SQL_TICK_FLAGS),
    "stream_last_per_second": (q_stream_last_per_second, SQL_CLASS_ROUTE),
    "stream_retain": (q_stream_retain, SQL_RETAIN_NEWEST),
    "newton_histogram": (q_newton_histogram, SQL_NEWTON_HISTOGRAM),
    "boost_fit_predict": (q_boost_fit_predict, None),
    "boost_embeddings": (q_boost_embeddings, None),
    "feature_score": (q_feature_score, None),
    "newton_round": (q_newton_round, SQL_NEWTON_ROUND),
    "newton_fit": (q_newton_fit, None),
    "newton_labels": (q_newton_labels, None),
}
