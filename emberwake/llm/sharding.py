"""Sharding by balanced label propagation, in DataFrame operations alone.

Law ``bytes``: the shards' sizes (UTF-8 bytes of the text plus 1) come near
equal. Documents are linked when their texts are equal; a link whose ends lie
in two shards is cut.

1. Texts are read once, into a narrow table: doc_id, size, crc32, group (hash of
   the text) and whether any other document is linked to it.
2. Linked documents start in a shard by hash, those of at least 1/64 share as
   large documents do in step 3. In each round a (group, shard)
   histogram, aggregated before it is shuffled, tells each document how many
   bytes of neighbours every shard holds; it asks for the shard with the most
   whose room (capacity, an equal share of all bytes, less its load) the document
   fits. Requests are granted in group order while their running sum fits the
   room, so the first of each shard always is. Rounds end when no document has a
   better shard with room, or after ``rounds`` and one more per shard.
   A group beyond a shard's capacity thus fills one shard, then the next.
3. Shards beyond capacity give up linked documents, in group order, until the
   excess is covered. These and the documents without links fill the rooms that
   are left. Those of at least 1/64 share (at most 64 per shard exist, by
   their size) go one by one, the largest first, to the shard of the copy before
   if they fit there, else to the shard with the most room; the rest, laid on a
   line of bytes in group order, are cut at the rooms' running sums. A shard
   thus differs from an equal share by less than its largest document, however
   many documents are linked, unless one document is larger than the share.

Running sums go over (bucket, rest) in two steps, bucket totals first, so no
window holds more than a bucket: there are 4096 buckets per shard, and a group
is spread over 64 of them.

Cases: null text has size 1 and crc32 0, and equals the empty text; null and
repeated doc_ids are documents like others (ties by text); an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwake.llm.common import doc_text, materialise

GROUP_BUCKETS, SPREAD = 64, 64
LARGE_PARTS = 64


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return doc_text(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"))


def _bucket(group: Column, row: Column) -> Column:
    """Ordered buckets: groups in order of their hash, each spread over SPREAD."""
    return F.pmod(F.xxhash64(group, F.lit(1)), F.lit(GROUP_BUCKETS)) * SPREAD + F.pmod(F.xxhash64(row), F.lit(SPREAD))


def _running(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``name``: sum of ``value`` over the rows of ``keys`` before this one in
    (bucket, order). Two windows: over bucket totals, and inside buckets."""
    totals = df.groupBy(*keys, "bucket").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(totals, [*keys, "bucket"])
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_before", "_inside"))


def _largest_first(docs: DataFrame, rooms: list[int]) -> tuple[DataFrame, list[int]]:
    """(row, shard of ``docs``; rooms left): the largest first, each to the shard
    of the copy before if it fits there, else to the one with the most room.
    ``docs`` are at most 64 per shard."""
    def at(acc: Column, d: Column) -> Column:
        return F.when((acc["hash"] == d["text_hash"]) & (F.element_at(acc["rooms"], acc["at"]) >= d["size"]), acc["at"]).otherwise(
            F.array_position(acc["rooms"], F.array_max(acc["rooms"])).cast("int"))

    take = F.aggregate(
        F.sort_array(F.collect_list(F.struct("size", "text_hash", "row")), asc=False),
        F.struct(F.array(*[F.lit(r).cast("long") for r in rooms]).alias("rooms"), F.lit(1).alias("at"),
                 F.lit(None).cast("long").alias("hash"), F.array().cast("array<struct<row:bigint,shard:int>>").alias("placed")),
        lambda acc, d: F.struct(
            F.transform(acc["rooms"], lambda r, k: F.when(k + 1 == at(acc, d), r - d["size"]).otherwise(r)).alias("rooms"),
            at(acc, d).alias("at"), d["text_hash"].alias("hash"),
            F.concat(acc["placed"], F.array(F.struct(d["row"].alias("row"), (at(acc, d) - 1).alias("shard")))).alias("placed")))
    placed = materialise(docs.agg(take.alias("t")).select("t.rooms", "t.placed"), "shard_large")
    return placed.select(F.explode("placed").alias("p")).select("p.row", "p.shard"), placed.first()["rooms"]


def _propagate(linked: DataFrame, shards: int, capacity: int, rounds: int, large: int) -> DataFrame:
    """Shards of the linked documents: row, text_hash, size, bucket, shard."""
    spark = linked.sparkSession
    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    by_size, _ = _largest_first(linked.filter(F.col("size") >= large), [capacity] * shards)
    by_hash = F.pmod(F.xxhash64("row", F.lit(2)), F.lit(shards)).cast("int")
    state = materialise(
        linked.join(F.broadcast(by_size), "row", "left").select(  # at most 64 per shard
            "row", "text_hash", "size", _bucket(F.col("text_hash"), F.col("row")).alias("bucket"),
            F.coalesce("shard", by_hash).alias("shard")), "shard_state")
    for _ in range(rounds + shards):  # a group that fills every shard needs a round for each
        load = state.groupBy("shard").agg(F.sum("size").alias("load"))
        room = {r["shard"]: capacity - (r["load"] or 0) for r in every.join(load, "shard", "left").collect()}  # one per shard
        room_of = F.create_map(*[F.lit(x) for pair in room.items() for x in pair])
        # per group: the bytes of neighbours in each shard that a member may ask for
        held = state.groupBy("text_hash", "shard").agg(F.sum("size").alias("bytes"), F.max("size").alias("size"))
        choice = held.groupBy("text_hash").agg(
            F.max("size").alias("fits"), F.collect_list(F.struct("bytes", "shard")).alias("held")).filter(F.size("held") > 1)  # at most one per shard
        turn = F.pmod(F.xxhash64("text_hash", "shard"), F.lit(1 << 30))
        best = F.transform("held", lambda h: F.struct(
            F.when(room_of[h["shard"]] >= F.col("fits"), h["bytes"]).otherwise(0).alias("bytes"),
            F.pmod(F.xxhash64("text_hash", h["shard"]), F.lit(1 << 30)).alias("turn"), h["shard"].alias("wanted")))
        choice = choice.select("text_hash", F.array_max(best).alias("best"),
                               F.map_from_entries(F.transform("held", lambda h: F.struct(h["shard"], h["bytes"]))).alias("bytes_of"))
        own = F.struct(F.col("bytes_of")[F.col("shard")].alias("bytes"), turn.alias("turn"), F.col("shard").alias("wanted"))
        asks = (state.join(choice, "text_hash")
                .filter((F.col("best.wanted") != F.col("shard")) & (F.col("best") > own))
                .select("row", "text_hash", "size", "bucket", F.col("best.wanted").alias("wanted")))
        granted = (_running(asks, ["wanted"], ["text_hash", "row"], "size", "before")
                   .filter(F.col("before") + F.col("size") <= room_of[F.col("wanted")])
                   .select("row", "wanted"))
        granted = materialise(granted, "shard_moves")
        if granted.isEmpty():
            break
        state = materialise(state.join(granted, "row", "left").select(
            "row", "text_hash", "size", "bucket", F.coalesce("wanted", "shard").alias("shard")), "shard_state")
    return state


def _excess(state: DataFrame, load: dict[int, int], capacity: int) -> DataFrame:
    """row, text_hash, size: the linked documents that shards beyond capacity give up."""
    over = {k: v - capacity for k, v in load.items() if v > capacity}
    if not over:
        return state.select("row", "text_hash", "size").limit(0)
    excess = F.create_map(*[F.lit(x) for pair in over.items() for x in pair])
    leaving = _running(state.filter(F.col("shard").isin(list(over))), ["shard"], ["text_hash", "row"], "size", "before")
    return materialise(leaving.filter(F.col("before") < excess[F.col("shard")]).select("row", "text_hash", "size"), "shard_excess")


def _fill(rest: DataFrame, shards: int, rooms: list[int], large: int) -> DataFrame:
    """Shards of the documents that are in none, by the rooms left."""
    placed, rooms = _largest_first(rest.filter(F.col("size") >= large), rooms)
    rooms = [max(0, r) for r in rooms]
    ends, total = [], 0
    for r in rooms:
        total += r
        ends.append(total)
    small = rest.filter(F.col("size") < large).withColumn("bucket", _bucket(F.col("text_hash"), F.col("row")))
    middle = F.col("before") + F.col("size") / 2
    shard = F.lit(max(range(shards), key=lambda k: rooms[k]))
    for k in reversed(range(shards)):
        shard = F.when(middle < ends[k], F.lit(k)).otherwise(shard)
    line = _running(small.withColumn("one", F.lit(1)), ["one"], ["text_hash", "row"], "size", "before")
    return line.select("row", shard.cast("int").alias("shard")).unionByName(placed)


def balanced_shards(docs: DataFrame, shards: int = 8, rounds: int = 12) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot,
    grown_shard (null: the law is not ``key``)."""
    read = materialise(_documents(docs), "shard_documents")
    sizes = read.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"))
    total = read.agg(F.sum("size")).first()[0] or 0
    capacity = -(-total // shards)
    links = sizes.filter("n > 1").select("text_hash")
    linked = read.join(links, "text_hash", "left_semi")
    large = max(1, -(-capacity // LARGE_PARTS))
    state = _propagate(linked, shards, capacity, rounds, large)

    def loads() -> dict[int, int]:
        return {r["shard"]: r["load"] for r in state.groupBy("shard").agg(F.sum("size").alias("load")).collect()}

    leaving = _excess(state, loads(), capacity)
    state = state.join(leaving, "row", "left_anti")
    load = loads()
    rooms = [max(0, capacity - load.get(k, 0)) for k in range(shards)]
    single = read.join(links, "text_hash", "left_anti").select("row", "text_hash", "size")
    filled = _fill(single.unionByName(leaving), shards, rooms, large)
    shard = materialise(state.select("row", "shard").unionByName(filled), "shard_of_row")
    placed = read.join(shard, "row").withColumn(
        "bucket", F.pmod(F.xxhash64("row", F.lit(4)), F.lit(GROUP_BUCKETS * SPREAD))).withColumn("one", F.lit(1))
    return _running(placed, ["shard"], ["row"], "one", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
