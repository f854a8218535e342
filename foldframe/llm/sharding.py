"""Sharding through a fixed number of virtual slots.

A record's slot comes from a hash of its text, so equal texts meet in one slot;
the number of slots never changes. Bytes are summed per slot and a versioned
table maps slots to shards: version 1 is the longest-first assignment of slots
to the lightest shard, and a rebalancing writes the next version by moving a
few slots. Records are never hashed again for that.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import saved

SLOTS = 4096
# a slot heavier than one shard's fair share is split into so many parts by a second hash of
# the text, and a text heavier than that by its rows into so many more
PARTS = 64
# record numbers inside a shard are counted in so many groups
NUMBER_GROUPS = 1024


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, slot of every record; text_key and spread, a key of its
    text and one that differs among the rows of a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", record_size(F.col("text")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(slots)).cast("int").alias("vslot"), F.xxhash64(text, F.lit(5)).alias("text_key"),
        F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))).alias("spread"))


def with_parts(records: DataFrame, shards: int) -> DataFrame:
    """Adds `part`: -1 for the records of a slot up to a shard's fair share. In a heavier
    slot a text stays in one part, by a second hash; only a text that is heavier than the
    share itself, which no shard could hold, is dealt by its rows. There are fewer heavy
    slots and texts than shards."""
    whole = saved(records.groupBy("vslot").agg(F.sum("size").alias("bytes")), "shard-slots")
    fair = (whole.agg(F.sum("bytes")).first()[0] or 0) / shards
    heavy = F.broadcast(whole.where(F.col("bytes") > fair).select(F.col("vslot").alias("h_slot")))
    of_heavy = records.join(heavy, F.col("vslot") == F.col("h_slot"), "left_semi").groupBy("vslot", "text_key").agg(F.sum("size").alias("bytes"))
    hot = F.broadcast(saved(of_heavy.where(F.col("bytes") > fair).select(F.col("vslot").alias("t_slot"), F.col("text_key").alias("t_key")), "shard-hot"))
    d = records.join(heavy, F.col("vslot") == F.col("h_slot"), "left").join(hot, (F.col("vslot") == F.col("t_slot")) & (F.col("text_key") == F.col("t_key")), "left")
    part = (F.when(F.col("h_slot").isNull(), F.lit(-1)).when(F.col("t_key").isNull(), F.pmod(F.xxhash64("text_key", F.lit(7)), F.lit(PARTS)))
            .otherwise(F.lit(PARTS) + F.pmod(F.xxhash64("spread", F.lit(7)), F.lit(PARTS))).cast("int"))
    return d.withColumn("part", part).drop("h_slot", "t_slot", "t_key")


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes of every slot and part, at most SLOTS + 2 * PARTS * shards rows: (vslot, part,
    bytes), part -1 for a whole slot."""
    return records.groupBy("vslot", "part").agg(F.sum("size").alias("bytes"))


def newest(slot_map: DataFrame) -> DataFrame:
    """The rows of the newest version."""
    return slot_map.where(F.col("version") == slot_map.agg(F.max("version")).first()[0])


def _assigned(ordered: Column, loads: Column) -> Column:
    """Fold over slots (longest first): each goes to the shard that is lightest so far.
    `loads`: bytes per shard at the start. The result's `out` holds the shard of each slot."""
    lightest = lambda a: F.array_position(a, F.array_min(a))
    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("out"))

    def put(acc, slot):
        k = lightest(acc["loads"])
        loads = F.transform(acc["loads"], lambda v, i: F.when(i + 1 == k, v + slot["bytes"]).otherwise(v))
        return F.struct(loads.alias("loads"), F.concat(acc["out"], F.array((k - 1).cast("int"))).alias("out"))

    return F.aggregate(ordered, start, put)["out"]


def build_map(bytes_by_slot: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the slot map: (version, vslot, part, bytes, shard). The slots
    are at most SLOTS plus the parts of under `shards` heavy ones, so one row holds them."""
    item = F.struct((-F.col("bytes")).alias("neg"), "vslot", "part", "bytes")
    one = bytes_by_slot.agg(F.sort_array(F.collect_list(item)).alias("items"))
    loads = F.array_repeat(F.lit(0).cast("long"), shards)
    dealt = one.select("items", _assigned(F.col("items"), loads).alias("out"))
    pair = dealt.select(F.explode(F.arrays_zip("items", "out")).alias("x"))
    return pair.select(F.lit(1).alias("version"), F.col("x.items.vslot").alias("vslot"), F.col("x.items.part").alias("part"),
                       F.col("x.items.bytes").alias("bytes"), F.col("x.out").alias("shard"))


def rebalance(slot_map: DataFrame, shards: int) -> DataFrame:
    """Next version of `slot_map` for `shards` shards.

    A slot moves only when its shard keeps at least the new fair share without
    it (its running bytes, heaviest slots kept first, exceed the share) or when
    its shard is gone; moved slots go, longest first, to the lightest shard.
    All other slots stay where they are."""
    cur = newest(slot_map)
    fair = (cur.agg(F.sum("bytes")).first()[0] or 0) / shards
    w = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = cur.withColumn("upto", F.sum("bytes").over(w))
    stays = (F.col("shard") < shards) & (F.col("upto") <= fair)
    item = F.struct((-F.col("bytes")).alias("neg"), "vslot", "part", "bytes", "shard")
    one = (upto.agg(F.sort_array(F.collect_list(F.when(~stays, item))).alias("items"),
                    F.sort_array(F.collect_list(F.when(stays, item))).alias("kept"), F.max("version").alias("version")))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.aggregate(
        F.col("kept"), F.lit(0).cast("long"), lambda a, x: a + F.when(x["shard"] == s, x["bytes"]).otherwise(F.lit(0).cast("long"))))
    dealt = one.select("version", "kept", "items", _assigned(F.col("items"), loads).alias("out"))
    moved = dealt.select("version", F.explode(F.arrays_zip("items", "out")).alias("x")).select(
        F.col("version") + 1, "x.items.vslot", "x.items.part", "x.items.bytes", "x.out")
    kept = dealt.select("version", F.explode("kept").alias("x")).select(F.col("version") + 1, "x.vslot", "x.part", "x.bytes", "x.shard")
    return kept.union(moved).toDF("version", "vslot", "part", "bytes", "shard")


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard of every record under the newest version in `slot_map`."""
    # bounded: SLOTS rows and the parts of the heavy slots
    m = F.broadcast(newest(slot_map).select(F.col("vslot").alias("m_slot"), F.col("part").alias("m_part"), "shard"))
    on = (F.col("vslot") == F.col("m_slot")) & ((F.col("m_part") == -1) | (F.col("m_part") == F.col("part")))
    return records.join(m, on, "inner").drop("m_slot", "m_part")


def numbered(records: DataFrame) -> DataFrame:
    """Adds `slot`: the record's place in its shard, gapless from 0. Each shard is
    counted in NUMBER_GROUPS groups, so no task holds a whole shard."""
    g = records.withColumn("_group", F.pmod(F.xxhash64("spread", F.lit(3)), F.lit(NUMBER_GROUPS)).cast("int"))
    counts = g.groupBy("shard", "_group").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(F.col("shard").alias("s_shard"), F.col("_group").alias("s_group"), (F.sum("n").over(
        Window.partitionBy("shard").orderBy("_group").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "_group").orderBy("doc_id", "text_crc32", "size")) - 1
    return (g.withColumn("_at", within)
            .join(F.broadcast(starts), (F.col("shard") == F.col("s_shard")) & (F.col("_group") == F.col("s_group")), "inner")
            .withColumn("slot", (F.col("start") + F.col("_at")).cast("long"))
            .drop("_group", "_at", "s_shard", "s_group", "start"))


def write_map(slot_map: DataFrame, path: str) -> None:
    """Appends the newest version of `slot_map` to the table of versions at `path`."""
    newest(slot_map).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """All versions of the slot map at `path`."""
    return spark.read.parquet(path).select(F.col("version").cast("int").alias("version"), "vslot", "part", "bytes", "shard")


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, map_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records with shard and slot, version 1 of the slot map).

    `docs` needs doc_id and text; other columns are ignored. Shards get nearly
    equal bytes. Equal texts share a slot and so a shard; only a text heavier than
    a shard's fair share is dealt by its rows, as no shard could hold it; other texts of its
    slot stay whole. A null text counts as an empty one (size 1). Repeated rows and rows
    with a null doc_id are separate records. An empty table gives no records and an empty
    map. With `map_path` the map is written there as a table of versions."""
    records = saved(with_slots(docs, slots), "shard-records")
    records = saved(with_parts(records, shards), "shard-parts")
    slot_map = saved(build_map(slot_bytes(records), shards), "shard-map")
    if map_path:
        write_map(slot_map, map_path)
    return numbered(place(records, slot_map)).drop("text_key", "spread"), slot_map
