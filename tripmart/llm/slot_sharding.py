"""Shards by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into SLOTS virtual slots; the slot of a record never changes. What changes
is the map from slots to shards: a small table with a version. An edit weighs each slot by its bytes, keeps in
each shard its heaviest slots as long as they fit into an equal share, and deals the
slots that are left, heaviest first, to the shard with the fewest bytes. So the
law that holds is ``bytes``: sizes are near equal, as near as the lightest slots.

All of it is DataFrame functions. The map has SLOTS rows whatever the input's size, so it is broadcast, and
its edit is one row's work. Places within a shard come from a range sort, so a shard of
any size is spread over many tasks.

A record is (doc_id, text): copies of a text under many ids, a null id or an id with many
texts fall into many slots. One record that stands in so many rows that its slot
outweighs a quarter of a shard has that slot split: its rows are dealt by their number to all shards.

Defined results: a null text has size 1; empty texts too; very long texts are hashed whole; equal records share a slot, each row has a
place of its own; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import scratch_dir, stored
from tripmart.llm.positions import with_positions

SHARDS = 8
SLOTS = 8192
LAW = "bytes"
#: A slot is split if it outweighs a shard divided by the first number and holds more rows a shard than the second.
SPLIT_SHARE, SPLIT_ROWS = 4, 16


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot and the row's number of every row."""
    text = F.col("text").cast("string")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), crc.alias("text_crc32"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text_crc32").cast("string"))
    slot = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % slots
    return rows.withColumn("virtual_slot", slot.cast("int")).withColumn("row", F.monotonically_increasing_id())


def slot_weights(rows: DataFrame) -> DataFrame:
    """virtual_slot, bytes, rows: at most SLOTS rows."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The map before anything is weighed: slots dealt in turn."""
    return spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("shard"), F.lit(False).alias("split"))


def edit_map(old: DataFrame, weights: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The map after rebalancing: virtual_slot, shard, split. Shards may have become more or fewer."""
    weighed = old.select("virtual_slot", "shard").join(weights, "virtual_slot", "left").select(
        "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("rows", F.lit(0)).alias("rows"))
    share = weighed.agg((F.sum("bytes") / shards).alias("share"))
    weighed = weighed.join(F.broadcast(share))  # one row
    split = (F.col("bytes") * SPLIT_SHARE > F.col("share")) & (F.col("rows") > SPLIT_ROWS * shards)
    weighed = weighed.withColumn("split", split)
    held = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    whole = weighed.where(~F.col("split"))
    room = whole.agg((F.sum("bytes") / shards).alias("room"))  # what split slots hold goes to all shards alike
    whole = whole.join(F.broadcast(room)).withColumn("stays", (F.col("shard") < shards) & (F.sum("bytes").over(held) <= F.col("room")))
    loads = F.map_from_entries(F.collect_list(F.struct("shard", "load")))
    kept = whole.where("stays").groupBy("shard").agg(F.sum("bytes").alias("load")).agg(loads.alias("loads"))
    pool = F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "virtual_slot"))))
    moved = whole.where(~F.col("stays")).agg(pool.alias("pool")).join(F.broadcast(kept))  # one row each
    start = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.try_element_at("loads", s), F.lit(0)).cast("long"))
    start = F.struct(start.alias("loads"), F.array().cast("array<int>").alias("to"))

    def deal(now: Column, slot: Column) -> Column:
        lightest = (F.array_position(now["loads"], F.array_min(now["loads"])) - 1).cast("int")
        loads = F.transform(now["loads"], lambda x, i: F.when(i == lightest, x + slot["bytes"]).otherwise(x))
        return F.struct(loads.alias("loads"), F.concat(now["to"], F.array(lightest)).alias("to"))

    dealt = moved.select("pool", F.aggregate("pool", start, deal)["to"].alias("to"))
    dealt = dealt.select(F.explode(F.arrays_zip("pool", "to")).alias("m")).select("m.pool.virtual_slot", F.col("m.to").alias("shard"), F.lit(False).alias("split"))
    return reduce(DataFrame.union, [whole.where("stays").select("virtual_slot", "shard", "split"), dealt, weighed.where("split").select("virtual_slot", F.lit(None).cast("int"), "split")])


def save_map(slot_map: DataFrame, folder: str, version: int) -> DataFrame:
    """Write a version of the map; versions that are written stay as they are."""
    path = f"{folder}/version={version}"
    slot_map.coalesce(1).write.mode("error").parquet(path)
    return read_map(slot_map.sparkSession, folder, version)


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, split boolean").parquet(f"{folder}/version={version}")


def place(rows: DataFrame, slot_map: DataFrame, shards: int = SHARDS) -> DataFrame:
    """rows with their shard by a version of the map (SLOTS rows, broadcast)."""
    placed = rows.join(F.broadcast(slot_map), "virtual_slot")
    return placed.withColumn("shard", F.when(F.col("split"), F.col("row") % shards).otherwise(F.col("shard")).cast("int")).drop("split")


def shard(docs: DataFrame, shards: int = SHARDS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, virtual_slot of every row.

    The first map is version 0 under ``folder``; its edit by the slots' bytes, which places the rows, version 1.
    """
    folder = folder or scratch_dir(docs.sparkSession, "slot_map")
    rows = stored(records(docs), "slot_rows")
    first = save_map(first_map(docs.sparkSession, shards), folder, 0)
    edited = save_map(edit_map(first, slot_weights(rows), shards), folder, 1)
    placed = with_positions(place(rows, edited, shards), "shard", ["virtual_slot", "doc_id"], "slot", "slot_places")
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
