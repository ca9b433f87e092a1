"""Operator 7, sharding by fixed virtual slots (DataFrame functions only).

Records are hashed into ``slots`` virtual slots; bytes are summed per slot. Rows that repeat
one record have one hash; where together they hold more bytes than the mean slot,
they are dealt over as many hashes as they hold such means, by a written row
number. There are fewer such records than slots, so their list is bounded.
A slot-to-shard map has versions: version 1 gives each shard an equal range of
slots, whatever their bytes; ``rebalanced`` edits a version into the next.
An edit leaves a slot where it is while its shard, filled from the largest
slot down, stays within the mean; the slots beyond go, largest first, to the
shard with the least bytes. The map has one row per slot and version, a
fixed size, and is the only thing broadcast.

The law is ``bytes``: sums of sizes near equal over the shards. Within a shard
every record has a place from 0 without gaps, by virtual slot, then id: counts per
slot give each slot's first place, so only records of one virtual slot are sorted
together, never those of a shard.

Defined cases: a null text has no bytes and the CRC of the empty text; null
ids are hashed as null; repeated rows take places of their own, and very many of them slots of their own; with an empty table
the result is empty; columns of the input beside ``doc_id`` and ``text`` are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

SLOTS = 4096
SHARDS = 24
ROW_BYTES = 8


RECORD = ("doc_id", "text_crc32", "size")


def records(documents: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, row``: what sharding needs of a record, without its text, and a number of the row (to be written)."""
    text = F.coalesce(F.encode(F.col("text").cast("string"), "UTF-8"), F.lit(b""))
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.length(text) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )


def heavy_records(rows: DataFrame, *, slots: int = SLOTS) -> DataFrame:
    """The records whose rows hold more than the mean slot together, with the number of ``hashes`` to deal them over; fewer than ``slots``."""
    total = rows.agg(F.sum("size").alias("total")).first()["total"] or 0
    groups = rows.groupBy(*RECORD).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    hashes = F.ceil(F.col("bytes") * F.lit(slots) / F.lit(max(1, total))).cast("bigint")
    return groups.where((F.col("n") > 1) & (F.col("bytes") * F.lit(slots) > F.lit(total))).select(*RECORD, hashes.alias("hashes"))


def slotted(rows: DataFrame, heavy: DataFrame, *, slots: int = SLOTS) -> DataFrame:
    """Written ``records`` with their virtual slot ``vslot``."""
    own = F.broadcast(heavy.select(*(F.col(c).alias(f"of_{c}") for c in RECORD), "hashes"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in RECORD]
    dealt = rows.join(own, same[0] & same[1] & same[2], "left").withColumn("deal", F.pmod(F.xxhash64("row"), F.coalesce("hashes", F.lit(1))))
    hashed = F.when(F.col("deal") == 0, F.xxhash64(*RECORD)).otherwise(F.xxhash64(*RECORD, "deal"))
    return dealt.withColumn("vslot", F.pmod(hashed, F.lit(slots)).cast("int")).select(*rows.columns, "vslot")


def slot_totals(rows: DataFrame) -> DataFrame:
    """``vslot, bytes, n`` of the slots that hold records; a partial sum per task before the shuffle."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def first_map(spark: SparkSession, *, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Version 1: equal ranges of slots."""
    if shards < 1 or slots < shards:
        raise ValueError("need 1 <= shards <= slots")
    slot = F.col("id")
    return spark.range(0, slots, 1, 1).select(
        F.lit(1).alias("version"), slot.cast("int").alias("vslot"), F.floor(slot * shards / F.lit(slots)).cast("int").alias("shard")
    )


def rebalanced(slot_map: DataFrame, totals: DataFrame, *, shards: int = SHARDS) -> DataFrame:
    """The next version of a one-version ``slot_map`` under the bytes in ``totals``.

    Works on one row per slot. A shard number at or over ``shards`` (a shard
    taken away) gives up all of its slots; a new shard starts empty.
    """
    now = slot_map.join(totals.select("vslot", "bytes"), "vslot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0).cast("bigint")))
    everything = Window.partitionBy(F.lit(0))
    filled = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "vslot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = now.withColumn("mean", F.sum("bytes").over(everything) / F.lit(shards)).withColumn(
        "stays", (F.sum("bytes").over(filled) <= F.col("mean")) & (F.col("shard") < shards)
    )
    # One row: what stays per shard, and the slots to place, largest first.
    state = now.groupBy(F.lit(0).alias("one")).agg(
        F.max("version").alias("version"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
        F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct("bytes", F.col("vslot").alias("vslot")))), asc=False).alias("pool"),
    )
    loads = F.expr(
        f"transform(sequence(0, {shards - 1}), k -> aggregate(kept, 0L, (acc, x) -> if(x.shard = k, acc + x.bytes, acc)))"
    )
    placed = F.expr(
        "aggregate(pool, named_struct('loads', loads, 'moves', cast(array() as array<struct<vslot:int,shard:int>>)), (acc, x) -> named_struct("
        "'loads', transform(acc.loads, (l, i) -> if(i = array_position(acc.loads, array_min(acc.loads)) - 1, l + x.bytes, l)),"
        " 'moves', concat(acc.moves, array(named_struct('vslot', x.vslot,"
        " 'shard', cast(array_position(acc.loads, array_min(acc.loads)) - 1 as int))))), acc -> acc.moves)"
    )
    moves = state.withColumn("loads", loads).select("version", F.explode(placed).alias("m")).select(
        (F.col("version") + 1).alias("version"), "m.vslot", "m.shard"
    )
    return now.where("stays").select((F.col("version") + 1).alias("version"), "vslot", "shard").unionByName(moves)


def placed(rows: DataFrame, totals: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` with their shard and place under one version of the map."""
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(totals, "vslot").withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "row")
    ordered = rows.withColumn("place", F.row_number().over(within) - 1)
    # One row per slot: a broadcast of fixed size.
    return ordered.join(F.broadcast(starts.select("vslot", "version", "shard", "first")), "vslot").withColumn("slot", F.col("first") + F.col("place")).drop(
        "first", "place"
    )


def shard(documents: DataFrame, *, slots: int = SLOTS, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(records with ``shard`` and ``slot``, the stored map with all versions)."""
    rows = common.written(records(documents), "records")
    rows = common.written(slotted(rows, heavy_records(rows, slots=slots), slots=slots), "slotted")
    totals = common.written(slot_totals(rows), "slot-bytes")
    first = first_map(documents.sparkSession, slots=slots, shards=shards)
    versions = common.written(first.unionByName(rebalanced(first, totals, shards=shards)), "slot-map")
    return placed(rows, totals, versions.where("version = 2")), versions
