"""Sharding by rendezvous (highest random weight) hashing of stable record keys.

Each key scores every shard by -weight / ln(u), u in (0, 1) drawn from a hash of key and shard; the
largest score wins. A new shard can only win keys for itself, so all others stay where they are. Only
DataFrame functions are used, and no row leaves its place until the slots are numbered.

Slots are gapless numbers within a shard. A shard is far too large for one window, so its rows are
numbered in BUCKETS parts of the hash, and each part starts after the sum of the parts before it: a
table of shards x BUCKETS counts at most, whose size does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
#: Counts that may be sent to every executor: a few megabytes.
BROADCAST_ROWS = 1 << 18


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (an int from 0) of a key; null keys are one key. Ties go to the smaller shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    # 53 bits of the hash, moved off 0 and 1
    u = lambda s: (F.shiftrightunsigned(F.xxhash64(key, F.lit(s)), 11).cast("double") + F.lit(0.5)) / F.lit(2.0**53)
    scores = [F.struct((F.lit(-float(w)) / F.log(u(s))).alias("score"), F.lit(-s).alias("shard")) for s, w in enumerate(weights)]
    return (-F.array_max(F.array(*scores))["shard"]).cast("int") if len(scores) > 1 else F.lit(0)


def assign_shards(df: DataFrame, key: str, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """df with shard and grown_shard (null unless grown weights are given)."""
    k = F.col(f"`{key}`")
    return df.withColumn("shard", rendezvous(k, weights)).withColumn("grown_shard", rendezvous(k, grown) if grown else F.lit(None).cast("int"))


def number_slots(df: DataFrame, order: list[str], shards: int, buckets: int = BUCKETS) -> DataFrame:
    """df (with shard, of so many) with slot, a long from 0 without gaps in each shard; fully repeated rows share no slot.

    Rows are ordered by a hash of `order`, then by `order` itself; rows equal in all of it may swap slots.
    """
    cols = [F.col(f"`{c}`") for c in order]
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("long").alias("__start"))
    within = Window.partitionBy("shard", "__bucket").orderBy(*cols)
    # starts has shards x buckets rows at most, whatever the data
    small = F.broadcast(starts) if shards * buckets <= BROADCAST_ROWS else starts
    return rows.withColumn("__at", F.row_number().over(within)).join(small, ["shard", "__bucket"]).withColumn("slot", F.col("__start") + F.col("__at") - 1).drop("__bucket", "__at", "__start")


def shard_documents(docs: DataFrame, weights: list[float], grown: list[float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with size, text_crc32, law, shard, slot and grown_shard under the law `key`.

    Only the key and the weights decide, so copies of a text may part. A null text has size 1 and crc32 0.
    Columns of docs with these names are replaced; an empty table gives an empty result.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = assign_shards(docs, key, weights, grown).withColumns({"size": (F.octet_length(t) + 1).cast("long"), "text_crc32": F.crc32(t), "law": F.lit("key")})
    return number_slots(rows, [key, "text_crc32", "size"], len(weights))


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder shard=<n> for each shard, its rows in the order of their slots within each file.

    Rows are dealt by shard and a part of the slot, so that no task writes a whole shard.
    """
    part = F.floor(F.col("slot") / 1_000_000)
    sharded.repartition("shard", part).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
