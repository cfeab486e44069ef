"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly, equal texts kept together.

1. Equal texts form a group. Capacity is a shard's equal part of all bytes, tokens and rows.
2. A group of at least ``1 / FINE`` of a capacity is an item of its own; there are at most 3 * shards * FINE of them.
   A group beyond a whole capacity fits no shard and is split by a hash of the id into parts of about an eighth; its
   rows of one null or repeated id, if they come to ``1 / FINE`` of a capacity themselves, by their row numbers. All
   smaller groups are hashed, whole, into ``BUNDLES`` items. So the driver gets a table of bounded size whatever the
   input holds, and every row is in exactly one item.
3. Items are placed largest first, each where the dot product of its vector with the residual capacity is highest.
   Moves of single items from the fullest to the emptiest shard then level the bytes.
4. Slots are ranks inside a shard, counted in hash buckets, so no task sorts a whole shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.staging import stage

SHARDS = 24
FINE = 256
BUNDLES = 1 << 14
OVERHEAD = 8         # bytes counted for a row besides its text
BUCKET_ROWS = 100_000
MOVES = 5000


def place_items(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every item; ``vectors`` are (items x dimensions) in parts of a shard's capacity."""
    residual = np.ones((shards, vectors.shape[1]))
    where = np.zeros(len(vectors), np.int64)
    for k in np.lexsort((np.arange(len(vectors)), -vectors.max(1, initial=0))):
        fits = (residual >= vectors[k] - 1e-12).all(1)
        worth = residual @ vectors[k]
        where[k] = int(np.argmax(np.where(fits, worth, worth - 1e6)))
        residual[where[k]] -= vectors[k]
    return where


def level(vectors: np.ndarray, where: np.ndarray, shards: int, moves: int = MOVES) -> np.ndarray:
    """Move or swap items between the fullest and the emptiest shard (first dimension) while that narrows the gap."""
    size = vectors[:, 0]
    load = np.bincount(where, size, shards)
    for _ in range(moves):
        high, low = int(load.argmax()), int(load.argmin())
        gap = load[high] - load[low]
        a, b = np.flatnonzero(where == high), np.flatnonzero(where == low)
        order = b[np.argsort(size[b])]
        give = size[a]
        # Best partner to take back for each given item, or nothing.
        want = give - gap / 2
        back = np.concatenate([[0.0], size[order]])
        at = np.clip(np.searchsorted(back, want), 1, max(len(back) - 1, 1))
        near = np.where(np.abs(back[at - 1] - want) <= np.abs(back[np.minimum(at, len(back) - 1)] - want), at - 1,
                        np.minimum(at, len(back) - 1))
        shift = give - back[near]
        off = np.abs(shift - gap / 2)
        k = int(off.argmin()) if len(off) else -1
        if k < 0 or not 0 < shift[k] < gap * (1 - 1e-9):
            break
        where[a[k]] = low
        if near[k]:
            where[order[near[k] - 1]] = high
        load[high] -= shift[k]
        load[low] += shift[k]
    return where


def shard(docs: DataFrame, shards: int = SHARDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, n_tokens, shard, slot) for every row of ``docs``.

    A null text counts as empty, so null and empty texts are one group; repeated rows and null ids are placed each;
    equal items are placed in the order of their names; an empty table gives an empty one; further columns are ignored.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stage(docs.select(
        F.col(id).cast("long").alias("id"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.regexp_count(body, F.lit(r"\S+")).cast("long").alias("n_tokens"),
        F.md5(body.cast("binary")).alias("text_key"), F.monotonically_increasing_id().alias("row")), "shard-rows")
    total = rows.agg(F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count("*").alias("r")).first()
    capacity = [max(total[c] or 0, 1) / shards for c in "btr"]

    groups = rows.groupBy("text_key").agg(F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count("*").alias("r"))
    part = F.greatest(*[F.col(c) / F.lit(cap) for c, cap in zip("btr", capacity)])
    large = groups.withColumn("part", part).filter(F.col("part") >= 1 / FINE).select(
        "text_key", F.when(F.col("part") > 1, F.ceil(8 * F.col("part"))).otherwise(1).cast("int").alias("parts"))
    large = stage(large, "shard-large-groups")  # at most 3 * shards * FINE rows
    split = rows.join(F.broadcast(large.filter("parts > 1")), "text_key").groupBy("text_key", "id").agg(
        F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count("*").alias("r"))
    heavy = split.filter("r > 1").filter(part >= 1 / FINE).select("text_key", F.col("id").alias("heavy_id"), F.lit(True).alias("heavy"))
    heavy = stage(heavy, "shard-heavy-ids")  # at most 3 * shards * FINE rows
    piece = F.pmod(F.when(F.col("heavy"), F.xxhash64("row")).otherwise(F.xxhash64("id", "size")), F.col("parts"))
    item = F.when(F.col("parts").isNotNull(), F.concat_ws(":", "text_key", piece)).otherwise(
        F.concat_ws(":", F.lit("bundle"), F.pmod(F.xxhash64("text_key"), F.lit(BUNDLES))))
    same = (rows["text_key"] == heavy["text_key"]) & rows["id"].eqNullSafe(heavy["heavy_id"])
    named = rows.join(F.broadcast(heavy), same, "left").drop(heavy["text_key"]).join(
        F.broadcast(large), "text_key", "left").withColumn("item", item).drop("row", "heavy", "heavy_id")

    items = named.groupBy("item").agg(F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count("*").alias("r"))
    items = sorted(items.collect(), key=lambda x: x["item"])
    vectors = np.array([[x[c] / cap for c, cap in zip("btr", capacity)] for x in items]).reshape(-1, 3)
    where = level(vectors, place_items(vectors, shards), shards)
    placed = spark.createDataFrame([(x["item"], int(s)) for x, s in zip(items, where)], "item string, shard int")

    buckets = max(1, math.ceil((total["r"] or 0) / shards / BUCKET_ROWS))
    dealt = named.join(F.broadcast(placed), "item").withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "text_key")
    return dealt.withColumn("inside", F.row_number().over(inside)).join(starts, ["shard", "bucket"]).select(
        F.col("id").alias(id), "size", "text_crc32", "n_tokens", "shard",
        (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"))


def shard_digest(docs: DataFrame) -> DataFrame:
    """The shards of all documents under the law of near equal bytes."""
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"), "n_tokens")
