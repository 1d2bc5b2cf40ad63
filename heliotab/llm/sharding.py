"""Shards of near-equal bytes by Karmarkar-Karp differencing; equal texts stay together.

A group of equal texts is indivisible.  Groups of at least 1 / ``PIECES`` of all bytes are pieces of
their own, at most ``PIECES`` of them; the others are dealt by the hash of their text to ``PIECES``
bundles.  So there are at most 2 * ``PIECES`` pieces, however many documents there are, and only these
sums are differenced: the two partial partitions with the largest spread (largest less smallest
part) are combined again and again, the largest part of one with the smallest of the other, until
one is left.  Everything for single rows runs on Spark.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliotab.llm.storage import Scratch

OVERHEAD = 16  # bytes that a row takes besides its text
PIECES = 1 << 13
SLOT_ROWS = 100_000  # rows that are numbered in one task


def difference(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each piece, by Karmarkar-Karp differencing into ``parts`` parts."""
    n = len(sizes)
    if not n:
        return np.zeros(0, int)
    # A partial partition: sums in falling order; how its places map to those of its two sources.
    sums: list[np.ndarray | None] = []
    made: list[tuple[int, int, np.ndarray] | None] = [None] * n
    heap = []
    for i, size in enumerate(sizes):
        own = np.zeros(parts, np.int64)
        own[0] = size
        sums.append(own)
        heap.append((-int(size) if parts > 1 else 0, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        sums[a] = sums[b] = None
        heapq.heappush(heap, (-int(both[0] - both[-1]), len(sums)))
        sums.append(both)
        made.append((a, b, order))
    part_of: dict[int, np.ndarray] = {heap[0][1]: np.arange(parts)}
    out = np.zeros(n, int)
    for node in range(len(sums) - 1, -1, -1):
        places = part_of.pop(node)
        if made[node] is None:
            out[node] = places[0]
            continue
        a, b, order = made[node]
        of_a = np.empty(parts, int)
        of_a[order] = places
        part_of[a], part_of[b] = of_a, of_a[::-1]
    return out


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``size`` is the text's UTF-8 bytes plus 16; a null text has none and all nulls are one group
    with the crc32 of no bytes.  Law ``bytes``: shard sizes are near equal, as far as the groups
    allow; ``grown_shard`` is null.  ``slot`` counts a shard's rows from 0 without gaps.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.col("text").cast("string")
    bytes_ = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = scratch.store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (bytes_ + OVERHEAD).alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("same"),
            F.spark_partition_id().alias("origin"),  # parts repeated rows when slots are numbered
        ),
        "rows",
    )
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    bundle = F.pmod(F.xxhash64("same"), F.lit(PIECES)).cast("int")
    groups = rows.groupBy("same").agg(F.sum("size").alias("bytes"))
    groups = scratch.store(groups.withColumn("large", F.col("bytes") * PIECES >= F.lit(total["bytes"] or 0)), "groups")
    large = groups.where("large").orderBy(F.desc("bytes"), "same").collect()  # at most PIECES
    bundles = (
        groups.where("not large").groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).orderBy("bundle").collect()
    )
    sizes = np.array([r["bytes"] for r in large] + [r["bytes"] for r in bundles], np.int64)
    parts = difference(sizes, shards).tolist()
    own = [(bytearray(r["same"]) if r["same"] is not None else None, p) for r, p in zip(large, parts, strict=False)]
    dealt = [(r["bundle"], p) for r, p in zip(bundles, parts[len(large) :], strict=True)]
    own = spark.createDataFrame(own, "large_same binary, own_shard int")
    dealt = spark.createDataFrame(dealt, "bundle int, bundle_shard int")
    placed = (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(own), F.col("same").eqNullSafe(F.col("large_same")), "left")
        .join(F.broadcast(dealt), "bundle", "left")
        .withColumn("shard", F.coalesce("own_shard", "bundle_shard"))
    )
    # Slots: numbers inside parts of a shard, after the rows of the parts before.
    cuts = max(1, -(-total["n"] // (shards * SLOT_ROWS)))
    placed = scratch.store(
        placed.select(
            "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "same", "origin"), F.lit(cuts)).alias("cut")
        ),
        "placed",
    )
    before = W.partitionBy("shard").orderBy("cut").rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "cut").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("shard", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    number = F.row_number().over(W.partitionBy("shard", "cut").orderBy("doc_id", "text_crc32", "size"))
    return (
        placed.withColumn("number", number)
        .join(offsets, ["shard", "cut"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("number") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
