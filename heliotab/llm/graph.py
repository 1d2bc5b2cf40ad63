"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliotab.llm.storage import Scratch


def components(edges: DataFrame, scratch: Scratch, rounds: int = 40) -> DataFrame:
    """``(node, component)`` of every node in ``edges(a, b)``; component is its least node.

    Each round links every node's larger neighbours to its least one, then every node and its
    smaller neighbours to their least one, until nothing changes: logarithmically many rounds.
    Both steps are a grouped minimum and a join back, so that a node with very many neighbours is
    never gathered; a round is written to the shared folder, which ends its lineage.
    """

    def fingerprint(table: DataFrame):
        return table.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()

    def large_star(table: DataFrame) -> DataFrame:
        both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        hub = F.least("u", "m")
        return (
            both.join(least, both.a == least.u)
            .where(F.col("b") > F.col("u"))
            .select(F.col("b").alias("a"), hub.alias("b"))
            .distinct()
        )

    def small_star(table: DataFrame) -> DataFrame:
        # Rows are (larger, smaller): every node to the least of its smaller neighbours.
        least = table.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = table.join(least, table.a == least.u).select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        return moved.where("a != b").unionByName(own).distinct()

    table = (
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    table, seen, spent = scratch.store(table, "edges"), None, []
    for _ in range(rounds):
        now = fingerprint(table)
        if now == seen or not now[0]:
            break
        seen = now
        spent.append(table)
        table = scratch.store(small_star(large_star(table)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    for old in spent:
        scratch.drop(old)
    star = table.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    hubs = table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return star.unionByName(hubs.join(star.select("node"), "node", "left_anti"))
