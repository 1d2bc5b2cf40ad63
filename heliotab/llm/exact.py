"""Exact duplicates by merging sorted runs of digests in a tree.

Every input partition is a run: its distinct text digests in sorted order, each with the smallest
identifier and the number of rows.  Rounds follow a binomial tree over the run numbers: in a round
the runs that differ in the lowest ``BITS`` bits of their number alone meet in one run, which merges
them by digest (partial aggregate, exchange, sorted aggregate) and keeps the smallest identifier.
After the last round one run is left, spread over all tasks by digest.  The answer then goes down the
same tree to the rows.  A text that a third of all rows share is one entry of a run after the first
step, so no task of any round reads more than ``2 ** BITS`` entries of it, on any number of partitions.

Entries are equal only if SHA-256, length and an independent 64-bit hash of the text agree; each
merge compares all three, so an identifier never stands for another text with the same digest.
Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliotab.workspace import stored

BITS = 4  # of the run number in one round: 16 runs are merged at a time
WHITE = r"[\x20\x09-\x0D]+"
KEY = ["digest", "bytes", "check"]


def text_key(text: Column) -> list[Column]:
    """The columns ``KEY`` of a text that is not null."""
    return [
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.xxhash64(text).alias("check"),
    ]


def exact_duplicates(docs: DataFrame, carry: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs(doc_id, text)``.

    Texts are equal if they are after each run of white space became one space; null is the empty
    text.  Of each group exactly one row is kept: one with the smallest doc_id.  Rows without doc_id
    come last: they are kept only in groups that have no id at all (``keep_id`` null).  Of repeated
    rows with the smallest id one is kept.  An empty table gives no rows.  Other columns are ignored,
    whatever their names, but for those in ``carry``, which come back in a struct ``row``.
    """
    clean = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), WHITE, " ")
    packed = [F.struct(*carry).alias("row")] if carry else []
    rows = docs.select("doc_id", clean.alias("text"), *packed).select(
        "doc_id",
        *text_key(F.col("text")),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row_no"),
        *(["row"] if carry else []),
    )
    # Written once: run and row numbers must be the same in every later pass, also after a lost executor.
    rows = stored(rows, "digest-rows")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")
    runs = rows.groupBy("run", *KEY).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    levels = [stored(runs, "digest-runs")]
    left = rows.agg(F.max("run")).first()[0] or 0
    while left > 0:
        left >>= bits
        merged = levels[-1].groupBy(F.shiftright("run", bits).alias("run"), *KEY).agg(
            F.min("first").alias("first"), F.sum("n").alias("n")
        )
        levels.append(stored(merged, "digest-runs"))
    groups = levels.pop().where("n > 1")
    while levels:
        below = levels.pop().select("run", F.shiftright("run", bits).alias("into"), *KEY)
        groups = below.join(groups.withColumnRenamed("run", "into"), ["into", *KEY]).drop("into")
    alone = F.col("n").isNull()
    return rows.join(groups, ["run", *KEY], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("first.row_no") == F.col("row_no"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *(["row"] if carry else []),
    )
