"""Token counts of a corpus from its exact length histogram.

Documents are encoded whole by a given byte-level BPE vocabulary and counted by encoded length.
Sums over the longer lengths then answer, for every context limit, how many documents fit, how
many tokens there are and how many remain if each document is cut at the limit.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliotab.llm.shipping import ship
from heliotab.llm.storage import Scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the split pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BUCKET = 64  # neighbouring lengths that are summed together first

_encoders: dict = {}


def encoder(path: str, pattern: str):
    """The encoder, built once in each worker process."""
    if (path, pattern) not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders[path, pattern] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path, pattern]


def with_token_count(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``docs`` with ``n_tokens long`` of the whole text; a null text has no tokens."""
    ship(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name != "n_tokens"]
    names = [f.name for f in fields]
    kept = [docs.columns.index(n) for n in names]
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern).encode_ordinary
        for batch in batches:
            counts = [len(encode(t.as_py())) if t.is_valid else 0 for t in batch.column(text)]
            columns = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [*names, "n_tokens"])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("n_tokens", T.LongType())]))


def length_histogram(docs: DataFrame, **options) -> DataFrame:
    """``n_tokens, docs``: how many documents have each encoded length, over whole texts."""
    counted = with_token_count(docs.select(F.col("text").cast("string").alias("text")), **options)
    return counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as a context limit.

    ``docs`` of exactly that length, ``docs_longer`` and ``tokens_longer`` beyond it, the corpus
    totals, ``share_within`` (the quantile that the length is), and ``truncated_total``: the tokens
    that remain if every document is cut at the limit.  Between two lengths that occur,
    ``truncated_total`` grows by ``docs_longer`` a token.

    Sums run inside buckets of lengths and over the buckets, so no task sees the whole histogram.
    """
    histogram = Scratch(histogram.sparkSession, "lengths").store(histogram, "histogram")  # encoded once
    tokens = F.col("n_tokens") * F.col("docs")
    rows = histogram.withColumns({"bucket": F.floor(F.col("n_tokens") / BUCKET), "tokens": tokens})
    inside = W.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({"own_docs": F.sum("docs").over(inside), "own_tokens": F.sum("tokens").over(inside)})
    # One row a bucket: the longest document's length / 64 of them.
    sums = rows.groupBy("bucket").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = W.orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    sums = sums.select(
        "bucket",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    longer = F.coalesce("own_docs", F.lit(0)) + F.col("later_docs")
    beyond = F.coalesce("own_tokens", F.lit(0)) + F.col("later_tokens")
    return (
        rows.join(sums, "bucket")
        .withColumns({"docs_longer": longer, "tokens_longer": beyond})
        .select(
            F.col("n_tokens").alias("context_limit"),
            "docs",
            "docs_longer",
            "tokens_longer",
            "total_docs",
            "total_tokens",
            (F.col("total_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias(
                "truncated_total"
            ),
            (1 - F.col("docs_longer") / F.col("total_docs")).alias("share_within"),
        )
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, truncated_total, docs_cut`` for any list of limits."""
    limit = F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("context_limit")
    return (
        histogram.select("n_tokens", "docs", limit)
        .groupBy("context_limit")
        .agg(
            F.sum(F.least("n_tokens", "context_limit") * F.col("docs")).alias("truncated_total"),
            F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("docs")).otherwise(0)).alias("docs_cut"),
        )
    )


def length_quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the least length that at least that share of documents stays within."""
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    return (
        limits.select("context_limit", "share_within", share)
        .where(F.col("share_within") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("context_limit").alias("n_tokens"))
    )
