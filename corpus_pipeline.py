"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

A stage takes what its predecessor kept and returns the columns of ``documents``; the last one adds
the token ids of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliotab.llm import decontam, langid, neardup, pieces, toxicity
from heliotab.llm.storage import Scratch


NEAR_PERCENT = 80  # similarity of near duplicates; 85 is the contract of query op2 alone


def _packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that a stage works on, and all of them aside, whatever their names are."""
    return docs.select(*needed, F.struct("*").alias("row"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; without a letter, or unlike all languages, they go."""
    named = langid.identify(_packed(docs, "doc_id", "text", "lang"))
    return named.where("not rejected").select("row.*")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    rated = toxicity.rate(_packed(docs, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rated.where("predicted = 0").select("row.*")


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, text, row``: rows with an id of their own, all columns of ``docs`` in ``row``.

    An id that different texts share, or none at all, names no document: such rows get numbers above
    all ids in use.  Other ids stay, also in rows that repeat one text.
    """
    packed = _packed(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text")
    mark = F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())
    ids = packed.groupBy("doc_id").agg(F.min(mark).alias("least"), F.max(mark).alias("most"))
    scratch = Scratch(spark, "ids")
    shared = scratch.store(ids.where("doc_id is null or least != most").select("doc_id"), "shared")
    if shared.isEmpty():
        return packed
    top = packed.agg(F.max("doc_id")).first()[0] or 0
    own = packed.where("doc_id is not null").join(shared, "doc_id", "left_anti")
    # Written once, so that a number stays with its row.
    odd = packed.join(shared, packed.doc_id.eqNullSafe(shared.doc_id), "left_semi")
    odd = scratch.store(odd.withColumn("number", F.monotonically_increasing_id()), "odd")
    odd = odd.select((F.col("number") + max(top, 0) + 1).alias("doc_id"), "text", "row")
    return own.select("doc_id", "text", "row").unionByName(odd)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least doc_id.

    Near duplicates share 0.8 or more of their five-word shingles (``NEAR_PERCENT``).  Of rows that
    repeat an id and its text one stays.  Rows without an id, or whose id another text has too, are
    documents of their own, and stay where no document with an id of its own is in their group.
    """
    rows = _numbered(spark, docs)
    kept = neardup.near_duplicates(rows.select("doc_id", "text"), NEAR_PERCENT).where("kept")
    return rows.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, with or without an id."""
    rows = _numbered(spark, docs)
    found = decontam.leaks(rows.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_ids`` and ``ids`` of every document left."""
    encoded = pieces.encode(docs.select("doc_id", "text"))
    return encoded.selectExpr("doc_id", "coalesce(size(ids), 0) AS n_ids", "ids")


STAGES = [
    ("language", language),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

# Stages fit models and encode with a tokenizer's vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs
