"""How filters interact: what each of them removes, and repeats, in every order of application.

Documents are reduced to counts by part and mask, where bit i of a mask says that filter i fails.
With the matrix M of masks by filters (0 where the filter fails, infinite elsewhere) and the matrix
P of filters by orders that holds each filter's position in the order (the inverse permutations),
the min-plus product of M and P is the step at which an order removes a mask's documents.  Every
count is then scattered, weighted, to its (part, order, step): at the step of the product the filter
removes it, at later steps of failing filters it is redundant there.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliotab.llm.exact import KEY, text_key
from heliotab.workspace import stored

FILTERS = "ABCDE"
LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITALS_PERCENT = 10
SIGNS = "[#$%&*|]"
_CAPITALS = "".join(chr(i) for i in range(65, 91))


def text_failures(text: Column) -> list[Column]:
    """Failure of the filters A to D by a text that is not null."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n_words, n_chars = F.size(words), F.char_length(text)
    capitals = n_chars - F.char_length(F.translate(text, _CAPITALS, ""))
    return [
        (n_words < LEAST_WORDS).alias("A"),
        (100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n_words).alias("B"),
        (100 * capitals > CAPITALS_PERCENT * n_chars).alias("C"),
        F.regexp_like(text, F.lit(SIGNS)).alias("D"),
    ]


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part that fail just the filters of ``mask``.

    A document is good (toxic) if some row of ``labels`` with its doc_id has quality (toxic) 1.  Null
    text counts as empty, null lang as the empty part.  Rows without doc_id count, have no labels, and
    neither fail E nor make others fail it; rows that repeat a doc_id are documents of their own, and
    E compares them with smaller ids only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", *text_key(F.col("text")), *text_failures(F.col("text")))
    bit = [F.when(F.col(f), F.lit(1 << i)).otherwise(0) for i, f in enumerate(FILTERS[:4])]
    rows = rows.select("doc_id", "part", *KEY, (bit[0] + bit[1] + bit[2] + bit[3]).alias("mask"))
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic")
    )
    same = ["part", *KEY, "mask", "good", "toxic"]
    rows = rows.join(marked, "doc_id", "left").na.fill(False, ["good", "toxic"])
    # Rows of one id and text, then the texts: the mask depends on the text, so nothing else is needed of it.
    ids = rows.groupBy("doc_id", *same).agg(F.count(F.lit(1)).alias("copies"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "copies")))
    texts = ids.groupBy(*same).agg(
        F.sum("copies").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("copies")).otherwise(0)).alias("no_id"),
        least.alias("least"),
    )
    # One row for each text, part and label pair is left: a text of a third of all rows is a few of them.
    first = F.min("least.doc_id").over(W.partitionBy(*KEY))
    texts = texts.withColumn(
        "original",
        F.col("no_id") + F.when(F.col("least.doc_id") == first, F.col("least.copies")).otherwise(0),
    )
    repeated = F.col("mask") + (1 << 4)
    halves = texts.select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), F.col("original").alias("n")),
                F.struct(repeated.alias("mask"), (F.col("n") - F.col("original")).alias("n")),
            )
        ).alias("half"),
    ).where("half.n > 0")
    weight = F.col("half.n")
    return halves.groupBy("part", F.col("half.mask").alias("mask")).agg(
        F.sum(weight).alias("n"),
        F.sum(F.when(F.col("good"), weight).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), weight).otherwise(0)).alias("toxic"),
    )


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, filter_order and step, zeros included, from ``counts`` as of ``mask_counts``.

    Works with up to eight filters, one letter each.  Parts are those that ``counts`` has; no counts
    give no rows.
    """
    spark = counts.sparkSession
    orders = ["".join(p) for p in permutations(filters)]
    places = spark.createDataFrame(
        [(i, 1 << i, o, o.index(f) + 1, [o.index(g) + 1 for g in filters]) for i, f in enumerate(filters) for o in orders],
        "filter int, bit int, filter_order string, step int, positions array<int>",
    )
    fails = [F.col("mask").bitwiseAND(1 << i) != 0 for i in range(len(filters))]
    each = counts.select(
        "*", F.explode(F.array(*[F.struct(F.lit(i).alias("filter"), f.alias("fails")) for i, f in enumerate(fails)])).alias("f")
    ).select("part", "mask", "n", "good", "toxic", "f.filter", "f.fails")
    # As many rows as filters times orders, fixed: small enough for every executor.
    each = each.join(F.broadcast(places), "filter")
    # Min-plus product of the mask's row and the order's column; null for a mask without failures.
    removed_at = F.least(*[F.when(f, F.col("positions")[i]) for i, f in enumerate(fails)], F.lit(None).cast("int"))
    each = each.withColumn("removed_at", removed_at)
    here = F.col("fails") & (F.col("removed_at") == F.col("step"))
    earlier = F.col("fails") & (F.col("removed_at") < F.col("step"))

    def total(condition: Column, weight: str) -> Column:
        return F.sum(F.when(condition, F.col(weight)).otherwise(0))

    summed = each.groupBy("part", "filter_order", "step", "filter").agg(
        F.sum("n").alias("all"),
        total(here, "n").alias("removed"),
        total(earlier, "n").alias("redundant"),
        total(F.col("mask") == F.col("bit"), "n").alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
    )
    so_far = W.partitionBy("part", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return summed.select(
        "part",
        "filter_order",
        "step",
        (F.col("all") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(W.partitionBy("part", "filter")).alias("shapley"),
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole ``docs(doc_id, text, lang)``.

    The counts by part and mask are written once; 32 rows a part.
    """
    return audit(stored(mask_counts(docs, labels), "mask-counts"))
