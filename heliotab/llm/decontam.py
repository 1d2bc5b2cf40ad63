"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are parted by size: an item of n shingles belongs to the class of the power of two
L >= n.  A document is cut into blocks of L shingle places for each class in use, so that a
passage of an item lies in at most two blocks of about its own size, however long the document is.
Each item and each block has ``HASHES`` MinHash values; block minima of larger classes are minima
of the smaller ones'.  An item is a candidate in a document if one of its values is one of a
block's: an item contained to 80 % shares at least a fifth of the two blocks' shingles, which all
``HASHES`` values miss with probability under 1e-6 for items of ``SHORT`` shingles or more.

Shorter items, whose few shingles a block can hide, are their own class and are searched without
MinHash: of n shingles at least m must be shared, so any n - m + 1 of them hold a shared one, and
these are keys that every shingle of a document is looked up by.  None of them is missed.

A bitmap of the items' values of fixed size tells tasks which blocks are worth keeping; the join on
the values decides, so that an over-full bitmap costs time and no result.  Every candidate is
verified by exact containment on the item's and the whole document's sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliotab.llm.storage import Scratch
from heliotab.llm.words import distinct_sorted, mix, shingle_stream, text_blocks

HASHES = 64
LEAST_CLASS = 16
SHORT = 8
PERCENT = 80

_rng = np.random.default_rng(11)
_MULTIPLIER = (_rng.integers(0, 2**31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADDEND = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def size_class(n: int) -> int:
    out = LEAST_CLASS
    while out < n:
        out *= 2
    return out


def value_keys(minima: np.ndarray, k: int, size: int) -> np.ndarray:
    """64-bit keys of minima of the k-th hash for items or blocks of one class."""
    return mix(minima.astype(np.uint64) | np.uint64(k << 32 | size << 40))


def short_keys(shingles: np.ndarray) -> np.ndarray:
    """64-bit keys of single shingles, apart from those of minima."""
    return mix(shingles ^ np.uint64(0x2545F4914F6CDD1D))


def _items(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Items with words: class (0 for short ones), set and keys."""
    for batch in batches:
        for row, data, offsets in text_blocks(batch.column(1)):
            shingles, at = shingle_stream(data, offsets)
            rows = np.flatnonzero(np.diff(at))
            sets = [distinct_sorted(shingles[at[i] : at[i + 1]]) for i in rows]
            sizes = [size_class(len(own)) if len(own) >= SHORT else 0 for own in sets]
            keys = []
            for own, size in zip(sets, sizes, strict=True):
                if not size:
                    least = max(-(-percent * len(own) // 100), 1)
                    keys.append(short_keys(own[: len(own) - least + 1]))
                    continue
                low = (own >> np.uint64(32)).astype(np.uint32)
                values = [((low * _MULTIPLIER[k]) ^ _ADDEND[k]).min(keepdims=True) for k in range(HASHES)]
                keys.append(np.unique([value_keys(v, k, size)[0] for k, v in enumerate(values)]))
            yield pa.record_batch(
                {
                    "item_id": batch.column(0).take(pa.array(row + rows)).cast(pa.int64()),
                    "size": pa.array(sizes, pa.int64()),
                    "shingles": _lists(sets),
                    "keys": _lists(keys),
                }
            )


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
    values = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


PROBES = (0, 18, 37)  # where a key's three places in the bitmap begin
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27


class KeyFilter:
    """A bitmap with three places for each key; it never misses a key that was put in."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def hits(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys that may be in."""
        some = np.arange(len(keys))
        for shift in PROBES:
            place = keys[some] >> np.uint64(shift) & self.mask
            word = self.words[(place >> np.uint64(6)).astype(np.int64)]
            some = some[(word >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return some


def _key_filter(keys: DataFrame, n: int) -> KeyFilter:
    """Built by grouping; only the bitmap itself, 128 KB to 16 MB, reaches the driver.

    With 256 bits a key, one in 600,000 other keys passes.
    """
    bits = LEAST_BITS
    while bits < 256 * n and bits < MOST_BITS:
        bits *= 2
    places = F.array(*[F.expr(f"shiftrightunsigned(key, {shift}) & {bits - 1}L") for shift in PROBES])
    rows = (
        keys.select(F.explode(places).alias("bit"))
        .groupBy(F.expr("cast(shiftright(bit, 6) as int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63L as int)))").alias("mask"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return KeyFilter(words)


def block_hits(shingles: np.ndarray, classes: list[int], known: KeyFilter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys found in a stream of shingles, with the place range of the blocks that hold them."""
    keys, begins, ends = [], [], []
    if 0 in classes:
        found = short_keys(shingles)
        hit = known.hits(found)
        keys, begins, ends = [found[hit]], [hit], [hit + 1]
        classes = [c for c in classes if c]
        if not classes:
            return keys[0], begins[0], ends[0]
    least = min(classes)
    blocks = -(-len(shingles) // least)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.pad(low, (0, blocks * least - len(low)), mode="edge") if blocks else low
    grid = np.ascontiguousarray(low.reshape(blocks, least).T)
    for k in range(HASHES):
        minima = ((grid * _MULTIPLIER[k]) ^ _ADDEND[k]).min(axis=0)
        size = least
        while True:
            if size in classes:
                found = value_keys(minima, k, size)
                hit = known.hits(found)
                keys.append(found[hit])
                begins.append(hit * size)
                ends.append((hit + 1) * size)
            if size >= max(classes):
                break
            size *= 2
            if len(minima) % 2:
                minima = np.append(minima, minima[-1])
            minima = np.minimum(minima[::2], minima[1::2])
    return np.concatenate(keys), np.concatenate(begins), np.concatenate(ends)


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared, containment`` of every pair of a document and an
    item of which the document holds at least ``percent`` percent of the distinct 5-word shingles.

    Items without words and rows without an id are in no pair.  An item of fewer than five words
    has its whole word sequence as its one shingle, so only equal sequences hold it.  Where rows
    repeat an id, the pair with the largest containment is returned.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    columns = [F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")]
    described = benchmark.where("item_id is not null").select(*columns).mapInArrow(
        lambda batches: _items(batches, percent), "item_id long, size long, shingles array<long>, keys array<long>"
    )
    items = scratch.store(described, "items")
    keys = items.select(F.explode("keys").alias("key")).distinct()
    classes = sorted(r["size"] for r in items.select("size").distinct().collect())
    empty = "doc_id long, item_id long, item_shingles int, shared int, containment double"
    if not classes:
        return spark.createDataFrame([], empty)
    known = spark.sparkContext.broadcast(_key_filter(keys, keys.count()))

    def search(batches):
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(1)):
                shingles, at = shingle_stream(data, offsets)
                if not len(shingles):
                    continue
                found, begin, end = block_hits(shingles, classes, known.value)
                # Blocks run on over the borders of documents: a hit counts for all it touches.
                first = np.searchsorted(at, begin, side="right") - 1
                last = np.searchsorted(at, np.minimum(end, len(shingles)), side="left")
                doc = np.repeat(first, last - first) + np.arange((last - first).sum()) - np.repeat(
                    np.cumsum(last - first) - (last - first), last - first
                )
                key = np.repeat(found, last - first)
                order = np.lexsort((key, doc))
                doc, key = doc[order], key[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
                doc, key = doc[new], key[new]
                rows, cut = np.unique(doc, return_index=True)
                if len(rows):
                    yield pa.record_batch(
                        {
                            "doc_id": batch.column(0).take(pa.array(row + rows)).cast(pa.int64()),
                            "keys": _lists(np.split(key, cut[1:])),
                            "shingles": _lists([distinct_sorted(shingles[at[i] : at[i + 1]]) for i in rows]),
                        }
                    )

    source = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    hits = scratch.store(source.mapInArrow(search, "doc_id long, keys array<long>, shingles array<long>"), "hits")
    candidates = (
        hits.select("doc_id", F.explode("keys").alias("key"))
        .join(items.select("item_id", F.explode("keys").alias("key")), "key")
        .select("doc_id", "item_id")
        .distinct()
    )

    # The candidates go to the items, then to the documents' sets.
    shared = F.size(F.array_intersect("of_item", "of_doc"))
    found = (
        candidates.join(items.select("item_id", F.col("shingles").alias("of_item")), "item_id")
        .join(hits.select("doc_id", F.col("shingles").alias("of_doc")), "doc_id")
        .select("doc_id", "item_id", F.size("of_item").alias("item_shingles"), shared.alias("shared"))
        .where(100 * F.col("shared") >= percent * F.col("item_shingles"))
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
    )
    best = F.max(F.struct("containment", "item_shingles", "shared"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.item_shingles", "best.shared", "best.containment"
    )
