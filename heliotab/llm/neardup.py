"""Near-duplicate documents: MinHash signatures joined within a Hamming distance.

Texts become sets of 5-word shingles (``words``).  Every distinct set has a signature of
``SYMBOLS`` MinHash symbols.  Two sets of similarity J differ in a share of about 1 - J of them.

*Index.*  The first symbols are split into chunks of five, ``CHUNKS`` or more.  The allowed error of
a chunk is enumerated: it gives five keys, each leaving one symbol out, so a pair shares a key if
some chunk has at most one difference.  With fewer than two differences a chunk on average there is
always one (pigeonhole); beyond that a pair at the threshold goes without a key with a probability
of at most ``MISS``, from which ``chunks_for`` takes the number of chunks.  How many differences a
candidate may have follows from ``MISS`` too: 23 of 60 at J = 0.85, 28 of 60 at J = 0.8.

*Search.*  Round one compares each member of a key's bucket with a few neighbours, confirms links
on full sets and contracts them to components.  Round two goes through all pairs of members of
different components in every bucket, in cells of bounded size, so that copies of one another are
never paired among themselves.  A pair is put forward if its signature distance allows
J >= threshold; it comes from the first key that it shares, hence once.  Links are confirmed on
full shingle sets: signatures never decide that two documents are alike.

Rows without a document id are returned alone and link with nothing.  Rows that share an id must
share their text: classes of equal sets are named by their least id.  ``corpus_pipeline`` numbers
rows that do not.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliotab.llm.graph import components
from heliotab.llm.storage import Scratch
from heliotab.llm.words import distinct_sorted, mix, shingle_stream, text_blocks

CHUNKS, CHUNK = 12, 5  # CHUNKS: the least number
INDEXED = CHUNKS * CHUNK
SYMBOLS = 384
CELL = 512  # members of a bucket that are compared with as many others in one step
NEIGHBOURS = 3
FILTER_BITS = 1 << 23
MISS = 2.5e-6  # probability that a pair at the threshold has no key, or too many differences

_rng = np.random.default_rng(7)
_MULTIPLIER = (_rng.integers(0, 2**31, SYMBOLS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADDEND = _rng.integers(0, 2**32, SYMBOLS, dtype=np.uint32)


def most_differences(threshold: float, symbols: int) -> int:
    """Differences that a pair at the threshold exceeds with probability of a few in a million."""
    p = 1 - threshold
    return min(symbols, round(symbols * p + 4.75 * sqrt(symbols * p * (1 - p))))


def chunks_for(threshold: float) -> int:
    """Chunks of which a pair at the threshold has one with at most one difference, but for ``MISS``."""
    close = threshold**CHUNK + CHUNK * (1 - threshold) * threshold ** (CHUNK - 1)
    chunks = max(CHUNKS, ceil(log(MISS) / log(max(1 - close, 1e-9))) if close > 0 else SYMBOLS)
    if chunks * CHUNK > SYMBOLS:
        raise ValueError(f"{SYMBOLS} symbols are too few for a threshold of {threshold}")
    return chunks


def indexed_differences(threshold: float) -> int:
    """Differences in the indexed symbols that a pair at the threshold exceeds with at most ``MISS``."""
    n, p = chunks_for(threshold) * CHUNK, 1 - threshold
    beyond, most = 0.0, n
    while most and beyond + comb(n, most) * p**most * threshold ** (n - most) <= MISS:
        beyond += comb(n, most) * p**most * threshold ** (n - most)
        most -= 1
    return max(most, 2 * CHUNKS - 1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16-bit symbols of a non-empty set of 64-bit fingerprints."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SYMBOLS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = low[None, at : at + 2048] * _MULTIPLIER[:, None]
        part ^= _ADDEND[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return ((least ^ _ADDEND) * np.uint32(0x85EBCA6B) >> np.uint32(16)).astype(np.uint16)


def pack(symbols: np.ndarray, indexed: int) -> np.ndarray:
    """Signature rows as bytes: 16 bits of an indexed symbol, 8 of the others."""
    head = np.ascontiguousarray(symbols[:, :indexed]).view(np.uint8)
    return np.hstack([head, (symbols[:, indexed:] & 0xFF).astype(np.uint8)])


def keys_of(symbols: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """The ``chunks * CHUNK`` keys of each signature: chunk and left-out place, other symbols."""
    out = np.empty((len(symbols), chunks * CHUNK), np.uint64)
    for c in range(chunks):
        part = symbols[:, c * CHUNK : (c + 1) * CHUNK].astype(np.uint64)
        for left_out in range(CHUNK):
            key = np.zeros(len(symbols), np.uint64)
            for j in range(CHUNK):
                if j != left_out:
                    key = (key << np.uint64(16)) | part[:, j]
            out[:, c * CHUNK + left_out] = mix(key + np.uint64((c * CHUNK + left_out) * 0x632BE59BD9B4E019 & (2**64 - 1)))
    return out


def _describer(chunks: int):
    """A task function: size, fingerprints, signature and keys of each text's set."""
    indexed = chunks * CHUNK
    width = SYMBOLS + indexed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in text_blocks(batch.column(1)):
                shingles, at = shingle_stream(data, offsets)
                n = len(at) - 1
                size, sets, symbols = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64), np.zeros((n, SYMBOLS), np.uint16)
                for i in range(n):
                    own = distinct_sorted(shingles[at[i] : at[i + 1]])
                    if len(own):
                        size[i] = len(own)
                        sets[i] = own.sum(dtype=np.uint64), mix(own ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)
                        symbols[i] = signature(own)
                keys = keys_of(symbols, chunks).view(np.int64)
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(pack(symbols, indexed).tobytes())])
                yield pa.record_batch(
                    {
                        "doc_id": ids.slice(row, n).cast(pa.int64()),
                        "n_shingles": pa.array(size),
                        "set_a": pa.array(sets[:, 0].view(np.int64)),
                        "set_b": pa.array(sets[:, 1].view(np.int64)),
                        "sig": flat.cast(pa.binary()),
                        "keys": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * indexed), pa.array(keys.ravel())),
                    }
                )

    return run

def _id_filter(ids: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of fixed size that covers all ids; others may pass it, none of these fails it."""
    bit = F.pmod(F.xxhash64("id"), F.lit(bits))
    rows = (
        ids.select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / 32).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("mask"))
        .toArrow()
    )
    words = np.zeros(bits // 32, np.uint32)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().astype(np.uint32)
    return words


def full_sets(docs: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, shingles)`` of the documents in ``wanted(id)``, recomputed from their whole texts.

    A bitmap of fixed size spares most other texts the work; the join decides.
    """
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(_id_filter(wanted))

    def run(batches):
        for batch in batches:
            bit = batch.column(2).to_numpy()
            hit = (bitmap.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            for row, data, offsets in text_blocks(batch.column(1)):
                shingles, at = shingle_stream(data, offsets)
                own = [distinct_sorted(shingles[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in own]))).astype(np.int32)
                values = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
                yield pa.record_batch(
                    {
                        "id": batch.column(0).slice(row, len(own)).cast(pa.int64()),
                        "shingles": pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    }
                )

    source = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS)).alias("bit"),
    )
    found = source.mapInArrow(run, "id long, shingles array<long>")
    return scratch.store(found.join(wanted, "id", "left_semi"), "sets")


def _pairs_of_cells(batches, offer):
    """Cut the key-sorted stream into cells and give each run of whole cells to ``offer``."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
        cell = np.stack([table.column(c).to_numpy() for c in ("key", "lo", "hi")])
        borders = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
        last = int(borders[-1]) if len(borders) else 0
        if last:
            yield from offer(table.slice(0, last), np.concatenate(([0], borders)))
        rest = table.slice(last).combine_chunks()
    if rest is not None and rest.num_rows:
        cell = np.stack([rest.column(c).to_numpy() for c in ("key", "lo", "hi")])
        borders = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
        yield from offer(rest, np.concatenate(([0], borders, [rest.num_rows])))


def _matcher(threshold: float, exhaustive: bool):
    """A task function: pairs of members of one cell that the signatures don't rule out."""
    near, far = indexed_differences(threshold), most_differences(threshold, SYMBOLS)
    chunks = chunks_for(threshold)
    indexed = chunks * CHUNK
    width = SYMBOLS + indexed

    def offer(table: pa.Table, borders: np.ndarray):
        n = table.num_rows
        rep, comp = table.column("rep").to_numpy(), table.column("comp").to_numpy()
        key, size = table.column("key").to_numpy(), table.column("n_shingles").to_numpy()
        block, lo, hi = (table.column(c).to_numpy() for c in ("block", "lo", "hi"))
        sig = table.column("sig").combine_chunks()
        sig = sig.chunk(0) if isinstance(sig, pa.ChunkedArray) else sig
        flat = np.frombuffer(sig.buffers()[2], np.uint8)[sig.offset * width : (sig.offset + n) * width].reshape(n, width)
        head, tail = np.ascontiguousarray(flat[:, : 2 * indexed]).view(np.uint16), flat[:, 2 * indexed :]
        ends = np.repeat(borders[1:] if borders[-1] == n else np.append(borders[1:], n), np.diff(borders if borders[-1] == n else np.append(borders, n)))
        begins = np.repeat(borders[:-1] if borders[-1] == n else borders, np.diff(borders if borders[-1] == n else np.append(borders, n)))
        own = np.arange(n)
        if exhaustive:
            # In a cell of one block all later members; in a cell of two, the members of the other.
            # Rows are sorted by block inside the cell, so the other block is the cell's last part.
            count = ends - own - 1
            steps = None
        else:
            steps = np.arange(1, NEIGHBOURS + 1)
            count = np.minimum(ends - own - 1, NEIGHBOURS)
        for at, stop in _portions(count + (0 if exhaustive else 1), 1 << 17):
            c = count[at:stop]
            left = np.repeat(own[at:stop], c)
            right = left + 1 + (np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c))
            if not exhaustive:
                left = np.concatenate([begins[at:stop], left])
                right = np.concatenate([own[at:stop], right])
                good = left < right
                left, right = left[good], right[good]
            good = (rep[left] != rep[right]) & (comp[left] != comp[right])
            if exhaustive:
                good &= (lo[left] == hi[left]) | (block[left] != block[right])
            small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
            good &= small >= threshold * large - 1e-9
            left, right = left[good], right[good]
            if not len(left):
                continue
            differ = head[left] != head[right]
            total = differ.sum(axis=1)
            keep = total <= near
            left, right, differ, total = left[keep], right[keep], differ[keep], total[keep]
            if exhaustive and len(left):
                # The first key that the two share; other buckets leave the pair to that one.
                by_chunk = differ.reshape(-1, chunks, CHUNK)
                first = (by_chunk.sum(axis=2) <= 1).argmax(axis=1)
                place = by_chunk[np.arange(len(left)), first].argmax(axis=1)
                mine = keys_of(head[left], chunks)[np.arange(len(left)), first * CHUNK + place].view(np.int64)
                keep = mine == key[left]
                left, right, total = left[keep], right[keep], total[keep]
            total = total + (tail[left] != tail[right]).sum(axis=1)
            keep = total <= far
            a, b = rep[left[keep]], rep[right[keep]]
            if len(a):
                yield pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    def run(batches):
        yield from _pairs_of_cells(batches, offer)

    return run


def _portions(count: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``limit`` pairs each."""
    total = np.concatenate(([0], np.cumsum(count)))
    at = 0
    while at < len(count):
        stop = max(int(np.searchsorted(total, total[at] + limit, side="right")) - 1, at + 1)
        yield at, stop
        at = stop


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets satisfy 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``.

    Documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of shingles; a
    component is named by its least doc_id, which is the one kept.  A null or blank text has an
    empty set and links with nothing.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = scratch.store(
        source.mapInArrow(
            _describer(chunks_for(percent / 100)),
            "doc_id long, n_shingles long, set_a long, set_b long, sig binary, keys array<long>",
        ),
        "described",
    )
    same = ["set_a", "set_b", "n_shingles"]
    linkable = described.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.store(
        linkable.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("keys").alias("keys")),
        "classes",
    )

    # Members of buckets that hold at least two different sets.
    slots = classes.select("rep", F.explode("keys").alias("key"))
    crowded = slots.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = scratch.store(slots.join(crowded, "key"), "members")
    wanted = members.select(F.col("rep").alias("id")).distinct()
    sets = full_sets(docs, wanted, scratch)

    cells = "key long, rep long, members long, comp long, n_shingles long, sig binary, block int, lo int, hi int"
    signs = classes.select("rep", "n_shingles", "sig")
    blocks = F.ceil(F.col("members") / CELL).cast("int")
    names = [part.split()[0] for part in cells.split(", ")]

    def matched(rows: DataFrame, exhaustive: bool) -> DataFrame:
        dealt = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "block", "rep")
        return dealt.select(*names).mapInArrow(_matcher(percent / 100, exhaustive), "a long, b long")

    own = F.pmod(F.xxhash64("rep", "key"), blocks).cast("int")
    first = (
        members.withColumn("block", own)
        .withColumns({"lo": F.col("block"), "hi": F.col("block"), "comp": F.col("rep")})
        .join(signs, "rep")
    )
    links = scratch.store(_confirmed(matched(first, False).distinct(), sets, percent), "links")
    comps = components(links, scratch)

    # Only buckets in which different components meet have anything left to compare.
    placed = members.select("key", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.select("key", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = (
        placed.groupBy("key")
        .agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("members"))
        .where("least < most")
        .select("key", "members")
    )
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    second = (
        placed.join(mixed, "key")
        .withColumn("block", own)
        .withColumn("other", other)
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .join(signs, "rep")
    )
    more = scratch.store(_confirmed(matched(second, True), sets, percent), "links")
    # Round one's components stand for its links: they are stars already and settle in fewer rounds.
    stars = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
    comps = components(stars.unionByName(more), scratch)
    for spent in (members, sets, links, more):
        scratch.drop(spent)

    named = classes.select(*same, "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select(*same, F.coalesce("component", "rep").alias("component"))
    linked = described.select("doc_id", *same).join(named, same, "left")
    name = F.when(
        F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    )
    return linked.select("doc_id", "n_shingles", name.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
