"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of B bits is cut into m segments of about log2(n) bits, and each row is filed under each of
its segments.  Two codes at distance d have some segment at distance d // m at most.  The search
goes through segment radii 0, 1, 2, ...: round r verifies, for every unfinished query, the rows that
differ from it in exactly r bits of some segment.  After round r every row at distance
m * (r + 1) - 1 or less has been seen; a query is finished when its k-th distance is within that.

The index is dealt by segment and the segment's leading bits, so a query visits only the cells whose
leading bits are within the radius; inside a cell the distinct segment values within the radius are
looked up and their rows verified in one step.  Cells that hold too many rows are dealt further by
the hash of the row, and of equal codes only the k + 1 least ids are filed: with ties by id no other
can be an answer.  Equal query codes are searched once, for k + 1 answers of which each query leaves
out itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliotab.llm.storage import Scratch

CELL_ROWS = 20_000
FAR = 1 << 30


def binary_codes(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id, code``: one bit a dimension, set where the value is above its mean over all rows.

    A missing or NaN value gives bit 0; rows without an id or a vector have no code.
    """
    scratch = Scratch(vectors.sparkSession, "codes")
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v")
    )
    values = rows.select(F.posexplode("v").alias("pos", "x")).where("x is not null and not isnan(x)")
    means = {r["pos"]: r["m"] for r in values.groupBy("pos").agg(F.avg("x").alias("m")).collect()}
    dims = max(means, default=-1) + 1
    mean = np.array([means.get(i, np.inf) for i in range(dims)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = -(-max(dims, 1) // 64) * 64
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            use = pos < dims
            bits = np.zeros((len(size), width), np.uint8)
            bits[row[use], pos[use]] = flat[use] > mean[pos[use]]
            packed = np.packbits(bits, axis=1)
            yield pa.record_batch({"id": batch.column(0), "code": pa.array([x.tobytes() for x in packed], pa.binary())})

    return scratch.store(rows.mapInArrow(run, "id long, code binary"), "codes")


def _bits(codes: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1), axis=1)


def _segment(bits: np.ndarray, begin: int, end: int) -> np.ndarray:
    return bits[:, begin:end].astype(np.int64) @ (1 << np.arange(end - begin)[::-1].astype(np.int64))


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, bits: int | None = None) -> DataFrame:
    """``query_id, rank, id, distance``: for each ``queries(id, code)`` its k nearest others.

    Ties go to the smaller id; a query is no answer to itself.  All codes have one width; ``bits``
    is how many of it are in use.  Repeated rows count once.  With fewer than k other rows a query
    has them all.
    """
    spark = codes.sparkSession
    scratch = Scratch(spark, "hamming")
    least = F.row_number().over(W.partitionBy("code").orderBy("id"))
    filed = scratch.store(codes.distinct().withColumn("n", least).where(F.col("n") <= k + 1).drop("n"), "filed")
    stats = filed.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("code")).alias("width")).first()
    empty = "query_id long, rank int, id long, distance int"
    if not stats["n"]:
        return spark.createDataFrame([], empty)
    width = bits or stats["width"] * 8
    m = max(1, round(width / max(8.0, log2(stats["n"]))))
    borders = [width * i // m for i in range(m + 1)]
    lead = min(12, max(0, ceil(log2(max(stats["n"] / CELL_ROWS, 1)))), min(b - a for a, b in zip(borders, borders[1:], strict=False)))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            each = _bits(batch.column(1).to_pylist())
            for j in range(m):
                cell = _segment(each, borders[j], borders[j] + lead)
                yield pa.record_batch(
                    {
                        "seg": pa.array(np.full(len(cell), j, np.int32)),
                        "cell": pa.array(cell.astype(np.int32)),
                        "id": batch.column(0),
                        "code": batch.column(1),
                    }
                )

    index = scratch.store(filed.select("id", "code").mapInArrow(file, "seg int, cell int, id long, code binary"), "index")
    crowd = index.groupBy("seg", "cell").count().agg(F.max("count")).first()[0]
    salts = -(-crowd // (4 * CELL_ROWS))
    placed = index.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))

    def probing(radius: int):
        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = np.arange(1 << lead)
            for batch in batches:
                if not batch.num_rows:
                    continue
                each = _bits(batch.column(1).to_pylist())
                for j in range(m):
                    own = _segment(each, borders[j], borders[j] + lead)
                    near = np.bitwise_count(own[:, None] ^ cells[None]) <= radius
                    row, cell = np.nonzero(near)
                    take = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), j, np.int32)), pa.array(cell.astype(np.int32)), *take.columns],
                        ["seg", "cell", "query_id", "code", "reach"],
                    )

        return probe

    def verifying(radius: int):
        def verify(left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
            if left.num_rows and right.num_rows:
                j = left.column("seg")[0].as_py()
                ids = left.column("id").to_numpy()
                mine = _bits(left.column("code").to_pylist())
                value, place = np.unique(_segment(mine, borders[j], borders[j + 1]), return_inverse=True)
                by = np.argsort(place, kind="stable")
                start = np.searchsorted(place[by], np.arange(len(value) + 1))
                words = np.packbits(mine, axis=1).view(np.uint64)[by]
                theirs = _bits(right.column("code").to_pylist())
                asked = np.packbits(theirs, axis=1).view(np.uint64)
                want = _segment(theirs, borders[j], borders[j + 1])
                for q, reach, code, seg in zip(
                    right.column("query_id").to_numpy(), right.column("reach").to_numpy(), asked, want, strict=True
                ):
                    hit = np.flatnonzero(np.bitwise_count(value ^ seg) == radius)
                    if not len(hit):
                        continue
                    n = start[hit + 1] - start[hit]
                    rows = np.repeat(start[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    distance = np.bitwise_count(words[rows] ^ code).sum(axis=1).astype(np.int64)
                    names = ids[by[rows]]
                    keep = distance <= reach
                    distance, names = distance[keep], names[keep]
                    best = np.lexsort((names, distance))[:k_found]
                    out[0].append(np.full(len(best), q))
                    out[1].append(names[best])
                    out[2].append(distance[best])
            q, i, d = (np.concatenate(x) for x in out)
            return pa.table({"query_id": q.astype(np.int64), "id": i.astype(np.int64), "distance": d.astype(np.int32)})

        return verify

    asked = queries.select(F.col("id").alias("asked_id"), "code").distinct()
    once = asked.groupBy("code").agg(F.min("asked_id").alias("query_id"))
    state = scratch.store(once.select("query_id", "code", F.lit(FAR).alias("reach")), "queries")
    codes_asked, k_found = state, k + 1  # a query's own id may be one of the answers
    found = None
    most = max(b - a for a, b in zip(borders, borders[1:], strict=False))
    for radius in range(most + 1):
        if not state.limit(1).count():
            break

        probes = state.mapInArrow(probing(radius), "seg int, cell int, query_id long, code binary, reach int")
        probes = probes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        where = ["seg", "cell", "salt"]
        fresh = placed.groupBy(*where).cogroup(probes.groupBy(*where)).applyInArrow(
            verifying(radius), "query_id long, id long, distance int"
        )
        pool = fresh if found is None else found.select("query_id", "id", "distance").unionByName(fresh)
        spent = [x for x in (found, state) if x is not None and x is not codes_asked]
        order = W.partitionBy("query_id").orderBy("distance", "id")
        ranked = pool.distinct().withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k_found)
        found = scratch.store(ranked, "found")
        # After this round everything within this distance has been seen.
        seen = m * (radius + 1) - 1
        kth = found.where(F.col("rank") == k_found).select("query_id", F.col("distance").alias("kth"))
        state = scratch.store(
            state.drop("reach")
            .join(kth, "query_id", "left")
            .where(F.col("kth").isNull() | (F.col("kth") > seen))
            .select("query_id", "code", F.coalesce("kth", F.lit(FAR)).alias("reach")),
            "queries",
        )
        for table in spent:
            scratch.drop(table)
    for table in (filed, index, state):
        scratch.drop(table)
    if found is None:  # no queries
        return spark.createDataFrame([], empty)
    # From the codes back to the queries: each has its code's answers but for itself.
    names = asked.join(codes_asked.select("code", "query_id"), "code").select("asked_id", "query_id")
    answers = names.join(found.select("query_id", "id", "distance"), "query_id").where("id <> asked_id")
    order = W.partitionBy("asked_id").orderBy("distance", "id")
    ranked = answers.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select(F.col("asked_id").alias("query_id"), "rank", "id", "distance")
