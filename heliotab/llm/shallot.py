"""k-means on integer vectors with Shallot search: exact assignments, few distances.

Every vector keeps its centroid, the second-nearest one, an upper bound of the distance to the first
and a lower bound of the distance to all others; bounds move with the centroids.  Where they still
tell the two apart, nothing is computed.  Otherwise the search starts at whichever of the two is
closer now and goes through that centroid's neighbours in order of their distance to it, only as far
as the ball around it reaches that can hold a centroid nearer than the second-best one found; the
ball shrinks as better ones are found.  Bounds are floating point with a margin; whatever they leave
is compared by exact squared distances in 64-bit integers, ties to the smaller number.

Spark holds the vectors with their bounds and deals them; a round is one pass that writes them
again, and sums by cluster that are combined before they are shuffled.  Only centroids, at most
``k`` rows of 64 integers, are on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliotab.llm.storage import Scratch

DIMS = 64
SCALE = 256
LARGEST = 1 << 27  # of a component: 64 squared differences still fit 63 bits
BLOCK_ROWS = 8192
MARGIN = 1e-9

STATE = "vec_id {id}, v array<int>, cluster int, second int, upper double, lower double, distance long"


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: the vectors of ``dims`` finite components, each as ``floor(scale * x)``.

    Vectors that are null, have another length, or hold a null or a value that is not finite are left
    out, and so are those with a component beyond ``LARGEST``, whose squared distances a long does
    not hold.
    """

    def whole(x: Column) -> Column:
        return F.floor(x.cast("double") * scale)

    def fits(x: Column) -> Column:
        y = x.cast("double")
        return F.coalesce(~F.isnan(y) & (F.abs(y) * scale < LARGEST), F.lit(False))

    good = F.col("embedding").isNotNull() & (F.size("embedding") == dims) & F.forall("embedding", fits)
    v = F.transform("embedding", lambda x: whole(x).cast("int"))
    return vectors.select("vec_id", "embedding").where(good).select("vec_id", v.alias("v"))


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:vec_id``; equal ids in order of the vectors."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.where("vec_id is not null").orderBy(order, "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), -1 if rows else 0)


class Search:
    """Distances between the centroids of a round, sorted neighbours, and how far each has moved."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None):
        self.centroids = centroids
        k = len(centroids)
        apart = np.sqrt(((centroids[:, None] - centroids[None]) ** 2).sum(axis=2).astype(float))
        np.fill_diagonal(apart, -1.0)  # a centroid is the first of its own list
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.half = self.apart[:, 1] / 2 if k > 1 else np.full(k, np.inf)
        self.fresh = before is None
        moved = np.zeros(k) if before is None else np.sqrt(((centroids - before) ** 2).sum(axis=1).astype(float))
        self.moved = moved * (1 + MARGIN)
        top = np.argsort(-self.moved, kind="stable")[:2]
        self.others_moved = np.full(k, self.moved[top[0]])
        if k > 1:
            self.others_moved[top[0]] = self.moved[top[1]]

    def to(self, points: np.ndarray, which: np.ndarray) -> np.ndarray:
        gap = points - self.centroids[which]
        return np.einsum("ij,ij->i", gap, gap)

    def assign(self, points, cluster, second, upper, lower):
        """New cluster, second, upper and lower bound; the number of distances computed."""
        k = len(self.centroids)
        if self.fresh:
            cluster, second = np.zeros(len(points), np.int64), np.full(len(points), min(1, k - 1))
            todo = np.arange(len(points))
        else:
            cluster, second = cluster.astype(np.int64), second.astype(np.int64)
            upper = upper + self.moved[cluster]
            lower = lower - self.others_moved[cluster]
            sure = np.maximum(lower, self.half[cluster]) * (1 - MARGIN)
            todo = np.flatnonzero(upper * (1 + MARGIN) >= sure)
        cluster, second, upper, lower = cluster.copy(), second.copy(), upper.copy(), lower.copy()
        if k == 1:
            return cluster, second, upper, np.full(len(points), np.inf), 0
        best = self.to(points[todo], cluster[todo])
        computed = len(todo)
        if not self.fresh:
            upper[todo] = np.sqrt(best.astype(float))
            sure = np.maximum(lower, self.half[cluster])[todo] * (1 - MARGIN)
            open_ = upper[todo] * (1 + MARGIN) >= sure
            todo, best = todo[open_], best[open_]
        near, next_ = cluster[todo], second[todo]
        other = self.to(points[todo], next_)
        computed += len(todo)
        swap = (other < best) | ((other == best) & (next_ < near))
        near, next_ = np.where(swap, next_, near), np.where(swap, near, next_)
        best, other = np.where(swap, other, best), np.where(swap, best, other)
        start, reach = near.copy(), np.sqrt(best.astype(float))
        skip = next_.copy()  # the one whose distance is known already
        for c in np.unique(start):
            rows = np.flatnonzero(start == c)
            for candidate, apart in zip(self.order[c, 1:], self.apart[c, 1:], strict=True):
                # Neighbours come by distance and the ball only shrinks: who is out stays out.
                ball = (reach[rows] + np.sqrt(other[rows].astype(float))) * (1 + MARGIN)
                rows = rows[apart * (1 - MARGIN) <= ball]
                if not len(rows):
                    break
                look = rows[skip[rows] != candidate]
                d = self.to(points[todo[look]], np.full(len(look), candidate))
                computed += len(look)
                first = (d < best[look]) | ((d == best[look]) & (candidate < near[look]))
                then = ~first & (d < other[look])
                f, t = look[first], look[then]
                other[f], next_[f] = best[f], near[f]
                best[f], near[f] = d[first], candidate
                other[t], next_[t] = d[then], candidate
        cluster[todo], second[todo] = near, next_
        upper[todo], lower[todo] = np.sqrt(best.astype(float)), np.sqrt(other.astype(float))
        return cluster, second, upper, lower, computed


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Arrow batches joined to blocks of about ``BLOCK_ROWS`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64)


def _assigned(state: DataFrame, search: Search, schema: str, last: bool) -> DataFrame:
    """One round over the state: bounds moved, doubtful vectors searched; exact distances in the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            points = _matrix(table.column("v"))
            old = [table.column(c).to_numpy() for c in ("cluster", "second", "upper", "lower")]
            cluster, second, upper, lower, _ = search.assign(points, *old)
            distance = search.to(points, cluster) if last else np.zeros(len(points), np.int64)
            new = pa.table(
                {
                    "vec_id": table.column("vec_id"),
                    "v": table.column("v"),
                    "cluster": pa.array(cluster.astype(np.int32)),
                    "second": pa.array(second.astype(np.int32)),
                    "upper": pa.array(upper),
                    "lower": pa.array(lower),
                    "distance": pa.array(distance),
                }
            )
            yield from new.to_batches(max_chunksize=BLOCK_ROWS)

    return state.mapInArrow(run, schema)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise exact floor of each cluster's mean; clusters without vectors stay.

    Tasks add up their own vectors first, so a cluster of any size is one row a task.
    """
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for table in _blocks(batches):
            cluster, points = table.column("cluster").to_numpy(), _matrix(table.column("v"))
            count += np.bincount(cluster, minlength=k)
            by = np.argsort(cluster, kind="stable")
            cut = np.flatnonzero(np.diff(cluster[by], prepend=-1))
            total[cluster[by][cut]] += np.add.reduceat(points[by], cut, axis=0)
        filled = np.flatnonzero(count)
        yield pa.record_batch(
            {
                "cluster": pa.array(filled.astype(np.int32)),
                "n": pa.array(count[filled]),
                **{f"s{i}": pa.array(total[filled, i]) for i in range(dims)},
            }
        )

    names = ["n", *[f"s{i}" for i in range(dims)]]
    parts = state.select("cluster", "v").mapInArrow(add, "cluster int, " + ", ".join(f"{c} long" for c in names))
    after = centroids.copy()
    for row in parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in names]).collect():
        after[row.cluster] = [row[c] // row.n for c in names[1:]]
    return after


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    ``rounds`` times all vectors are assigned and the centroids replaced, then they are assigned once
    more.  Vectors that ``integer_vectors`` leaves out have no row; repeated rows count each; a vector
    without vec_id is clustered but never a first centroid.  With fewer than k vectors there are as
    many centroids as vectors with an id; without any, the result is empty.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "shallot")
    points = scratch.store(integer_vectors(vectors), "points")
    centroids, before = first_centroids(points, k, seed), None
    kind = points.schema["vec_id"].dataType.simpleString()
    empty = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], empty)
    schema = STATE.format(id=kind)
    state = points.select(
        "vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).alias("second"), F.lit(0.0).alias("upper"),
        F.lit(0.0).alias("lower"), F.lit(0).cast("long").alias("distance"),
    )
    spent = points
    for turn in range(rounds + 1):
        search = Search(centroids, before)
        state = scratch.store(_assigned(state, search, schema, turn == rounds), "state")
        scratch.drop(spent)
        spent = state
        if turn < rounds:
            before, centroids = centroids, _means(state, centroids)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    sums = {r.cluster: r.s for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    each = spark.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), digest[c]) for c in range(len(centroids))],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
