"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are whole words (runs of letters of the lower-cased text) and the first four and five bytes
of longer words.  The vocabulary is every term of a bounded sample of labelled documents; idf counts
all documents of the corpus.  Documents that hold the same terms equally often, whose vectors are
the same, are folded into one example that weighs as many as it stands for.  The examples are
vectors of (1 + log tf) * idf, scaled to length one.

The search goes over all terms, in blocks of similar examples.  Inverted lists of the rarer terms are
added up, one document at a time.  The frequent terms are columns, of which each block knows the maxima:
the sum over the lists and the maxima bound the cosines of a block, and blocks whose bound is below
the k-th cosine found in the most promising ones are skipped.  In the other blocks the columns are
multiplied.  All this is in single precision, with a bounded error; what may be among the k nearest by
that gets its cosine over all terms in double precision.  The k nearest examples are exact.

A neighbour's vote is the part that shared terms have in its cosine, each weighted by what it tells
about the label (the log-likelihood ratio of its presence in examples), and counts more the closer
the neighbour is and the more documents it stands for.  The share of toxic votes is calibrated by an
isotonic fit on the examples' own leave-one-out votes.  A document without any vocabulary term has
no neighbour; its score is the share of toxic ones among such examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliotab.llm.langid import held_out
from heliotab.llm.memory import release
from heliotab.llm.storage import Scratch
from heliotab.llm.words import mix, prefix_hash, span_hash, text_blocks, word_spans

FREQUENT, MOST_FREQUENT = 0.05, 2048  # share of examples from which a term is a column, and how many
PREFIXES = (4, 5)
CUT = 0.3

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[97:123] = False
_SEPARATOR[128:] = False
_BLOCK = 32  # examples bounded at once
_LEAD = 64  # examples of the highest bounds, compared first
_TURNS = 6  # steps towards the direction in which examples differ most
_PORTION = 512  # documents searched at a time
_ENTRIES = 1 << 17  # terms of documents compared with an example at a time (of one, if it alone has more)
_UNTOLD = 1e-3  # evidence of a term that tells nothing: its examples are neighbours all the same


def _term_stream(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, number of rows, and the row and term of every occurrence in them."""
    for row, data, offsets in text_blocks(pc.utf8_lower(texts.cast(pa.large_string()))):
        starts, ends, at = word_spans(data, offsets, _SEPARATOR)
        total = prefix_hash(data)
        rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
        parts, owners = [span_hash(total, starts, ends)], [rows]
        for n in PREFIXES:
            long = ends - starts > n
            part = span_hash(total, starts[long], starts[long] + n)
            parts.append(mix(part ^ np.uint64(n * 0x9E3779B97F4A7C15 & (2**64 - 1))))
            owners.append(rows[long])
        yield row, len(at) - 1, np.concatenate(owners), np.concatenate(parts)


def _fold_sums(at: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """Two sums over the hashes of each row's occurrences: equal for equal bags of terms."""
    out = []
    for values in (mix(hashes), mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A))):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out


class Rows(NamedTuple):
    """Sparse rows of ``width`` terms: row r holds ``term[start[r] : start[r + 1]]``, rising."""

    start: np.ndarray
    term: np.ndarray
    value: np.ndarray
    width: int

    @staticmethod
    def of(table: Rows | np.ndarray) -> Rows:
        if isinstance(table, Rows):
            return table
        row, term = np.nonzero(table)
        return Rows(np.searchsorted(row, np.arange(len(table) + 1)), term, table[row, term], table.shape[1])

    def part(self, some: np.ndarray) -> Rows:
        """Some of the rows."""
        size = self.start[some + 1] - self.start[some]
        at = np.concatenate(([0], np.cumsum(size)))
        entry = np.repeat(self.start[some] - at[:-1], size) + np.arange(at[-1])
        return Rows(at, self.term[entry], self.value[entry], self.width)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


class Vocabulary:
    """Places of the terms, found by a table of their leading bits."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.unique(terms.astype(np.uint64))
        bits = max(len(self.terms).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted((self.terms >> self.shift).astype(np.int64), np.arange((1 << bits) + 1))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 if it is none of the terms."""
        out = np.full(len(hashes), -1)
        lead = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[lead], self.first[lead + 1]
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            same = self.terms[at] == hashes[left]
            out[left[same]] = at[same]
            at = at + 1
            go = ~same & (at < end)
            left, at, end = left[go], at[go], end[go]
        return out

    def of(self, texts: pa.Array) -> Iterator[tuple[int, Rows]]:
        """First row, and how often each of some rows holds each term."""
        v = max(len(self.terms), 1)
        for row, n, rows, hashes in _term_stream(texts):
            place = self.places(hashes)
            known = place >= 0
            key, count = np.unique(rows[known] * v + place[known], return_counts=True)
            yield row, Rows(np.searchsorted(key, np.arange(n + 1) * v), key % v, count, len(self.terms))


def weights(counts: Rows | np.ndarray, idf: np.ndarray) -> Rows | np.ndarray:
    rows = Rows.of(counts)
    value = (1 + np.log(rows.value)) * idf[rows.term]
    owner = rows.owners()
    value = value / np.sqrt(np.bincount(owner, value * value, len(rows.start) - 1))[owner]
    if isinstance(counts, Rows):
        return rows._replace(value=value)
    out = np.zeros(counts.shape)
    out[owner, rows.term] = value
    return out


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values at each of n places."""
    return np.bincount(at, values, n).astype(float, copy=False)  # numpy counts in integers where there are none


def similar_first(columns: np.ndarray, size: int) -> np.ndarray:
    """Examples (columns) in an order that has similar ones together, in blocks of ``size``.

    They are halved again and again along the direction in which they differ most.
    """
    n = columns.shape[1]
    out, todo = [], [np.arange(n)] if n and len(columns) else []
    if not todo:
        return np.arange(n)
    while todo:
        some = todo.pop()
        if len(some) <= size:
            out.append(some)
            continue
        part = columns if len(some) == n else columns[:, some]
        mean = part.mean(axis=1)
        way = np.cos(np.arange(len(columns), dtype=np.float32))  # any start that is the same everywhere
        for _ in range(_TURNS):
            along = way @ part - way @ mean
            way = part @ along - mean * along.sum()
            way /= max(np.linalg.norm(way), 1e-9)
        some = some[np.argsort(way @ part, kind="stable")]
        half = -(-len(some) // (2 * size)) * size
        todo += [some[half:], some[:half]]
    return np.concatenate(out)


class ExampleIndex:
    """All terms of the examples, in blocks: frequent terms as columns with their maxima, others as lists.

    Similar examples share a block.  A block's bound for a query is the largest sum that one of its
    examples has over the lists, plus the maxima of its columns; a block whose bound is below the
    k-th cosine found so far is skipped.  ``skipped`` of ``bounded`` blocks were.
    """

    def __init__(self, examples: Rows | np.ndarray, evidence: np.ndarray | None = None, order: np.ndarray | None = None):
        self.examples = Rows.of(examples)
        self.n = len(self.examples.start) - 1
        self.evidence = np.zeros(self.examples.width) if evidence is None else evidence
        self.order = order
        self.column: np.ndarray | None = None
        self.bounded = self.skipped = 0

    def __reduce__(self):
        """Only the examples and their order are sent; the lists are built again where they are used."""
        return ExampleIndex, (self.examples, self.evidence, self.order)

    def _frequent(self) -> np.ndarray:
        held = np.bincount(self.examples.term, minlength=self.examples.width)
        frequent = np.argsort(-held, kind="stable")[:MOST_FREQUENT]
        return frequent[held[frequent] > FREQUENT * self.n]

    def arrange(self) -> None:
        """Find the order of the examples, once: it is sent along."""
        frequent, rows = self._frequent(), self.examples
        column = np.full(rows.width, -1, np.int32)
        column[frequent] = np.arange(len(frequent))
        columns = np.zeros((len(frequent), self.n), np.float32)
        for i in range(self.n):
            own = slice(rows.start[i], rows.start[i + 1])
            at = column[rows.term[own]]
            columns[at[at >= 0], i] = rows.value[own][at >= 0]
        self.order = similar_first(columns, _BLOCK)

    def _build(self) -> None:
        if self.order is None:
            self.arrange()
        rows, n, frequent = self.examples, self.n, self._frequent()
        width, blocks = len(frequent), -(-n // _BLOCK)
        self.column = np.full(rows.width, -1, np.int32)
        self.column[frequent] = np.arange(width)
        owner, column = rows.owners().astype(np.int32), self.column[rows.term]
        # Examples are numbered by their place in the blocks from here on.
        self.position = np.empty(n, np.int64)
        self.position[self.order] = np.arange(n)
        by = np.flatnonzero(column >= 0)
        self.columns = np.zeros((blocks, width, _BLOCK), np.float32)
        block, within = np.divmod(self.position[owner[by]], _BLOCK)
        self.columns[block, column[by], within] = rows.value[by]
        self.most = np.ascontiguousarray(self.columns.max(axis=2).T) if blocks else np.zeros((width, 0), np.float32)
        by = np.flatnonzero(column < 0)
        by = by[np.argsort(rows.term[by], kind="stable")]
        self.start = np.searchsorted(rows.term[by], np.arange(rows.width + 1))
        self.place, self.weight = self.position[owner[by]].astype(np.int32), rows.value[by].astype(np.float32)
        self.told, self.spread = self.evidence + _UNTOLD, np.zeros(rows.width)
        # The products add up to at most one; each of the sums and roundings errs by at most 2**-24.
        self.error = (width + 12) * 2.0**-24
        del owner, column, by, block, within
        release()  # each worker builds an index beside what its earlier tasks left

    def nearest(
        self, queries: Rows | np.ndarray, k: int, leave_out: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k largest cosines above zero and their examples (-1: fewer), ties by example.

        ``leave_out``: for each query an example that is no answer.
        """
        return self.search(queries, k, leave_out)[:2]

    def search(
        self, queries: Rows | np.ndarray, k: int, leave_out: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``nearest``, and the cosines' parts weighted by the evidence of their terms."""
        if self.column is None:
            self._build()
        rows = Rows.of(queries)
        m = len(rows.start) - 1
        out = np.zeros((m, k)), np.full((m, k), -1), np.zeros((m, k))
        for a in range(0, m if self.n else 0, _PORTION):
            b = min(a + _PORTION, m)
            self._portion(rows, a, b, k, None if leave_out is None else leave_out[a:b], out)
        return out

    def _portion(self, rows: Rows, a: int, b: int, k: int, leave_out: np.ndarray | None, out: tuple) -> None:
        """Answers of queries a to b."""
        m, (blocks, width, _) = b - a, self.columns.shape
        left, listed = np.zeros((m, width), np.float32), np.empty((m, blocks * _BLOCK), np.float32)
        for i in range(m):
            self._add_lists(rows.term[rows.start[a + i] : rows.start[a + i + 1]],
                            rows.value[rows.start[a + i] : rows.start[a + i + 1]], left[i], listed[i])
        if leave_out is not None:
            listed[np.arange(m), self.position[leave_out]] = -4  # below any cosine

        bound = listed.reshape(m, blocks, _BLOCK).max(axis=2) + left @ self.most
        rough = np.zeros(listed.shape, np.float32)
        ask = np.zeros((m, blocks), bool)
        leads = min(-(-_LEAD // _BLOCK), blocks)
        first = np.argpartition(-bound, leads - 1, axis=1)[:, :leads]
        np.put_along_axis(ask, first, True, axis=1)
        self._blocks(rough, listed, left, ask)
        lead = np.take_along_axis(rough.reshape(m, blocks, _BLOCK), first[:, :, None], axis=1).reshape(m, -1)
        least = self._kth(lead, k)
        more = (bound > 0) & (bound >= least[:, None]) & ~ask
        self._blocks(rough, listed, left, more)
        self.bounded, self.skipped = self.bounded + ask.size, self.skipped + ask.size - int(ask.sum() + more.sum())

        row, place = np.nonzero((rough > 0) & (rough >= self._kth(rough, k)[:, None]))
        example = self.order[place]
        cosine, told = self._exact(rows, a + row, example)
        cosine = np.round(cosine, 9)
        by = np.lexsort((example, -cosine, row))
        rank = np.arange(len(by)) - np.searchsorted(row, np.arange(m))[row]
        by, rank = by[rank < k], rank[rank < k]
        for table, found in zip(out, (cosine, example, told), strict=True):
            table[a + row[by], rank] = found[by]

    def _add_lists(self, term: np.ndarray, value: np.ndarray, left: np.ndarray, listed: np.ndarray) -> None:
        """One query's frequent terms, and the sums of its other terms' lists for every example.

        One query at a time: what it gathers stays in a core's own cache.
        """
        column = self.column[term]
        often = column >= 0
        left[column[often]] = value[often]
        rest = ~often
        term, value = term[rest], value[rest]
        first, size = self.start[term], self.start[term + 1] - self.start[term]
        entry = np.repeat(first - np.cumsum(size) + size, size)
        entry += np.arange(len(entry))
        product = np.repeat(value.astype(np.float32), size)
        product *= self.weight.take(entry)
        listed[:] = _sums(self.place.take(entry), product, len(listed))

    def _exact(self, rows: Rows, row: np.ndarray, example: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cosines of some queries and examples in double precision, and these weighted by evidence.

        One example at a time is spread out, for all queries that it may be near to.
        """
        cosine, told = np.zeros(len(row)), np.zeros(len(row))
        by = np.argsort(example, kind="stable")
        begins, sizes = rows.start[row[by]], np.diff(rows.start)[row[by]]
        ends = np.cumsum(sizes)
        borders = np.flatnonzero(np.diff(example[by], prepend=-1, append=self.n)).tolist()
        for at, stop in zip(borders[:-1], borders[1:], strict=True):
            own = slice(self.examples.start[example[by[at]]], self.examples.start[example[by[at]] + 1])
            self.spread[self.examples.term[own]] = self.examples.value[own]
            while at < stop:
                done = ends[at] - sizes[at]
                to = min(max(int(np.searchsorted(ends, done + _ENTRIES, side="right")), at + 1), stop)
                some = [slice(x, x + n) for x, n in zip(begins[at:to].tolist(), sizes[at:to].tolist(), strict=True)]
                term = np.concatenate([rows.term[x] for x in some])
                product = self.spread[term] * np.concatenate([rows.value[x] for x in some])
                first = ends[at:to] - sizes[at:to] - done
                cosine[by[at:to]] = np.add.reduceat(product, first)
                told[by[at:to]] = np.add.reduceat(product * self.told[term], first)
                at = to
            self.spread[self.examples.term[own]] = 0
        return cosine, told

    def _kth(self, rough: np.ndarray, k: int) -> np.ndarray:
        """The k-th largest cosine of each row, less what two of them may err."""
        at = max(rough.shape[1] - k, 0)
        return np.partition(rough, at, axis=1)[:, at] - 2 * self.error if rough.shape[1] >= k else np.zeros(len(rough))

    def _blocks(self, rough: np.ndarray, listed: np.ndarray, left: np.ndarray, ask: np.ndarray) -> None:
        """Cosines, to within ``error``, of the queries that ask for a block and its examples."""
        for j in np.flatnonzero(ask.any(axis=0)):
            own, some = slice(j * _BLOCK, (j + 1) * _BLOCK), np.flatnonzero(ask[:, j])
            rough[some, own] = listed[some, own] + left[some] @ self.columns[j]


def votes(
    best: np.ndarray, who: np.ndarray, told: np.ndarray, toxic: np.ndarray, stands_for: np.ndarray
) -> np.ndarray:
    """The neighbours' share of toxic ones, each by evidence and closeness; NaN without a neighbour."""
    close = np.where(who >= 0, told / (1.05 - np.minimum(best, 1)) * stands_for[who], 0)
    total = close.sum(axis=1)
    return np.where(total > 0, (close * toxic[who]).sum(axis=1) / np.where(total > 0, total, 1), np.nan)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to y in weighted squares, as points to interpolate."""
    pools: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        pools.append([x[i] * w[i], y[i] * w[i], w[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, toxic, text)`` of at most ``per_class`` documents of either label.

    The documents with the least hashes of their ids; also how many labelled ones there are.
    A document with both labels counts as toxic.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = (F.xxhash64("doc_id"), "doc_id")
    halves = [known.where(F.col("toxic") == t).orderBy(*order).limit(per_class) for t in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # 2 * per_class rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    return found, sizes


def label_evidence(counts: Rows, toxic: np.ndarray) -> np.ndarray:
    """What each term's presence tells about the label: the log-likelihood ratio over examples."""
    n1 = toxic.sum()
    n0, n = len(toxic) - n1, len(toxic)
    if not n1 or not n0:
        return np.zeros(counts.width)
    held = np.bincount(counts.term, minlength=counts.width)
    a = np.bincount(counts.term, toxic[counts.owners()], counts.width)
    b = held - a

    def part(observed, expected):
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1) / np.maximum(expected, 1e-300)), 0.0)

    return np.maximum(2 * (
        part(a, held * n1 / n) + part(b, held * n0 / n)
        + part(n1 - a, (n - held) * n1 / n) + part(n0 - b, (n - held) * n0 / n)
    ), 0)


def _own_votes(spark: SparkSession, index: ExampleIndex, k: int, toxic: np.ndarray, stands_for: np.ndarray) -> np.ndarray:
    """Each example's vote from the others, found by tasks: the driver builds no lists."""
    index.arrange()
    shared = spark.sparkContext.broadcast((index, toxic, stands_for))

    def run(batches):
        index, toxic, stands_for = shared.value
        for batch in batches:
            some = batch.column(0).to_numpy()
            vote = votes(*index.search(index.examples.part(some), k, some), toxic, stands_for)
            yield pa.record_batch({"example": pa.array(some), "vote": pa.array(vote)})

    n, tasks = index.n, spark.sparkContext.defaultParallelism
    found = spark.range(0, n, 1, min(tasks, -(-n // _PORTION))).mapInArrow(run, "example long, vote double").toArrow()
    out = np.full(n, np.nan)
    out[found.column("example").to_numpy()] = found.column("vote").to_numpy()
    shared.destroy()
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500, k: int = 15) -> dict:
    """Vocabulary, idf, index and calibration from at most ``2 * per_class`` labelled documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")

    def bags(batches):
        for batch in batches:
            for row, n, rows, hashes in _term_stream(batch.column(2)):
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                every = np.searchsorted(rows, np.arange(n + 1))
                fold_a, fold_b = _fold_sums(every, hashes)
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                at = pa.array(np.searchsorted(rows[new], np.arange(n + 1)).astype(np.int32))
                counts = np.diff(np.append(np.flatnonzero(new), len(rows)))
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(row, n),
                        "toxic": batch.column(1).slice(row, n),
                        "fold_a": pa.array(fold_a),
                        "fold_b": pa.array(fold_b),
                        "occurrences": pa.array(np.diff(every)),
                        "terms": pa.ListArray.from_arrays(at, pa.array(hashes[new].view(np.int64))),
                        "counts": pa.ListArray.from_arrays(at, pa.array(counts.astype(np.int32))),
                    }
                )

    found, sizes = _sample(docs, labels, per_class)
    sample = scratch.store(found, "sample")
    described = sample.select("doc_id", "toxic", "text").mapInArrow(
        bags,
        "doc_id long, toxic int, fold_a long, fold_b long, occurrences long, terms array<long>, counts array<int>",
    )
    described = scratch.store(described, "bags")
    folds = described.groupBy("fold_a", "fold_b", "occurrences", "toxic").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("members")
    )
    single = described.join(folds.select("doc_id", "members"), "doc_id")
    table = single.select("doc_id", "toxic", "members", "terms", "counts").toArrow().sort_by("doc_id")
    ids, toxic, members = (table.column(c).to_numpy() for c in ("doc_id", "toxic", "members"))
    toxic = toxic.astype(float)
    hashes = pc.list_flatten(table.column("terms")).to_numpy().astype(np.int64).view(np.uint64)
    start = np.concatenate(([0], np.cumsum(pc.list_value_length(table.column("terms")).to_numpy()))).astype(np.int64)
    vocabulary = Vocabulary(hashes)
    v = len(vocabulary.terms)
    counts = Rows(start, vocabulary.places(hashes).astype(np.int32), pc.list_flatten(table.column("counts")).to_numpy(), v)
    del table, hashes
    shared = spark.sparkContext.broadcast(vocabulary)

    def occurrences(batches):
        seen, rows = np.zeros(v + 1, np.int64), 0
        for batch in batches:
            for _, held in shared.value.of(batch.column(0)):
                seen[:v] += np.bincount(held.term, minlength=v)
                rows += len(held.start) - 1
        seen[v] = rows
        some = np.flatnonzero(seen)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.record_batch({"term": pa.array(part), "docs": pa.array(seen[part])})

    texts = docs.select(F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(occurrences, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    seen = np.zeros(v + 1)
    seen[found.column("term").to_numpy()] = found.column("docs").to_numpy()
    idf = np.log((1 + seen[v]) / (1 + seen[:v])) + 1
    shared.destroy()

    drawn = {t: max(members[toxic == t].sum(), 1) for t in (0, 1)}
    stands_for = members * np.where(toxic == 1, sizes.get(1, 0) / drawn[1], sizes.get(0, 0) / drawn[0])
    examples = weights(counts, idf)
    index = ExampleIndex(examples, label_evidence(counts, toxic))
    vote = _own_votes(spark, index, k, toxic, stands_for) if len(ids) else np.zeros(0)
    alone, near = np.isnan(vote), ~np.isnan(vote)
    prior = (toxic * stands_for).sum() / max(stands_for.sum(), 1e-9)
    base = ((toxic * stands_for)[alone].sum() + prior) / (stands_for[alone].sum() + 1)
    line = isotonic(vote[near], toxic[near], stands_for[near]) if near.any() else (np.zeros(1), np.full(1, prior))
    return {
        "vocabulary": vocabulary, "idf": idf, "index": index, "toxic": toxic, "stands_for": stands_for,
        "ids": ids, "k": k, "base": float(base), "line": line,
    }


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (score >= 0.3) and ``evidence``.

    ``evidence`` holds the ids of the up to three nearest labelled examples, nearest first.
    Null and empty texts get the score of a text without any vocabulary term.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if f.name not in ("score", "predicted", "evidence")]
    names = [f.name for f in fields]
    at = names.index("text")

    def run(batches):
        release()
        m = shared.value
        for batch in batches:
            for row, counts in m["vocabulary"].of(batch.column(at).cast(pa.string())):
                n = len(counts.start) - 1
                value, evidence = np.full(n, m["base"]), np.full((n, 3), -1)
                if len(m["ids"]):
                    best, who, told = m["index"].search(weights(counts, m["idf"]), m["k"])
                    vote = votes(best, who, told, m["toxic"], m["stands_for"])
                    value = np.where(np.isnan(vote), m["base"], np.interp(np.nan_to_num(vote), *m["line"]))
                    evidence = np.pad(who, ((0, 0), (0, 3)), constant_values=-1)[:, :3]
                held = evidence >= 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(held.sum(axis=1)))).astype(np.int32)),
                    pa.array(m["ids"][evidence[held]] if len(m["ids"]) else np.zeros(0, np.int64)),
                )
                value = np.clip(value, 0, 1)
                out = [batch.column(i).slice(row, n) for i in range(len(names))]
                out += [pa.array(value), pa.array((value >= CUT).astype(np.int32)), lists]
                yield pa.RecordBatch.from_arrays(out, [*names, "score", "predicted", "evidence"])

    added = T.StructType.fromDDL("score double, predicted int, evidence array<bigint>")
    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(run, T.StructType([*fields, *added.fields]))


def rate(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the learnable labelled rows and score all rows of ``docs(doc_id, text)``."""
    scored = score(docs, fit(docs, labels, **options))
    release()
    return scored
