"""Language identification: nearest centroids of TF-IDF n-gram vectors, with rejection.

Features are byte 2-grams and 3-grams of the lower-cased text, every ASCII byte that is no letter
counted as a space, hashed to ``FEATURES`` places.  A text is the vector of log(1 + count) * idf,
scaled to length one; idf comes from all learnable documents: those with text, lang and an id that
is not held out.  For each language ``per_language`` spherical k-means centroids are fitted on a
sample of learnable documents, the ones with the least hashes of their ids: about ``max_rows`` in
total, or ``LEAST_EACH`` of each language where that is more.  Every learnable language has centroids.  The prediction is the language of the centroid with the largest
cosine.  Each centroid set also keeps how similar its own language's documents are, by length;
a document less similar than half of what 99.5 % of them reach is marked ``rejected``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliotab.llm.memory import release
from heliotab.llm.shipping import ship
from heliotab.llm.words import text_blocks

FEATURES = 4096
UNKNOWN = "und"
ROWS = 256  # documents whose dense vectors are held at a time
LEAST_EACH = 20
SCALE = 0.05  # cosine difference that counts as a factor e in the score

_KEEP = np.full(256, 0x20, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def held_out(doc_id: str = "doc_id"):
    """Documents that nothing may be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang`` of the rows that a model may be learned from."""
    given = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    rows = docs.where(~held_out() & given)
    return rows.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def _counts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """First row and n-gram counts (rows x FEATURES) of a few rows at a time."""
    for row, data, offsets in text_blocks(pc.utf8_lower(texts.cast(pa.large_string()))):
        data = _KEEP[data].astype(np.uint32)
        pair = np.zeros(len(data), np.uint32)
        pair[:-1] = data[:-1] << 8 | data[1:]
        triple = np.zeros(len(data), np.uint32)
        triple[:-2] = pair[:-2] << 8 | data[2:]
        two = (pair * np.uint32(0x9E3779B1) >> np.uint32(20)).astype(np.int64)
        three = (triple * np.uint32(0x85EBCA77) >> np.uint32(20)).astype(np.int64)
        blank = data == 0x20
        use2 = np.zeros(len(data), bool)
        use2[:-1] = ~(blank[:-1] & blank[1:])
        use3 = np.zeros(len(data), bool)
        use3[:-2] = use2[:-2] & use2[1:-1]
        ends = offsets[1:]
        use2[ends[ends > 0] - 1] = False
        use3[ends[ends > 0] - 1] = False
        use3[ends[ends > 1] - 2] = False
        for first in range(0, len(offsets) - 1, ROWS):
            n = min(ROWS, len(offsets) - 1 - first)
            a, b = offsets[first], offsets[first + n]
            at = np.repeat(np.arange(n) * FEATURES, np.diff(offsets[first : first + n + 1]))
            flat = np.concatenate([(at + two[a:b])[use2[a:b]], (at + three[a:b])[use3[a:b]]])
            yield row + first, np.bincount(flat, minlength=n * FEATURES).reshape(n, FEATURES)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, and how many there are: ``FEATURES`` rows."""

    def run(batches):
        seen, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for _, counts in _counts(batch.column(0)):
                seen += (counts > 0).sum(axis=0)
                rows += len(counts)
        where = np.flatnonzero(seen)
        yield pa.record_batch({"feature": pa.array(np.append(where, -1)), "docs": pa.array(np.append(seen[where], rows))})

    texts = docs.select(F.col("text").cast("string").alias("text"))
    table = texts.mapInArrow(run, "feature long, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).toArrow()
    feature, n = (table.column(c).to_numpy() for c in ("feature", "docs"))
    frequency, known = np.zeros(FEATURES, np.int64), feature >= 0
    frequency[feature[known]] = n[known]
    total = int(n[~known].sum())
    return frequency, total


def vectors(log_counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = (log_counts * idf).astype(np.float32)
    length = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(length > 0, length, 1)


def cluster(rows: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Spherical k-means from farthest-first starts: at most ``k`` centroids of length one."""

    def unit(x):
        return x / max(float(np.sqrt((x * x).sum())), 1e-9)

    centres = [unit(rows.mean(axis=0))]
    for _ in range(min(k, len(rows)) - 1):
        nearest = (rows @ np.stack(centres).T).max(axis=1)
        # Not the farthest row itself, which is an outlier, but one at the far fifth.
        centres.append(rows[np.argsort(nearest, kind="stable")[len(rows) // 5]])
    centres = np.stack(centres)
    for _ in range(steps):
        own = (rows @ centres.T).argmax(axis=1)
        new = np.stack([unit(rows[own == i].sum(axis=0)) if (own == i).any() else c for i, c in enumerate(centres)])
        if np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return centres


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + counts.sum(axis=1)).astype(int), 15)


def _sample(learn: DataFrame, max_rows: int) -> list[tuple[str, bytes]]:
    """Language and counts of about ``max_rows`` learnable documents, evenly over languages."""
    sizes = learn.groupBy("lang").count().collect()
    if not sizes:
        return []
    each = max(max_rows // len(sizes), LEAST_EACH)
    shares = learn.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, each / r["count"])) for r in sizes], "lang string, share double"
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = (
        learn.join(F.broadcast(shares), "lang")
        .where(place < F.col("share"))
        .orderBy(F.xxhash64("doc_id"), "lang", F.xxhash64("text"))
        .limit(each * len(sizes) * 5 // 4)
    )

    def run(batches):
        for batch in batches:
            for row, counts in _counts(batch.column(1)):
                few = np.minimum(counts, 65535).astype(np.uint16)
                yield pa.record_batch(
                    {"lang": batch.column(0).slice(row, len(few)), "counts": pa.array([x.tobytes() for x in few], pa.binary())}
                )

    table = chosen.select("lang", "text").mapInArrow(run, "lang string, counts binary").toArrow()
    return list(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))


def fit(docs: DataFrame, max_rows: int = 2400, per_language: int = 4) -> dict:
    """The model: idf, centroids with their languages, and the least accepted cosine by length."""
    ship(docs.sparkSession)
    learn = learnable(docs)
    frequency, total = document_frequencies(learn)
    idf = (np.log((1 + total) / (1 + frequency)) + 0.1).astype(np.float32)
    sample = _sample(learn, max_rows)
    sample = [(lang, np.frombuffer(x, np.uint16)) for lang, x in sample if any(x)]
    names = sorted({lang for lang, _ in sample})
    model = {"idf": idf, "languages": names, "centroids": np.zeros((0, FEATURES), np.float32), "of": np.zeros(0, int)}
    model["floor"] = np.zeros(16)
    if not names:
        return model
    counts = np.stack([x for _, x in sample])
    label = np.array([names.index(lang) for lang, _ in sample])
    rows = vectors(np.log1p(counts), idf)
    centres = [cluster(rows[label == i], per_language) for i in range(len(names))]
    model["centroids"] = np.concatenate(centres).astype(np.float32)
    model["of"] = np.repeat(np.arange(len(names)), [len(c) for c in centres])
    best = (rows @ model["centroids"].T).max(axis=1)
    size = length_class(counts)
    for i in range(16):
        # The sample of this length and shorter: short texts are less similar to any centroid.
        near = best[size <= i] if (size <= i).sum() >= 20 else np.zeros(0)
        model["floor"][i] = 0.5 * np.quantile(near, 0.005) if len(near) else 0.0
    return model


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` instead of columns of these names.

    A null text or one without a letter is ``und`` with score 0 and rejected.  Ties go to the
    language that sorts first.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "rejected")]
    names = [f.name for f in fields]
    at = names.index("text")

    def run(batches):
        m = shared.value
        langs = np.array(m["languages"], object)
        for batch in batches:
            letters = batch.column(len(names))
            for row, counts in _counts(batch.column(at).cast(pa.string())):
                n = len(counts)
                known = letters.slice(row, n).fill_null(False).to_numpy(zero_copy_only=False) & bool(len(langs))
                name, score = np.full(n, UNKNOWN, object), np.zeros(n)
                rejected = np.ones(n, bool)
                if len(langs):
                    cosine = vectors(np.log1p(counts), m["idf"]) @ m["centroids"].T
                    best = np.stack([cosine[:, m["of"] == i].max(axis=1) for i in range(len(langs))], axis=1).astype(float)
                    top = best.argmax(axis=1)
                    weight = np.exp((best - best.max(axis=1, keepdims=True)) / SCALE)
                    name = np.where(known, langs[top], UNKNOWN)
                    score = np.where(known, 1 / weight.sum(axis=1), 0.0)
                    rejected = ~known | (best.max(axis=1) < m["floor"][length_class(counts)])
                out = [batch.column(i).slice(row, n) for i in range(len(names))]
                out += [pa.array(name.tolist(), pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(out, [*names, "lang_pred", "score", "rejected"])

    letters = F.col("text").cast("string").rlike(r"\p{L}")
    added = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    return docs.select(*[f"`{n}`" for n in names], letters.alias("has_letters")).mapInArrow(
        run, T.StructType([*fields, *added.fields])
    )


def identify(docs: DataFrame, **options) -> DataFrame:
    """Fit on the learnable rows of ``docs(doc_id, text, lang)`` and predict all of its rows."""
    predicted = predict(docs, fit(docs, **options))
    release()
    return predicted
