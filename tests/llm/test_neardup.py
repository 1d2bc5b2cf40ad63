from math import comb

import numpy as np
from brute_text import near_duplicates as brute
from pyspark.sql import functions as F

from heliotab.llm import graph, neardup, words
from heliotab.llm.storage import Scratch


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_all_documents_against_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert result(neardup.near_duplicates(documents)) == brute(rows)


def test_group_of_near_copies_and_odd_texts(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(700):  # more than one cell of a bucket
        own = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 9)):
            own[at] = f"x{rng.integers(0, 50)}"
        rows.append((i + 10, " ".join(own)))
    long = " ".join(f"l{i}" for i in range(30_000))
    rows += [
        (1000, None), (1001, ""), (1002, " \n\t"), (1003, "One two"), (1004, "one  TWO"), (1005, "one two three"),
        (1006, long), (1007, long + " end"), (1008, "É É É É É"), (1009, "é é é é é"), (1010, "a b c d e"),
        (5, "a  b\nc d E"), (1011, "x" * 200_000), (1012, "x" * 200_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keys", F.lit("clash"))
    assert result(neardup.near_duplicates(df.withColumn("component_id", F.lit(3)))) == brute(rows)


def test_nulls_repeats_and_empty_table(spark):
    schema = "doc_id long, text string"
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "a b c d e f"), (None, None)]
    got = sorted(map(tuple, neardup.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False), (None, 2, None, True), (None, 0, None, True)], key=str)
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(2)
    for errors in (0, 1, 12, 2 * neardup.CHUNKS - 1):
        a = rng.integers(0, 1 << 16, (200, neardup.SYMBOLS)).astype(np.uint16)
        b = a.copy()
        for row in b:
            at = rng.choice(neardup.INDEXED, errors, replace=False)
            row[at] += 1
        same = neardup.keys_of(a) == neardup.keys_of(b)
        assert same.any(axis=1).all()


def test_index_follows_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(150):  # 100 shingles each, the copy with up to 29 others
        own = [f"g{i}w{j}" for j in range(104)]
        changed = int(rng.integers(4, 30))
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:-changed] + [f"x{i}y{j}" for j in range(changed)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (60, 70, 80):
        assert result(neardup.near_duplicates(df, percent)) == brute(rows, percent)
        n, p, most = neardup.chunks_for(percent / 100) * neardup.CHUNK, 1 - percent / 100, neardup.indexed_differences(percent / 100)
        assert sum(comb(n, d) * p**d * (1 - p) ** (n - d) for d in range(most + 1, n + 1)) <= neardup.MISS
    assert (neardup.chunks_for(0.85), neardup.indexed_differences(0.85)) == (12, 23)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(500, 560), 500)}


def test_words_do_not_cross_rows():
    import pyarrow as pa

    texts = pa.array(["ab", "cd ef", None, "", "ab", " gh\x0bij "])
    (_, data, offsets), = words.text_blocks(texts)
    _, _, at = words.word_spans(data, offsets)
    assert np.diff(at).tolist() == [1, 2, 0, 0, 1, 2]
