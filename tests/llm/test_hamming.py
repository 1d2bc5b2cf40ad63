import numpy as np

from heliotab.llm import hamming

SCHEMA = "id long, code binary"


def brute(codes, queries, k):
    out = {}
    for q, code in queries:
        order = sorted((int(np.bitwise_count(np.frombuffer(c, np.uint8) ^ np.frombuffer(code, np.uint8)).sum()), i) for i, c in codes if i != q)
        out.update({(q, n + 1): (i, d) for n, (d, i) in enumerate(order[:k])})
    return out


def result(df):
    return {(r.query_id, r["rank"]): (r.id, r.distance) for r in df.collect()}


def table(spark, rows):
    return spark.createDataFrame([(i, bytearray(c)) for i, c in rows], SCHEMA)


def test_random_codes_and_a_hot_code(spark, monkeypatch):
    monkeypatch.setattr(hamming, "CELL_ROWS", 40)  # several cells, salted
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(0, 256, 8, dtype=np.uint8).tobytes()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    codes = table(spark, rows + rows[:5])
    queries = [rows[0], rows[100], rows[250], rows[450]]
    assert result(hamming.top_k(codes, table(spark, queries), 10)) == brute(rows, queries, 10)


def test_many_equal_query_codes_are_searched_once(spark, monkeypatch):
    """A third of all rows share a code, and all of them ask."""
    rng = np.random.default_rng(14)
    rows = [(i, rng.integers(0, 256, 8, dtype=np.uint8).tobytes()) for i in range(200)]
    rows += [(1000 + i, rows[7][1]) for i in range(100)]
    queries = rows[:20] + rows[200:] + [(5000, rows[3][1]), (5001, rng.integers(0, 256, 8, dtype=np.uint8).tobytes())]
    assert result(hamming.top_k(table(spark, rows), table(spark, queries), 10)) == brute(rows, queries, 10)
    assert result(hamming.top_k(table(spark, rows[:5]), table(spark, queries), 10)) == brute(rows[:5], queries, 10)


def test_two_words_few_rows_and_nothing(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(0, 256, 16, dtype=np.uint8).tobytes()) for i in range(6)]
    assert result(hamming.top_k(table(spark, rows), table(spark, rows[:2]), 10)) == brute(rows, rows[:2], 10)
    assert hamming.top_k(table(spark, []), table(spark, [])).count() == 0
    assert hamming.top_k(table(spark, rows[:1]), table(spark, rows[:1])).count() == 0
    assert hamming.top_k(table(spark, rows), table(spark, [])).count() == 0


def test_codes_of_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0, nan]), (2, [3.0, 1.0, 5.0]), (3, None), (None, [1.0]), (4, []), (5, [5.0, None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: bytes(r.code)[0] >> 5 for r in hamming.binary_codes(df).collect()}
    # Means 2.5 (without the row that has no id: 3.0), 0.5 and 3.0.
    assert got == {1: 0b000, 2: 0b011, 4: 0b000, 5: 0b100}


def test_all_vectors(spark, sf_dir):
    codes = hamming.binary_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = [(r.id, bytes(r.code)) for r in codes.collect()]
    queries = [r for r in rows if r[0] % 100 == 0]
    assert result(hamming.top_k(codes, codes.where("id % 100 = 0"))) == brute(rows, queries, 10)
