import pytest

from heliotab.llm import lengths


def test_limits_against_all_documents(spark, documents):
    counts = [r.n_tokens for r in lengths.with_token_count(documents.select("doc_id", "text")).collect()]
    encode = lengths.encoder(lengths.VOCABULARY, lengths.PATTERN)
    texts = [r.text for r in documents.select("text").collect()]
    assert sorted(counts) == sorted(len(encode.encode_ordinary(t)) for t in texts)
    histogram = lengths.length_histogram(documents)
    limits = {r.context_limit: r for r in lengths.context_limits(histogram).collect()}
    assert set(limits) == set(counts)
    for limit, r in limits.items():
        assert r.docs == counts.count(limit) and r.docs_longer == sum(c > limit for c in counts)
        assert r.tokens_longer == sum(c for c in counts if c > limit)
        assert r.truncated_total == sum(min(c, limit) for c in counts)
        assert (r.total_docs, r.total_tokens) == (len(counts), sum(counts))
        assert r.share_within == pytest.approx(sum(c <= limit for c in counts) / len(counts))
    totals = {r.context_limit: r for r in lengths.truncated_totals(histogram, [0, 100, 10**6]).collect()}
    assert totals[100].truncated_total == sum(min(c, 100) for c in counts)
    assert totals[0].truncated_total == 0 and totals[10**6].docs_cut == 0
    half = lengths.length_quantiles(lengths.context_limits(histogram), [0.5]).first().n_tokens
    assert half == sorted(counts)[(len(counts) + 1) // 2 - 1]


def test_null_empty_long_and_clashing(spark):
    rows = [(1, None, 5), (1, "", 5), (2, "a" * 100_000, 5), (2, "<|endoftext|>", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = [r.n_tokens for r in lengths.with_token_count(df).orderBy("doc_id", "n_tokens").collect()]
    assert got[:2] == [0, 0] and got[2] > 3 and len(got) == 4
    assert lengths.context_limits(lengths.length_histogram(df.limit(0))).count() == 0
