from brute_text import leaks as brute
from pyspark.sql import functions as F

from heliotab.llm import decontam

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def result(df):
    return {(r.doc_id, r.item_id): (r.item_shingles, r.shared) for r in df.collect()}


def test_all_documents(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    own = [(r.item_id, r.text) for r in items.collect()]
    assert result(decontam.leaks(documents, items)) == brute(rows, own)


def test_short_item_in_a_long_text_and_edges(spark):
    item = [f"q{i}" for i in range(14)]
    filler = [f"f{i}" for i in range(40_000)]
    near = [*item[:10], "other", *item[11:]]  # 4 of 10 shingles left
    rows = [
        (1, " ".join(filler[:30_000] + item + filler[30_000:])), (2, " ".join(filler[:50] + near)), (3, "two words"),
        (4, " ".join(item[:13])), (5, None), (6, ""), (None, " ".join(item)), (7, " ".join(item).upper()),
        (8, " ".join(filler[:700])), (8, " ".join(filler[:700])),
    ]
    items = [(1, " ".join(item)), (2, "two words"), (3, None), (4, " "), (5, " ".join(filler[100:600])), (None, "two words")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("keys", F.lit(1)).withColumn("item_id", F.lit(2))
    got = result(decontam.leaks(docs, spark.createDataFrame(items, ITEMS)))
    want = brute([r for r in rows if r[0] is not None], [i for i in items if i[0] is not None])
    assert got == want and (1, 1) in got and (1, 5) in got and (4, 1) in got and (2, 1) not in got


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e")], DOCS), spark.createDataFrame([(1, "a b c d e")], ITEMS)
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    assert decontam.leaks(docs.limit(0), items).count() == 0
    assert decontam.leaks(docs, items).count() == 1


def test_items_of_few_shingles_are_all_found(spark):
    """Items of 3 to 12 words as whole texts or inside others; also with as much changed as may be."""
    docs, items = [], []
    for n in range(600):
        size = 3 + n % 10
        own = [f"i{n}w{j}" for j in range(size)]
        items.append((n, " ".join(own)))
        around = [] if size < 5 else [f"a{n}b{j}" for j in range(40)]
        docs.append((n, " ".join([*around, *own, *around])))
        if size >= 9:  # five shingles or more: one may be missing
            docs.append((1000 + n, " ".join([*around, *own[:-1]])))
    got = result(decontam.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)))
    assert got == brute(docs, items) and len(got) == 600 + 240


def test_items_of_few_shingles_at_other_shares(spark):
    items = [(n, " ".join(f"i{n}w{j}" for j in range(11))) for n in range(50)]  # 7 shingles
    docs = [(n, " ".join(t.split()[: 5 + n % 7])) for n, t in items]
    for percent in (1, 50, 100):
        got = result(decontam.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), percent))
        assert got == brute(docs, items, percent)
