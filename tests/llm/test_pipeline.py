import corpus_pipeline
from brute_text import leaks, near_duplicates
from compare import connect, differences
from pyspark.sql import functions as F

from heliotab.llm import langid, pieces, toxicity
from heliotab.llm.oracles import ORACLES
from heliotab.llm.queries import QUERIES


def test_stages_against_their_operators_and_brute_force(spark, sf_dir, documents, labels):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "toxicity", "near_dedup", "decontaminate", "encode"]
    kept, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in kept.collect()}
        after = stage(spark, kept, sf_dir)
        if name != "encode":
            assert after.columns == columns
        ids = {r.doc_id for r in after.collect()}
        texts = [(i, r.text) for i, r in before.items()]
        if name == "language":
            want = {r.doc_id for r in langid.identify(kept).where("not rejected").collect()}
        elif name == "toxicity":
            want = {r.doc_id for r in toxicity.rate(kept, labels).where("predicted = 0").collect()}
        elif name == "near_dedup":
            want = {i for i, (_, _, stays) in near_duplicates(texts, corpus_pipeline.NEAR_PERCENT).items() if stays}
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            want = set(before) - {d for d, _ in leaks(texts, items)}
        else:
            want = set(before)
            back = pieces.decode(after).join(kept.select("doc_id", "text"), "doc_id")
            assert back.where("not decoded <=> text").count() == 0
        assert ids == want
        kept = after


def test_near_copies_go_from_a_similarity_of_80(spark, documents, sf_dir):
    texts = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    base = [f"w{i}" for i in range(104)]
    for n, changed in enumerate((8, 9, 10, 11, 12)):  # similarities of 0.860, 0.844, 0.828, 0.813 and 0.798
        own = [f"g{n}{w}" for w in base]
        texts += [(10**6 + 2 * n, " ".join(own)), (10**6 + 2 * n + 1, " ".join(own[:-changed] + [f"x{i}" for i in range(changed)]))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], documents.schema)
    want = {i for i, (_, _, stays) in near_duplicates(texts, 80).items() if stays}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()} == want
    assert want != {i for i, (_, _, stays) in near_duplicates(texts, 85).items() if stays}


def test_run_keeps_clashing_columns_and_odd_rows(spark, documents, tmp_path, sf_dir):
    import os

    odd = spark.createDataFrame(
        [(None, "the of and to in is with that was for", "en", "s", 3), (10**6, None, "en", "s", 0), (10**6 + 1, "", None, None, None),
         (10**6 + 2, "the of and to in is with that was for", "en", "s", 3), (10**6 + 2, "the of and to in is with that was for", "en", "s", 3)],
        documents.schema,
    )
    docs = documents.unionByName(odd).withColumns({"score": F.lit("mine"), "row": F.lit(1), "predicted": F.lit(1)})
    for name in ("labels", "benchmark"):
        os.symlink(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r.score for r in docs.select("score").distinct().collect()} == {"mine"}
    ids = [r.doc_id for r in docs.where("doc_id is null or doc_id >= 1000000").collect()]
    assert ids == [10**6 + 2]  # the row without an id is a copy of it
    assert corpus_pipeline.STAGES[4][1](spark, docs.limit(0), sf_dir).count() == 0


def test_rows_that_share_an_id_or_have_none(spark, documents, sf_dir, tmp_path):
    u, v, w, x = (" ".join(f"{c}{i}" for i in range(40)) for c in "uvwx")
    rows = [(3, u), (5, u), (5, v), (5, w), (None, w + " end"), (None, x), (None, x), (6, x + " end"), (7, v), (8, None), (8, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], documents.schema)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()]
    one = [g for g in got if (g[1] or "").startswith("w0 ")]  # of two that no id names
    assert len(one) == 1 and one[0] in rows
    assert sorted({*got} - {*one}, key=str) == sorted([(3, u), (6, x + " end"), (7, v), (8, None), (None, None)], key=str) and len(got) == 6
    plain = docs.where("doc_id in (3, 6, 7)").unionByName(docs.where("doc_id = 3"))
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, plain, sf_dir).collect()) == [3, 6, 7]
    items = spark.createDataFrame([(1, x), (2, u)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [(r.doc_id, r.text) for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()]
    assert sorted(left, key=str) == sorted([(5, v), (5, w), (None, w + " end"), (7, v), (8, None), (8, None), (None, None)], key=str)


def test_empty_table(spark, documents, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), sf_dir).count() == 0


def test_queries_with_sql(spark, sf_dir):
    connection = connect(sf_dir)
    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, sf_dir), connection, sql) == [], name
