import math
import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from heliotab.llm import langid, toxicity


def test_languages_of_held_out_documents(documents):
    named = langid.identify(documents).withColumn("held", langid.held_out())
    row = named.where("held").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.min("score").alias("least"), F.max("score").alias("most"), F.sum(F.col("rejected").cast("int")).alias("rejected"),
    ).first()
    assert row.n > 30 and row.right >= 0.95 * row.n and 0 <= row.least <= row.most <= 1 and row.rejected <= 0.02 * row.n


def test_labels_of_held_out_rows_are_never_read(documents):
    lied = documents.withColumn("lang", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(lied).collect()}
    assert one == two


def test_texts_of_held_out_rows_are_never_read(documents):
    """Other texts in held-out rows, and in rows without a language, change no other row's outcome."""
    hidden = langid.held_out() | F.col("lang").isNull()
    other = documents.withColumn("text", F.when(hidden, F.lit("quite another text, zz yy xx")).otherwise(F.col("text")))
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in langid.identify(d).where(~hidden).collect()} for d in (documents, other))
    assert one == two and len(one) > 100


def grams(text):
    """Hashed 2-grams and 3-grams of a text, in plain Python."""
    data = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode())
    out = Counter()
    for i in range(len(data) - 1):
        if data[i : i + 2] != b"  ":
            out[((data[i] << 8 | data[i + 1]) * 0x9E3779B1 & 0xFFFFFFFF) >> 20] += 1
            if i + 2 < len(data) and data[i + 1 : i + 3] != b"  ":
                out[((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 0x85EBCA77 & 0xFFFFFFFF) >> 20] += 1
    return out


def test_all_documents_against_every_centroid(spark, documents):
    model = langid.fit(documents)
    rows = documents.collect()
    learn = {r.doc_id for r in langid.learnable(documents).collect()}
    seen = Counter(f for r in rows if r.doc_id in learn for f in grams(r.text))
    assert learn and all(abs(model["idf"][f] - math.log((1 + len(learn)) / (1 + sum(f in grams(r.text) for r in rows if r.doc_id in learn))) - 0.1) < 1e-5 for f in list(seen)[:20])
    got = {r.doc_id: r for r in langid.predict(documents, model).collect()}
    for r in rows:
        own = {f: math.log1p(n) * float(model["idf"][f]) for f, n in grams(r.text).items()}
        length = math.sqrt(sum(x * x for x in own.values())) or 1.0
        best = {}
        for centre, of in zip(model["centroids"], model["of"], strict=True):
            cosine = sum(x / length * float(centre[f]) for f, x in own.items())
            best[model["languages"][of]] = max(cosine, best.get(model["languages"][of], -1.0))
        top = max(best.values())
        if got[r.doc_id].lang_pred == "und":
            assert not any(c.isalpha() for c in r.text)
            continue
        assert best[got[r.doc_id].lang_pred] >= top - 1e-5
        assert abs(got[r.doc_id].score - 1 / sum(math.exp((x - top) / langid.SCALE) for x in best.values())) < 1e-3


def test_very_many_languages_are_all_learned(spark):
    rows = [(2 * i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 6, f"l{i}") for i in range(260)]
    rows += [(i + 1000, t, lang) for i, t, lang in rows] + [(i + 2000, t, lang) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {r.lang for r in langid.learnable(docs).select("lang").distinct().collect()}
    assert set(langid.fit(docs, max_rows=100)["languages"]) == learned and len(learned) > 230


def test_language_edges(spark, documents):
    model = langid.fit(documents)
    rows = [(None, None), (1, ""), (1, ""), (2, "123 !? 456"), (3, "A"), (4, "漢字かな交じり文"), (5, "the and of " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("lang", F.lit(None))
    got = langid.predict(df, model).collect()
    assert len(got) == 7
    assert {r.lang_pred for r in got if r.text in (None, "", "123 !? 456")} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)
    known = next(r for r in got if r.doc_id == 5)
    assert known.lang_pred == "en" and not known.rejected
    empty = documents.limit(0)
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.predict(df, langid.fit(empty)).collect()} == {"und"}


def test_toxicity_of_held_out_documents(documents, labels):
    rated = toxicity.rate(documents, labels).withColumn("held", langid.held_out()).join(labels, "doc_id")
    rows = rated.select("held", "toxic", "predicted", "score").collect()
    right = np.mean([r.toxic == r.predicted for r in rows])
    assert right >= 0.85 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_learns_words_and_names_its_evidence(spark):
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        own = "".join(chr(97 + int(c)) for c in str(i)) + "longword"  # else all are copies of two texts
        rows.append((i, f"plain {own} words " + ("you awful fool" if bad else "you kind friend") + " end"))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.rate(docs, labels).collect()}
    assert all(got[i].predicted == t for i, t in marks)
    assert all(e % 4 == 0 for e in got[0].evidence) and len(got[0].evidence) == 3
    more = [(None, None), (1, ""), (1, ""), (2, "AWFUL fool"), (3, "fool " * 50_000), (4, "nothing known here")]
    odd = spark.createDataFrame(more, "doc_id long, text string").withColumn("score", F.lit("x"))
    read = toxicity.score(odd, toxicity.fit(docs, labels)).collect()
    assert len(read) == 6 and {r.predicted for r in read if r.doc_id in (2, 3)} == {1}
    assert {r.predicted for r in read if r.doc_id not in (2, 3)} == {0}
    nobody = toxicity.rate(docs, labels.limit(0)).agg(F.max("score")).first()[0]
    assert nobody == 0 and toxicity.rate(docs.limit(0), labels).count() == 0


def test_scores_against_all_examples_in_plain_python(documents, labels):
    """Cosines, votes and calibration of every document, one pair at a time."""
    model = toxicity.fit(documents, labels, per_class=60)
    examples, idf, k = model["index"].examples, model["idf"], model["k"]
    tells = model["index"].evidence
    table = []
    for i in range(len(model["ids"])):
        own = slice(examples.start[i], examples.start[i + 1])
        table.append(dict(zip(examples.term[own].tolist(), examples.value[own].tolist(), strict=True)))
    rows = documents.select("doc_id", "text").collect()
    (_, counts), *more = model["vocabulary"].of(pa.array([r.text for r in rows]))
    assert not more
    got = {r.doc_id: r for r in toxicity.score(documents.select("doc_id", "text"), model).collect()}
    for n, row in enumerate(rows):
        own = slice(counts.start[n], counts.start[n + 1])
        vector = {t: (1 + math.log(c)) * idf[t] for t, c in zip(counts.term[own].tolist(), counts.value[own].tolist(), strict=True)}
        length = math.sqrt(sum(x * x for x in vector.values())) or 1.0
        vector = {t: x / length for t, x in vector.items()}
        cosine = [round(sum(x * e[t] for t, x in vector.items() if t in e), 9) for e in table]
        near = [i for i in sorted(range(len(table)), key=lambda i: (-cosine[i], i)) if cosine[i] > 0][:k]
        assert got[row.doc_id].evidence == model["ids"][near[:3]].tolist()
        weight = [
            sum(x * table[i][t] * (tells[t] + 1e-3) for t, x in vector.items() if t in table[i])
            / (1.05 - min(cosine[i], 1)) * model["stands_for"][i]
            for i in near
        ]
        want = model["base"]
        if near:
            vote = sum(w for w, i in zip(weight, near, strict=True) if model["toxic"][i]) / sum(weight)
            want = min(max(float(np.interp(vote, *model["line"])), 0.0), 1.0)
        assert abs(got[row.doc_id].score - want) < 1e-6
        if abs(want - 0.3) > 1e-6:
            assert got[row.doc_id].predicted == int(want >= 0.3)


def test_only_true_copies_are_one_example(spark):
    rows = [(i, f"commonword it {'bad' if i % 3 == 0 else 'fine'} w{chr(97 + i % 26)}{chr(97 + i // 26)} so") for i in range(60)]
    rows += [(100 + i, "Commonword COPIED text, so it is") for i in range(5)] + [(105, "commonword copied copied text so it is")]
    labels = [(i, int(i % 3 == 0)) for i in range(60)] + [(100 + i, 0) for i in range(6)]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    learnable = {r.doc_id for r in marks.where(~langid.held_out()).collect()}
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), marks)
    copies = sorted(learnable & set(range(100, 105)))
    assert len(copies) > 1 and set(model["ids"].tolist()) == learnable - set(copies[1:])
    weight = dict(zip(model["ids"].tolist(), model["stands_for"], strict=True))
    assert {round(w) for i, w in weight.items() if i != copies[0]} == {1} and round(weight[copies[0]]) == len(copies)


def test_a_toxic_word_of_five_labelled_documents_counts(spark):
    rng = np.random.default_rng(9)
    words = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 7)) for _ in range(340)]
    common, rare = words[:300], words[300:]
    ids = spark.range(600).selectExpr("id AS doc_id").where(~langid.held_out()).collect()
    rows, marks = [], []
    for n, (i,) in enumerate(ids):  # half are toxic; forty words of five toxic documents each are the only sign
        own = [rare[n // 10]] if n % 2 and n < 400 else []
        rows.append((i, " ".join([*rng.choice(common, 12), *own])))
        marks.append((i, n % 2))
    word = {i: rare[n // 10] for n, (i,) in enumerate(ids) if n % 2 and n < 400}
    new = [(2000 + n, f"{w} qq xx") for n, w in enumerate(rare)]
    copies = [(3000 + i, dict(rows)[i]) for i in word]
    plain = [(5000 + n, " ".join(rng.choice(common, 12))) for n in range(100)]
    docs = spark.createDataFrame(rows + new + copies + plain, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.rate(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    assert len(word) == 200 and all([word[e] for e in got[2000 + n].evidence] == [w] * 3 for n, w in enumerate(rare))
    assert all(got[3000 + i].evidence[0] == i for i in word)
    middle = np.median([got[i].score for i, _ in plain])
    assert min(got[i].score for i, _ in new) > middle and np.mean([got[i].score > middle for i, _ in copies]) > 0.95


def test_nearest_of_very_many_terms_are_exact():
    rng = np.random.default_rng(10)
    often = rng.random(3000) ** 3 * 0.4
    examples = toxicity.weights((rng.random((700, 3000)) < often).astype(int), 1 + rng.random(3000))
    queries = toxicity.weights((rng.random((150, 3000)) < often).astype(int), 1 + rng.random(3000))
    sparse = toxicity.ExampleIndex(toxicity.Rows.of(examples))
    best, who = sparse.nearest(toxicity.Rows.of(queries), 15)
    cosine = np.round(queries @ examples.T, 9)
    assert 0 < len(sparse.columns) and len(sparse.place)
    for q in range(150):
        assert who[q].tolist() == np.lexsort((np.arange(700), -cosine[q]))[:15].tolist()


def test_nearest_examples_are_exact_with_ties():
    rng = np.random.default_rng(6)
    counts = rng.poisson(0.15, (500, 20))
    counts[100:150] = counts[0]
    examples = toxicity.weights(counts, np.ones(20))
    queries = toxicity.weights(rng.poisson(0.2, (80, 20)), np.ones(20))
    best, who = toxicity.ExampleIndex(examples).nearest(queries, 7)
    cosine = np.round(queries @ examples.T, 9)
    for q in range(80):
        order = [i for i in np.lexsort((np.arange(500), -cosine[q])) if cosine[q, i] > 0][:7]
        assert who[q][who[q] >= 0].tolist() == order
        assert np.allclose(best[q][: len(order)], cosine[q, order])


def test_blocks_below_the_kth_cosine_are_skipped(monkeypatch):
    """Exact whatever the portions are, with examples left out, and with less than all blocks compared."""
    rng = np.random.default_rng(11)
    topics = np.repeat(np.eye(8), 250, axis=1)  # eight topics of 250 terms each, and some terms of all
    kinds = rng.integers(0, 8, 1500)
    counts = (rng.random((1500, 2000)) < 0.3 * topics[kinds] * (np.arange(2000) % 3 + 0.1) / 2 + 0.004).astype(int)
    counts[700:710] = counts[3]
    monkeypatch.setattr(toxicity, "FREQUENT", 0.02)
    examples = toxicity.weights(counts, 1 + rng.random(2000))
    evidence = rng.random(2000)
    cosine = np.round(examples[:200] @ examples.T, 9)
    told = (examples[:200] * (evidence + 1e-3)) @ examples.T
    np.fill_diagonal(cosine, -1)
    for entries, portion in ((1 << 21, 128), (3000, 128), (1, 7)):
        monkeypatch.setattr(toxicity, "_ENTRIES", entries)
        monkeypatch.setattr(toxicity, "_PORTION", portion)
        index = toxicity.ExampleIndex(examples, evidence)
        queries = toxicity.Rows.of(examples[:200])
        best, who, part = index.search(queries, 12, np.arange(200))
        assert 0.4 * index.bounded < index.skipped < index.bounded == 200 * len(index.columns)
        assert len(index.place) and index.columns.shape[1] > 100
        for q in range(200):
            near = np.lexsort((np.arange(1500), -cosine[q]))[:12]
            assert who[q].tolist() == near.tolist() and np.allclose(best[q], cosine[q, near])
            assert np.allclose(part[q], told[q, near])


def test_lists_are_added_up_one_query_at_a_time(monkeypatch):
    """What a query gathers from the lists stays small, however many are searched together."""
    rng = np.random.default_rng(14)
    counts = (rng.random((400, 900)) < rng.random(900) ** 4 * 0.3).astype(int)
    examples, evidence = toxicity.weights(counts, 1 + rng.random(900)), rng.random(900)
    index, asked, sums = toxicity.ExampleIndex(examples, evidence), [], toxicity._sums

    def watched(at, values, n):
        asked.append((len(at), n))
        return sums(at, values, n)

    monkeypatch.setattr(toxicity, "_sums", watched)
    best, who, part = index.search(examples, 9)
    lists = [np.diff(index.start)[np.flatnonzero((row > 0) & (index.column < 0))].sum() for row in examples]
    assert max(n for _, n in asked) <= len(index.columns) * toxicity._BLOCK
    assert max(size for size, _ in asked) <= max(lists) < sum(lists) / 100
    cosine = np.round(examples @ examples.T, 9)
    for q in range(400):
        near = np.lexsort((np.arange(400), -cosine[q]))[:9]
        assert who[q].tolist() == near.tolist() and np.allclose(best[q], cosine[q, near])
        assert np.allclose(part[q], ((examples[q] * (evidence + 1e-3)) @ examples.T)[near])


def test_an_index_is_sent_with_its_order():
    rng = np.random.default_rng(12)
    examples = toxicity.weights(rng.poisson(0.3, (90, 30)), np.ones(30))
    index = toxicity.ExampleIndex(examples)
    one = index.search(examples, 5)
    sent = pickle.loads(pickle.dumps(index))
    assert index.column is not None and sent.column is None and sorted(sent.order.tolist()) == list(range(90))
    assert all((a == b).all() for a, b in zip(one, sent.search(examples, 5), strict=True))
    for few in (0, 1, 3):
        best, who = toxicity.ExampleIndex(examples[:few]).nearest(examples[:10], 5)
        assert ((who >= 0).sum(axis=1) <= few).all() and (who < max(few, 1)).all()
        assert not few or who[0, 0] == 0 and best[0, 0] == 1


def test_votes_of_examples_by_tasks_are_those_of_one_search(spark):
    rng = np.random.default_rng(13)
    examples = toxicity.Rows.of(toxicity.weights(rng.poisson(0.2, (300, 60)), np.ones(60)))
    toxic, stands_for = (rng.random(300) < 0.3).astype(float), 1 + rng.random(300)
    index = toxicity.ExampleIndex(examples, rng.random(60))
    one = toxicity.votes(*index.search(examples, 9, np.arange(300)), toxic, stands_for)
    assert np.allclose(toxicity._own_votes(spark, index, 9, toxic, stands_for), one, equal_nan=True)


def test_isotonic_fit_rises():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert (np.diff(y) > 0).all() and np.allclose(y, [0, 0.5, 1])


def test_terms_stay_in_their_rows():
    rows = [(row, n, rows.tolist()) for row, n, rows, _ in toxicity._term_stream(pa.array(["ab", "cd", None, "longer words"]))]
    assert rows == [(0, 4, [0, 1, 3, 3, 3, 3, 3])]
