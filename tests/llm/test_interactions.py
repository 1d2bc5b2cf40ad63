import re
from collections import Counter, defaultdict
from itertools import permutations

from heliotab.llm import interactions

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(doc_id, text, least):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": doc_id is not None and least.get(text) is not None and doc_id > least[text],
    }


def brute(docs, labels):
    least = {}
    for i, t, _ in docs:
        t = t or ""
        if i is not None:
            least[t] = min(i, least.get(t, i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, lang in docs:
        parts[lang or ""].append((failures(i, t or "", least), i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        shapley, found = Counter(), []
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                shapley[f] += len(gone)
                failing = [r for r in rows if r[0][f]]
                found.append(
                    (f, part, "".join(order), step, len(left), len(gone), sum(any(r[0][g] for g in order[: step - 1]) for r in failing),
                     sum(sum(r[0].values()) == 1 for r in failing), sum(r[1] for r in gone), sum(r[2] for r in gone))
                )
        out += [(*r[1:], shapley[r[0]]) for r in found]
    return sorted(out)


def tables(spark, docs, labels):
    d = spark.createDataFrame([(*r, "s", 1) for r in docs], "doc_id long, text string, lang string, mask string, n int").repartition(5)
    return d, spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, part int")


def result(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


PROSE = " ".join(f"word{i}" for i in range(120))
DOCS = [
    (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "en"), (3, PROSE + " #", "en"), (4, "same " * 200, "en"), (5, "ABC", None), (6, None, ""),
    (7, "", "de"), (None, "", "de"), (None, PROSE, "fr"), (8, PROSE, "fr"), (9, PROSE.upper() + "|", "fr"), (0, "", "xx"), (10, "a" * 400_000, "xx"),
    (11, "x y", "de"), (12, "É" * 50, "de"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (None, 1, 1), (5, 1, None), (99, 1, 1), (9, 0, 1)]


def test_odd_rows_against_removal_one_by_one(spark):
    docs, labels = tables(spark, DOCS, LABELS)
    assert result(interactions.filter_interactions(docs, labels)) == brute(DOCS, LABELS)


def test_no_documents_and_no_labels(spark):
    docs, labels = tables(spark, DOCS, [])
    assert result(interactions.filter_interactions(docs, labels)) == brute(DOCS, [])
    assert interactions.filter_interactions(docs.where("false"), labels).count() == 0


def test_all_documents(spark, documents, labels):
    docs = [(r.doc_id, r.text, r.lang) for r in documents.collect()]
    marks = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    assert result(interactions.filter_interactions(documents, labels)) == brute(docs, marks)


def test_other_filters_by_counts(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 0, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.toxic_lost) for r in interactions.audit(counts, "XY").collect()}
    assert got == {(o, s): (5, 2 if s == 1 else 0, 0 if s == 1 else 2, 1 if s == 1 else 0) for o in ("XY", "YX") for s in (1, 2)}
