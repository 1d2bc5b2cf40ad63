import zlib
from collections import defaultdict

import numpy as np

from heliotab.llm import sharding

SCHEMA = "doc_id long, text string, shard string"


def rows_of(df):
    return df.select("doc_id", "size", "text_crc32", "shard", "slot", "law", "grown_shard").collect()


def test_differencing_of_a_known_case():
    parts = sharding.difference(np.array([8, 7, 6, 5, 4]), 2)
    sums = [sum(x for x, p in zip([8, 7, 6, 5, 4], parts, strict=True) if p == i) for i in range(2)]
    assert sorted(sums) == [14, 16]  # what the method gives here; 15 and 15 is the optimum
    assert sharding.difference(np.array([3]), 4).tolist() in ([0], [1], [2], [3])
    assert len(sharding.difference(np.array([], np.int64), 4)) == 0


def test_differencing_is_tight():
    sizes = np.random.default_rng(3).integers(20, 40_000, 5000)
    sums = np.bincount(sharding.difference(sizes, 40), sizes, 40)
    assert sums.sum() == sizes.sum() and np.ptp(sums) < 0.001 * sums.mean()


def test_documents(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    out = rows_of(sharding.shard(documents))
    assert sorted(r.doc_id for r in out) == sorted(texts)
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in out:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        by_shard[r.shard].append(r.slot)
        by_text[raw].add(r.shard)
    assert set(by_shard) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values())


def test_nulls_repeats_hot_group_and_empty(spark):
    rows = [(i, "same text", "x") for i in range(300)] + [(None, None, "y"), (7, None, "y"), (8, "", "y")] * 2
    rows += [(1000 + i, f"text {i}", None) for i in range(400)]
    out = rows_of(sharding.shard(spark.createDataFrame(rows, SCHEMA), 4))
    assert len(out) == len(rows)
    nulls = [r for r in out if r.doc_id in (None, 7) and r.size == 16]
    assert {r.text_crc32 for r in nulls} == {0} and len({r.shard for r in nulls}) == 1
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert rows_of(sharding.shard(spark.createDataFrame([], SCHEMA))) == []


def test_slots_across_cuts(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 1)
    out = rows_of(sharding.shard(documents, 3))
    for shard in range(3):
        own = sorted(r.slot for r in out if r.shard == shard)
        assert own == list(range(len(own)))
