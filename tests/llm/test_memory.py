import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heliotab.llm import langid, memory, neardup, toxicity, words


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_free_memory_goes_back_to_the_system():
    held = [np.ones(10_000) for _ in range(2_000)]  # 160 MB in blocks of the heap
    last = held.pop()
    held.clear()
    before = resident()
    memory.release()
    assert resident() < before - 100e6 and last[0] == 1


def test_models_release_memory_and_broadcasts(spark, documents, labels, monkeypatch):
    released = []
    for module in (langid, toxicity):
        monkeypatch.setattr(module, "release", lambda: released.append(1))
    destroyed = []
    kind = type(spark.sparkContext.broadcast(1))
    destroy = kind.destroy
    monkeypatch.setattr(kind, "destroy", lambda self, blocking=False: (destroyed.append(1), destroy(self, blocking)))
    langid.identify(documents.select("doc_id", "text", "lang"))
    assert released == [1]
    rated = toxicity.rate(documents.select("doc_id", "text"), labels)
    assert len(released) == 2 and len(destroyed) == 2
    assert rated.count() == documents.count()  # the model itself is still there


def test_second_components_start_from_stars(spark, monkeypatch):
    """A chain of links is contracted once: round two adds its links to the components found."""
    seen = []
    components = neardup.components

    def counted(edges, scratch):
        seen.append(edges.select("b").distinct().count())
        return components(edges, scratch)

    monkeypatch.setattr(neardup, "components", counted)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(8)]  # each like the next one
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
    assert {r.component_id for r in got.select(F.col("component_id")).collect()} == {0}
    assert seen[0] > 1 and seen[1] < seen[0]


@pytest.mark.parametrize("step", ["terms", "shingles"])
def test_texts_take_little_memory_beside_their_batch(monkeypatch, step):
    """Two workers share an executor with its JVM: a batch of 8 MB is worked on in small blocks."""
    monkeypatch.setattr(words, "_powers", None)
    rng = np.random.default_rng(15)
    texts = pa.array([" ".join(f"word{i}" for i in rng.integers(0, 50_000, 200)) for _ in range(4000)])
    assert texts.nbytes > 7_000_000
    tracemalloc.start()
    if step == "terms":
        for _ in toxicity._term_stream(texts):
            pass
    else:
        for _, data, offsets in words.text_blocks(texts):
            words.shingle_stream(data, offsets)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60_000_000
