import pytest
import sentencepiece
from brute_text import viterbi
from hypothesis import given, settings
from hypothesis import strategies as st

from heliotab.llm import pieces

ODD = ["", "a", " a", "a  b", "  ", "x▁y ▁", "日本語テスト\U0001F600 ok", "\n\t\r", "a" * 3000, "日本" * 700, " " * 60, "é" * 90 + " b", "\U0001F600" * 60, "\x00"]


@pytest.fixture(scope="module")
def model():
    return pieces.pieces_of(pieces.MODEL)


def stream(model, text, step=7):
    data = text.encode()
    return list(pieces.encode_stream(model, [data[i : i + step] for i in range(0, len(data), step)]))


def test_columns_and_stream_against_a_whole_search(spark, model, documents):
    texts = ODD + [r.text[:1500] for r in documents.limit(12).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in pieces.encode(df).collect()}
    for i, text in enumerate(texts):
        want = viterbi(model, text)
        assert got[i] == want and stream(model, text) == want


def test_exact_round_trip_of_all_documents(spark, documents):
    read = pieces.decode(pieces.encode(documents))
    assert read.where("not decoded <=> text").count() == 0
    assert set(documents.columns) < set(read.columns)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80), st.integers(1, 9))
def test_any_text(text, step):
    import numpy as np
    import pyarrow as pa

    from heliotab.llm.words import text_blocks

    try:
        text.encode()
    except UnicodeEncodeError:
        return
    model = pieces.pieces_of(pieces.MODEL)
    want = viterbi(model, text)
    assert stream(model, text, step) == want
    ((_, data, offsets),) = text_blocks(pa.array([text, "b " + text]))
    ids, at = pieces.encode_block(model, data, offsets)
    assert ids[: at[1]].tolist() == want
    back, ends = pieces.decode_block(model, ids, at)
    assert back.tobytes() == data.tobytes() and np.array_equal(ends, offsets)


def test_the_library_as_a_unigram_model_agrees(model):
    """The same file with its model type set to unigram segments clean words in the same way."""
    raw = open(pieces.MODEL, "rb").read()
    at = raw.rindex(b"\x18\x02")  # trainer_spec.model_type: BPE
    try:
        other = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2 :])
    except Exception:
        pytest.skip("the file can't be read as a unigram model")
    if other.encode("hello world there") == sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL).encode("hello world there"):
        pytest.skip("the model type did not change")
    for text in ("hello world there", "the quick brown fox", "Ungeheuer verstehen", "connaissance"):
        ours, theirs = stream(model, text), other.encode(text)
        assert sum(int(model.score[i]) for i in ours) >= sum(int(model.score[i]) for i in theirs)


def test_commits_before_the_end(model):
    one = pieces.Stream(model)
    early = one.feed(b" " + b"word and " * 200)
    assert len(early) > 300 and len(one.bytes) < 12 * model.longest


def test_nulls_and_clashes(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "y")], "doc_id long, text string, ids string")
    got = sorted(map(tuple, pieces.decode(pieces.encode(df)).select("doc_id", "ids", "decoded").collect()))
    assert got == [(1, None, None), (1, None, None), (2, [], "")]
    assert pieces.decode(pieces.encode(df.limit(0))).count() == 0
