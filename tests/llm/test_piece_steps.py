"""Steps of the piece encoder: A* runs whatever number is asked for, models stay with workers, decoding is by columns."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidewire.llm import pieces

TEXTS = ["", "a", "the the the then", "x𝄞漢 abcabc\n\n  end", "An example, with words; " * 9, "naïve café 1234"]


@pytest.fixture(scope="module")
def content():
    return pieces._model_bytes(pieces.DEFAULT_MODEL)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_a_star_reads_each_text(content, monkeypatch, n):
    model, read = pieces.PieceModel(content), []
    plain = model.n_best
    monkeypatch.setattr(model, "n_best", lambda segment, k: read.append(segment) or plain(segment, k))
    for text in TEXTS[2:]:
        model.known_n_best.clear()
        before = len(read)
        found = model.encode_all([text], n)[0]
        assert len(read) > before and 1 <= len(found) <= n
    whole = pieces.PieceModel(content).encode_all(TEXTS, 3)
    assert [e[:n] for e in whole] == model.encode_all(TEXTS, n)


def test_pipeline_asks_for_the_best_n(spark, monkeypatch):
    asked = []
    plain = corpus_pipeline.encode_pieces
    monkeypatch.setattr(corpus_pipeline, "encode_pieces", lambda docs, n=pieces.NBEST: asked.append(n) or plain(docs, n=n))
    docs = spark.createDataFrame(list(enumerate([None, *TEXTS])), "doc_id long, text string")
    got = corpus_pipeline.pieces(spark, docs, "").orderBy("doc_id").collect()
    assert asked == [pieces.NBEST]
    assert got[0]["ids"] is None and got[1]["ids"] == [] and all(len(r["ids"]) == r["n_tokens"] for r in got[1:])


def test_model_stays_with_the_worker(content):
    model = pieces._kept_model(content)
    first = model.encode_all(TEXTS, 3)
    assert pieces._kept_model(bytes(content)) is model and model.encode_all(TEXTS, 3) == first


def test_columns_decode_like_single_texts(content):
    model, rng = pieces.PieceModel(content), np.random.default_rng(3)
    rows = [None, [], [0, 1, 2], [-1, 10**9], [model.byte_ids[0xE6]], [5, model.byte_ids[0x20], 400]]
    rows += [rng.integers(0, 32_000, rng.integers(0, 40)).tolist() for _ in range(50)]
    rows += [np.frombuffer(e[0][1], "<i4").tolist() for e in model.encode_all(TEXTS, 1)]
    array = pa.array([[9], *rows], pa.list_(pa.int32())).slice(1)
    got = pieces._decoded(array, pieces._spellings(content)).to_pylist()
    assert got == [None if ids is None else model.decode(ids) for ids in rows]
    assert got[-len(TEXTS):] == TEXTS
