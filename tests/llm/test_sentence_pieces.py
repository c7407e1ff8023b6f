"""The parallel scan against the SentencePiece library, and exact round trips."""

import functools
import math
import random
import zlib

import numpy as np
import pytest
from documents import table, varied

from permitry.llm import queries, sentence_pieces


@pytest.fixture(scope="module")
def model():
    return queries.piece_model()


def scanned(pieces, text, size):
    text = pieces.library.normalize(text)
    count = max(1, len(text) // size)
    chunks = []
    for k in range(count):
        edge, stop = k * size, len(text) if k == count - 1 else (k + 1) * size
        left = max(0, edge - pieces.longest)
        chunks.append((text[left:stop + pieces.longest], edge - left, stop - left))
    tables = [pieces.transfer(*chunk, k == 0, k == count - 1) for k, chunk in enumerate(chunks)]
    states = sentence_pieces.best_states(tables)
    return [i for chunk, edges in zip(chunks, states) for i in pieces.between(*chunk, *edges)]


def texts():
    rng = random.Random(8)
    letters = ["a", "b", "the", "ing", " ", "  ", "漢", "字", "é", "😀", "\n", "x", "tion", "er", "▁", "\r"]
    for _ in range(120):
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(1, 300)))
    yield "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéè") for _ in range(1500))
    yield " ".join(t for t in varied() if t)[:6000]
    yield "x" * 700


@pytest.mark.parametrize("size", [64, 200])
def test_scan_like_the_library(model, size):
    pieces = sentence_pieces.Pieces(model)
    for text in texts():
        assert scanned(pieces, text, size) == pieces.library.encode(text)


def tables_of(pieces, text, size):
    text = pieces.library.normalize(text)
    count = max(1, len(text) // size)
    for k in range(count):
        edge, stop = k * size, len(text) if k == count - 1 else (k + 1) * size
        left = max(0, edge - pieces.longest)
        yield pieces.transfer(text[left:stop + pieces.longest], edge - left, stop - left, k == 0, k == count - 1)


def test_products_are_associative(model):
    """Any bracketing gives one matrix, whose best weight is that of the way through all chunks."""
    pieces = sentence_pieces.Pieces(model)
    rng = random.Random(4)
    for text in list(texts())[-3:]:
        tables = list(tables_of(pieces, text, 64))
        whole = functools.reduce(sentence_pieces.product, tables)
        for _ in range(5):
            left = list(tables)
            while len(left) > 1:
                i = rng.randrange(len(left) - 1)
                left[i:i + 2] = [sentence_pieces.product(left[i], left[i + 1])]
            assert left[0][:2] == whole[:2] and np.array_equal(left[0][2], whole[2])
        states = sentence_pieces.best_states(tables)
        weight = sum(m[e.index(a), x.index(b)] for (e, x, m), (a, b) in zip(tables, states))
        assert weight == whole[2].max() > -np.inf
        middle = len(tables) // 2
        for part, edges in ((tables[:middle], states[:middle]), (tables[middle:], states[middle:])):
            assert sentence_pieces.best_states(part, edges[0][0], edges[-1][1]) == edges


def test_several_levels_of_products(spark, model, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "FAN", 3)
    library = sentence_pieces.Pieces(model).library
    own = [t for t in texts() if len(t) > 250] + ["y" * 64 * 28, "a b " * 500]
    found = {r["doc_id"]: r["ids"] for r in sentence_pieces.encode(table(spark, own, 5), model, size=64).collect()}
    assert found == {i: library.encode(t) for i, t in enumerate(own)}


def test_unigram_scan_like_the_library(model):
    from sentencepiece import sentencepiece_model_pb2
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    spec.trainer_spec.model_type = 1
    for i, piece in enumerate(spec.pieces):
        if piece.type == 1:
            piece.score = -math.log(i + 1) - 0.001 * (i % 7)
    pieces = sentence_pieces.Pieces(spec.SerializeToString())
    score = {i: p.score for i, p in enumerate(spec.pieces)}
    for text in texts():
        mine, theirs = scanned(pieces, text, 100), pieces.library.encode(text)
        # sums of equal weight may come from different pieces
        assert mine == theirs or sum(map(score.get, mine)) == pytest.approx(sum(map(score.get, theirs)), rel=1e-5)


def test_encode_and_decode(spark, model):
    library = sentence_pieces.Pieces(model).library
    own = [t for t in varied() if t is not None] + [None] + list(texts())
    encoded = sentence_pieces.encode(table(spark, own, 5), model, size=64).cache()
    found = {r["doc_id"]: r for r in encoded.collect()}
    assert len(found) == len(own)
    for i, text in enumerate(own):
        ids = library.encode(text or "")
        assert found[i]["ids"] == ids and found[i]["n_ids"] == len(ids)
        assert found[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert found[i]["restored"] == ("▁" not in (text or ""))
    for row in sentence_pieces.decode(encoded, model).collect():
        assert row["text"] == (own[row["doc_id"]] or "").replace("▁", " ")


def test_repeated_rows_missing_ids_and_empty(spark, model):
    docs = table(spark, ["a b", "a b", None, "c " * 300], ids=[1, 1, None, 1]).selectExpr("*", "lang AS ids", "1 AS doc")
    found = sentence_pieces.encode(docs, model, size=64, with_ids=False).collect()
    assert sorted(r["n_ids"] for r in found) == [0, 2, 2, 301]
    assert sentence_pieces.encode(table(spark, []), model).count() == 0
