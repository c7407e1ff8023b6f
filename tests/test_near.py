"""The ball cover against all pairs, and how many pairs it compares."""

import numpy as np
import pytest

from permitry.operators import near
from permitry.operators.near import near_words


def lexicon(spark, vectors, left=lambda i: True, right=lambda i: True):
    rows = [(f"w{i}", v.tolist(), int(left(i)), int(right(i))) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "word string, vec array<float>, in_left int, in_right int").repartition(3)


def clustered(rng, size, clusters=25, dims=24, spread=0.05):
    centres = rng.normal(size=(clusters, dims))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return (centres[rng.integers(clusters, size=size)] + rng.normal(size=(size, dims)) * spread).astype(np.float32)


def expected(vectors, reach, left=lambda i: True, right=lambda i: True):
    v = vectors.astype(float)
    far = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    return sorted((f"w{i}", f"w{j}") for i, j in zip(*np.nonzero(far <= reach)) if left(i) and right(j))


@pytest.mark.parametrize("reach", [0.2, 0.47, 3.1])
@pytest.mark.parametrize("block, most", [(1000, 4096), (30, 4096), (40, 3)])
def test_like_all_pairs(spark, rows, monkeypatch, reach, block, most):
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "MOST", most)
    vectors = clustered(np.random.default_rng(7), 260)
    sides = (lambda i: i % 3 != 0), (lambda i: i % 4 != 1)
    found = rows(near_words(lexicon(spark, vectors, *sides), reach))
    assert found == expected(vectors, reach, *sides)


def test_random_vectors_of_any_scale(spark, rows):
    vectors = (np.random.default_rng(1).normal(size=(200, 40)) * 100).astype(np.float32)
    found = set(rows(near_words(lexicon(spark, vectors), 740.123)))
    assert set(expected(vectors, 740.123)) <= found <= set(expected(vectors, 740.126))


def test_equal_vectors_make_many_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 20)
    vectors = np.concatenate([np.ones((90, 4)), np.eye(4) * 5]).astype(np.float32)
    assert rows(near_words(lexicon(spark, vectors), 0.5)) == expected(vectors, 0.5)


def test_empty_sides(spark):
    vectors = np.eye(5, dtype=np.float32)
    assert near_words(lexicon(spark, vectors, left=lambda i: False), 1.0).count() == 0
    assert near_words(lexicon(spark, vectors, right=lambda i: False), 1.0).count() == 0
    assert near_words(lexicon(spark, vectors).limit(0), 1.0).count() == 0


def test_few_pairs_are_compared(spark):
    """On clustered vectors under a fifth of the pairs, with all near ones found."""
    size = 3000
    words = lexicon(spark, clustered(np.random.default_rng(3), size, clusters=40))
    compared = near_words(words, 0.4, counted=True).groupBy().sum("compared").first()[0]
    assert compared < 0.2 * size * size
    assert near_words(words, 0.4).count() >= size


def test_no_copies_for_every_block(spark, rows, monkeypatch):
    """On vectors that nothing separates each word meets all others, and still no row moves behind the stored packs."""
    monkeypatch.setattr(near, "BLOCK", 20)
    vectors = np.random.default_rng(5).normal(size=(200, 64))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    vectors[150:] = vectors[:50] + 0.01
    found = near_words(lexicon(spark, vectors), 0.9)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == expected(vectors, 0.9)


def test_words_without_vector_and_repeated_words(spark, rows):
    made = [("a", [1.0, 0.0], 1, 1), ("a", [1.0, 0.0], 1, 0), ("b", None, 1, 1), (None, [1.0, 0.1], 0, 1), ("c", [0.0, 9.0], 1, 1)]
    words = spark.createDataFrame(made, "word string, vec array<float>, in_left int, in_right int")
    assert sorted(near_words(words, 0.5).collect(), key=str) == [("a", "a"), ("a", "a"), ("a", None), ("a", None), ("c", "c")]


@pytest.mark.parametrize("shift, scale, reach", [(0, 1, 0.3), (1e4, 1, 0.3), (0, 1e3, 300.0), (1e4, 1e-2, 0.02)])
def test_meeting_is_exact_whatever_the_precision(shift, scale, reach):
    rng = np.random.default_rng(11)
    a, b = ((rng.normal(size=(n, 8)) * scale * 0.2 + shift).astype(np.float32).astype(float) for n in (300, 200))
    centres = b[:9]
    far = np.sqrt(((b[:, None] - centres[None]) ** 2).sum(2))
    cells, at = far.argmin(1), far.min(1)
    order = np.lexsort((at, cells))
    near_a = np.sqrt(((a[:, None] - centres[None]) ** 2).sum(2)).min(1)
    i, j, _ = near._meet(a, near_a, b[order], cells[order], at[order], centres, reach)
    wanted = np.argwhere(((a[:, None] - b[order][None]) ** 2).sum(2) <= reach * reach)
    assert len(wanted) and sorted(zip(i.tolist(), j.tolist())) == [tuple(w) for w in wanted.tolist()]
