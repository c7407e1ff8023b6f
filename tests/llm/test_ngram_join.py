"""Components of the n-gram join against all pairs."""

import itertools
import random

import numpy as np
import pytest
from documents import prose, roots, table, varied

from permitry.llm import ngram_join
from permitry.llm.components import components


def shingle_set(text, n=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def expected(texts, percent=85):
    sets = [shingle_set(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sorted(zip(range(len(sets)), map(len, sets), roots(len(sets), links)))


def near_family(rng, count, length, edits):
    base, out = prose(rng, length).split(), []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"e{rng.randrange(50)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("part, parts", [(256, 3), (8, 5)])
def test_like_all_pairs(spark, rows, monkeypatch, part, parts):
    monkeypatch.setattr(ngram_join, "PART", part)
    rng = random.Random(part)
    texts = varied() + near_family(rng, 90, 130, 4) + near_family(rng, 40, 30, 2) + ["hot copy of a text"] * 40
    found = ngram_join.near_copies(table(spark, texts, parts))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert rows(found) == expected(texts)


def test_chain_of_links(spark, rows):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i:i + 200]) for i in range(0, 120, 10)]
    found = rows(ngram_join.near_copies(table(spark, texts)))
    assert found == expected(texts) and {r[2] for r in found} == {0}


def test_repeated_rows_and_missing_ids(spark):
    docs = table(spark, ["a b c d e", "a b c d e", "a b c d e", None, "z"], ids=[9, 9, None, 3, None])
    found = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.near_copies(docs).collect()), key=str)
    assert found == [(3, 3), (9, 9), (9, 9), (None, 9), (None, None)]
    kept = ngram_join.keep_one(docs)
    assert kept.schema.names == docs.schema.names
    assert sorted(r["text"] or "" for r in kept.collect()) == ["", "a b c d e", "z"]


def test_clashing_columns(spark):
    docs = table(spark, ["a b c d e f", "A b c d e f", "q"]).selectExpr("*", "doc_id AS row", "doc_id AS key", "lang AS component_id")
    kept = ngram_join.keep_one(docs)
    assert kept.schema.names == docs.schema.names
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_empty_table(spark):
    assert ngram_join.near_copies(table(spark, [])).count() == 0
    assert ngram_join.keep_one(table(spark, [None, ""])).count() == 2


def test_links_by_matrix():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60))).astype(np.uint64) for _ in range(60)]
    found = ngram_join.linked([(len(s), s) for s in sets], [(len(s), s) for s in sets], 50)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(set(a.tolist()) & set(b.tolist()))
            assert found[i, j] == (100 * both >= 50 * (len(a) + len(b) - both))


def test_components(spark, rows):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(200, 260)]
    links += [(300, i) for i in range(301, 400)]
    edges = spark.createDataFrame(links, "x bigint, y bigint")
    label = roots(400, links)
    nodes = sorted({n for a, b in links for n in (a, b) if a != b})
    assert rows(components(edges)) == [(n, label[n]) for n in nodes]
    assert components(edges.where("false")).count() == 0
