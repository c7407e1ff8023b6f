"""Toxicity and graded quality: held-out accuracy on the test tables, and defined cases."""

import os
import re
from collections import Counter

import numpy as np
import pytest
from documents import table

from permitry.llm import ordinal, queries, samples, toxicity
from pyspark.sql import functions as F

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def labels(spark, found):
    return spark.createDataFrame(found, "doc_id bigint, quality int, toxic int")


@tables
def test_toxicity_on_held_out_rows(spark):
    known = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = queries.op2_toxicity(spark, FOLDER).join(known, "doc_id").where("held_out").collect()
    right = [r["toxic"] == r["predicted"] for r in found]
    caught = [r["predicted"] for r in found if r["toxic"]]
    assert np.mean(right) > 0.93 and np.mean(caught) > 0.65
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


@tables
def test_quality_on_held_out_rows(spark):
    known = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = queries.op4_quality_classifier(spark, FOLDER).join(known, "doc_id").where("held_out").collect()
    assert np.mean([(r["quality"] == 1) == r["kept"] for r in found]) > 0.95
    assert all(0 <= r["expected_grade"] <= 2 and r["kept"] == (r["tail_probability"] >= 0.5) for r in found)


def test_held_out_rows_are_never_learned(spark):
    docs = table(spark, [f"text {i}" for i in range(200)])
    known = labels(spark, [(i, 1, i % 2) for i in range(200)] + [(None, 1, 1), (3, None, None)])
    rows = samples.training_rows(docs, known, F.col("toxic"), sample=60)
    learned = [r["id"] for r in rows.collect()]
    assert len(learned) == len(set(learned)) == 60
    out = {r["doc_id"] for r in docs.where(samples.held_out("doc_id")).select("doc_id").collect()}
    assert out and not out & set(learned)
    again = samples.training_rows(docs.repartition(7), known.repartition(5), F.col("toxic"), sample=60)
    assert sorted(learned) == sorted(r["id"] for r in again.collect())


def test_ftrl_finds_the_words_that_matter():
    rng = np.random.default_rng(0)
    texts, marks = [], []
    for i in range(400):
        words = [f"w{rng.integers(300)}" for _ in range(60)]
        marks.append(int(i % 5 == 0))
        if marks[-1]:
            words[rng.integers(60)] = ["Awful!", "horrid"][i % 2]
        texts.append(" ".join(words).encode())
    keys, weights = toxicity.fit(texts, np.array(marks))
    assert len(keys) < 200 and np.all(np.diff(keys) > 0)
    scores = toxicity._Scorer(keys, weights)
    import pyarrow as pa
    found = scores(pa.array(["nothing here", "so AWFUL", "a horrid day w1 w2", None, ""]))
    assert found[0] < 0.3 and found[1] > 0.3 and found[2] > 0.3 and found[3] == found[4] < 0.3


def test_one_label_only(spark):
    docs = table(spark, ["a", "b", None, ""])
    for marked in ([], [(0, 1, 0), (1, 1, 0)]):
        found = toxicity.scored(docs, labels(spark, marked)).collect()
        assert len(found) == 4 and len({r["score"] for r in found}) == 1 and found[0]["score"] <= 0.5
        graded = ordinal.graded(docs, labels(spark, marked), F.col("quality"), 1).collect()
        assert {r["expected_grade"] for r in graded} == ({1.0} if marked else {0.0})
        assert {r["kept"] for r in graded} == {bool(marked)}


def test_nulls_repeated_rows_and_empty_tables(spark):
    words = ["good text here " * 5, "bad $$$ ### text !!" * 5]
    docs = table(spark, [words[i % 2] for i in range(60)] + [None, "", "good text here"], ids=[*range(60), None, 61, 61])
    docs = docs.selectExpr("*", "lang AS score", "lang AS label", "lang AS shard")
    known = labels(spark, [(i, 1 - i % 2, i % 2) for i in range(60)])
    for found in (toxicity.scored(docs, known), ordinal.graded(docs, known, F.col("quality"), 1)):
        assert found.count() == 63
        assert [len(set(found.where("doc_id = 61").columns)), found.where("doc_id is null").count()] == [len(found.columns), 1]
    kept = toxicity.drop_toxic(docs, known)
    assert kept.schema.names == docs.schema.names
    assert not {r["doc_id"] for r in kept.collect()} & set(range(1, 60, 2))
    assert toxicity.scored(table(spark, []), known).count() == 0
    assert ordinal.graded(table(spark, []), known, F.col("quality"), 1).count() == 0


def test_thresholds_are_ordered_and_grades_follow():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(900):
        level = int(rng.integers(4))
        slots = np.array([7, 8, 100 + rng.integers(50)])
        rows.append(((slots, np.array([level + rng.normal(0, 0.3), 1.0, 0.2])), level))
    weights, thresholds = ordinal.fit(rows, 4)
    assert np.all(np.diff(thresholds) > 0)
    expected = [float((1 / (1 + np.exp(thresholds - weights[s] @ v))).sum()) for (s, v), _ in rows]
    assert np.corrcoef(expected, [level for _, level in rows])[0, 1] > 0.9


def plain_features(text):
    """Counts of words, shapes and neighbouring shapes, and the shares, of one text."""
    own = text.decode().split()
    shapes = [re.sub("[A-Z]{2,}", "AA", re.sub("[0-9]+", "0", re.sub("[a-z\u0080-\U0010ffff]+", "a", w))) for w in own]

    def repeated(width):
        runs = [tuple(own[i:i + width]) for i in range(len(own) - width + 1)]
        return 1 - len(set(runs)) / len(runs) if runs else 0

    marks = sum(text.decode().count(c) for c in "#*$%&|!")
    shares = [repeated(1), repeated(2), repeated(4), sum(a == b for a, b in zip(own, own[1:])) / max(1, len(own) - 1),
              min(1, marks / max(1, len(own))), 1 / (1 + len(own)), min(1, np.log1p(len(own)) / 12), 0]
    groups = [own, shapes, list(zip(shapes, shapes[1:]))]
    return [sorted(np.sqrt(n / len(g)) for n in Counter(g).values()) for g in groups], shares


@pytest.mark.parametrize("part", [1 << 20, 16, 1])
def test_features_like_plain_counts(monkeypatch, part):
    monkeypatch.setattr(ordinal, "PART", part)
    rng = np.random.default_rng(part)
    words = ["the", "The", "THE", "TH", "x1", "1,000", "Ünï", "漢字", "a-b", "#$%", "aB", "AAb", "!!", "don't"]
    texts = ["", " ", "one", "same " * 9, *(" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(20))]
    texts = [t.replace(" ", " \t\n", 1).encode() for t in texts]
    found, shares = ordinal.features(texts, ordinal.Hasher())
    for text, (slots, values), own in zip(texts, ordinal.rows_of(found, shares), shares):
        groups, wanted = plain_features(text)
        assert own == pytest.approx(wanted)
        assert len(slots) == len(values) == sum(map(len, groups)) + 8 and max(slots) < (1 << ordinal.BITS) + 8
        assert sorted(values[:-8]) == pytest.approx(sorted(v for g in groups for v in g))
    alone = [ordinal.features([t], ordinal.Hasher()) for t in texts]
    assert all(sorted(a[0][1]) == sorted(found[1][found[0] == i]) for i, a in enumerate(alone))


def test_slopes_like_differences():
    rng = np.random.default_rng(4)
    for levels in (2, 3, 5):
        for _ in range(20):
            s, thresholds = rng.normal(), np.sort(rng.normal(size=levels - 1)) + np.arange(levels - 1)
            level = int(rng.integers(levels))

            def loss(s, t):
                tail = [1, *(1 / (1 + np.exp(-(s - x))) for x in t), 0]
                return -np.log(tail[level] - tail[level + 1])

            by_s, by_threshold = ordinal.slopes(s, thresholds, level)
            assert by_s == pytest.approx((loss(s + 1e-6, thresholds) - loss(s - 1e-6, thresholds)) / 2e-6, abs=1e-5)
            for k in range(levels - 1):
                step = np.eye(levels - 1)[k] * 1e-6
                assert by_threshold[k] == pytest.approx((loss(s, thresholds + step) - loss(s, thresholds - step)) / 2e-6, abs=1e-5)


def test_ftrl_like_a_plain_loop():
    """The published rule, one coordinate at a time, on the same features."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{rng.integers(25)}" for _ in range(12)).encode() for _ in range(60)]
    labels = np.array([int(b"w3" in t.split() or b"w7 w1" in t) for t in texts])
    held = [{int(f) for f in toxicity.features(t, toxicity.words.Numbers())} for t in texts]
    often = Counter(f for h in held for f in h)
    z, n, weights = Counter(), Counter(), {}

    def weight(i):
        bound = 0 if i == int(toxicity.BIAS) else toxicity.L1
        if abs(z[i]) <= bound:
            return 0.0
        return -(z[i] - (bound if z[i] > 0 else -bound)) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for own, label in zip(held, labels):
            active = [i for i in own if often[i] >= toxicity.FEWEST] + [int(toxicity.BIAS)]
            weights = {i: weight(i) for i in active}
            gradient = 1 / (1 + np.exp(-sum(weights.values()))) - label
            for i in active:
                z[i] += gradient - ((n[i] + gradient ** 2) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA * weights[i]
                n[i] += gradient ** 2
    wanted = {i: w for i in z if (w := weight(i))}
    keys, found = toxicity.fit(texts, labels)
    assert set(keys.tolist()) == set(wanted) and len(wanted) > 2
    assert found == pytest.approx([wanted[int(k)] for k in keys])


def test_tail_probability_of_each_grade(spark):
    docs = table(spark, ["a b", "", None])
    model = ordinal.Model(np.zeros((1 << ordinal.BITS) + 8), np.array([-1.0, 0.5]), [0, 1, 3])
    for target, chance in ((0, 1.0), (1, 1 / (1 + np.exp(-1))), (3, 1 / (1 + np.exp(0.5))), (9, 0.0)):
        for row in ordinal.score(docs, model, target).collect():
            assert row["tail_probability"] == pytest.approx(chance)
            assert row["expected_grade"] == pytest.approx(1 / (1 + np.exp(-1)) + 2 / (1 + np.exp(0.5)))
