"""Vocabularies, label maps and similar types."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from permitry.operators import similarity, vocabulary
from permitry.plans import harmonise
from permitry.schemas import LICENCE

WORDS = ["spa", "bar", "law", "paint", "retail", "food", "shoe", "car", "wash", "gym"]


def types(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "BusinessType string")


def made_up(seed, count, hot):
    """Types of one to four words; a third of them share one frequent word."""
    chance = random.Random(seed)
    names = set()
    while len(names) < count:
        words = chance.choices(WORDS, k=chance.randint(1, 4))
        if len(names) % 3 == 0:
            words.append(hot)
        names.add(" ".join(words).title())
    return sorted(names)


def bag(name):
    return [w for w in name.lower().split()]


def test_business_types(spark, rows):
    data = spark.createDataFrame([("Spa",), ("Spa",), ("Bar",), (None,)], "kind string")
    assert rows(vocabulary.business_types(data, "kind")) == [(None,), ("Bar",), ("Spa",)]


def test_unions(spark, rows):
    a, b = types(spark, "Spa", "Bar"), types(spark, "Bar")
    assert rows(vocabulary.append_types(a, b)) == [("Bar",), ("Bar",), ("Spa",)]
    assert rows(vocabulary.union_types(a, b)) == [("Bar",), ("Spa",)]


def test_token_table(spark):
    found = vocabulary.token_table(types(spark, "Law Office"), stop_words=["office"]).first()
    assert found.text == ["law"] and found.business == "Law Office"


def test_word_counts(spark):
    found = vocabulary.by_count(vocabulary.word_counts(types(spark, "Car Car Wash", "The Car", None, "Bar"))).collect()
    assert [tuple(r) for r in found] == [("car", 3), ("bar", 1), ("wash", 1)]


def labels(spark):
    return spark.createDataFrame(
        [("Cab", "Taxi", "Yes", 1), ("Limo", "Taxi", "Yes", 2), ("Bus", "Coach", "No", 3), ("Van", "Coach", "", 4),
         ("Spa", "Day Spa", "yes", 5), ("Gym", "Club", "Yes", 6)],
        ["BusinessType1", "BusinessType2", "IsMatch(Yes/No)", "ordinal"])


def test_first_and_last_wins(spark, rows):
    data = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", None, 1), ("b", "z", 2)], "k string, v string, ordinal int")
    assert rows(vocabulary.first_wins(data, "k", "v")) == [("a", "x"), ("b", None)]
    assert rows(vocabulary.last_wins(data, "k", "v")) == [("a", "y"), ("b", "z")]


def test_entity_map_takes_exact_yes_first(spark, rows):
    assert rows(vocabulary.entity_map(labels(spark))) == [("Club", "Gym"), ("Taxi", "Cab")]


def test_replace_types(spark, rows):
    mapping = spark.createDataFrame([("Taxi", "Cars"), ("Spa", ""), ("Odd", None)], "key string, value string")
    data = spark.createDataFrame([(1, "Taxi"), (2, "Spa"), (3, "Gym"), (4, None), (5, "Taxi"), (6, "Odd")], "id int, BusinessType string")
    assert rows(vocabulary.replace_types(data, mapping)) == [
        (1, "Cars"), (2, ""), (3, "Gym"), (4, None), (5, "Cars"), (6, None)]
    assert rows(vocabulary.unmapped_rows(data, mapping)) == [(3, "Gym"), (4, None)]


def test_type_to_cluster(spark, rows):
    entities = vocabulary.entity_map(labels(spark))
    clusters = vocabulary.cluster_map(spark.createDataFrame(
        [("Cab", "Transport", 1), ("Cab", "Other", 2), ("Gym", "Sport", 3)], "type string, cluster_name string, ordinal int"))
    found = vocabulary.type_to_cluster(types(spark, "Taxi", "Cab", "Club", "Bar", "Bar"), entities, clusters)
    assert rows(found) == [("Bar", ""), ("Bar", ""), ("Cab", "Transport"), ("Club", "Sport"), ("Taxi", "Transport")]


def test_merged_vocabulary_replaces_in_both(spark, rows):
    entities = vocabulary.entity_map(labels(spark))
    found = vocabulary.merged_vocabulary(types(spark, "Taxi", "Bar"), types(spark, "Cab", "Club"), entities)
    assert rows(found) == [("Bar",), ("Cab",), ("Gym",)]


def jaccard_by_hand(left, right, at_least):
    out = []
    for a, b in itertools.product(left, right):
        x, y = set(bag(a)), set(bag(b))
        score = len(x & y) / len(x | y)
        if score > 0 and score >= at_least:
            out.append((a, b, score))
    return sorted(out)


@pytest.mark.parametrize("at_least,cell", [(0.01, 4), (0.01, 2000), (0.25, 4), (0.5, 2000), (1.0, 4)])
def test_jaccard_pairs_equal_brute_force(spark, rows, at_least, cell):
    left, right = made_up(1, 60, "hot"), made_up(2, 50, "hot")
    found = similarity.jaccard_pairs(types(spark, *left, None, ""), types(spark, *right, left[0], left[0]),
                                     at_least, stop_words=[], cell=cell)
    assert rows(found) == jaccard_by_hand(left, sorted({*right, left[0]}), at_least)


def test_jaccard_pairs_need_a_threshold(spark):
    with pytest.raises(ValueError):
        similarity.jaccard_pairs(types(spark, "Spa"), types(spark, "Spa"), 0)


@pytest.mark.parametrize("at_least", [0.2, 0.45])
def test_jaccard_pairs_of_long_texts(spark, rows, at_least):
    chance = random.Random(9)
    words = [f"w{i}" for i in range(70)]

    def texts(count):
        return sorted({" ".join(chance.sample(words, chance.randint(1, 60))) for _ in range(count)})

    left, right = texts(60), texts(50)
    found = similarity.jaccard_pairs(types(spark, *left), types(spark, *right), at_least, stop_words=[])
    assert rows(found) == jaccard_by_hand(left, right, at_least)


@pytest.mark.parametrize("n", [1, 17, 300, 100_000])
def test_jaccard_top_equals_brute_force(spark, n):
    left, right = made_up(3, 50, "hot"), made_up(4, 40, "hot")
    # one bag under many names
    left += [f"Hot{'-' * i}Spa" for i in range(1, 30)]
    right += [f"Spa{'.' * i}Hot" for i in range(1, 20)]
    clean = {name: " ".join(similarity_words(name)) for name in left + right}
    everything = [(a, b, s) for a, b, s in jaccard_named(left, right, clean)]
    expected = sorted(everything, key=lambda t: (-t[2], t[0], t[1]))[:n]
    found = similarity.jaccard_top(types(spark, *left), types(spark, *right), n, stop_words=[], cell=50)
    assert [tuple(r) for r in found.collect()] == expected


def similarity_words(name):
    return "".join(c if c.isalnum() else " " for c in name.lower()).split()


def jaccard_named(left, right, clean):
    for a, b in itertools.product(left, right):
        x, y = set(clean[a].split()), set(clean[b].split())
        if x & y:
            yield a, b, len(x & y) / len(x | y)


def vector_rows():
    chance = np.random.default_rng(5)
    return {w: chance.normal(size=6).round(3).tolist() for w in [*WORDS[:-1], "hot"]}


def vector_table(spark):
    return spark.createDataFrame(list(vector_rows().items()), "word string, vec array<float>")


def relaxed_by_hand(left, right):
    known = {w: np.array(v, dtype=np.float32).astype(float) for w, v in vector_rows().items()}
    out = []
    for a, b in itertools.product(left, right):
        x, y = ([w for w in similarity_words(t) if w in known] for t in (a, b))
        if not x or not y:
            continue
        cost = np.array([[np.linalg.norm(known[u] - known[v]) for v in y] for u in x])
        out.append((a, b, max(cost.min(axis=1).mean(), cost.min(axis=0).mean())))
    return out


@pytest.mark.parametrize("within,cell", [(0.0, 2000), (0.8, 6), (1.6, 2000), (50.0, 6)])
def test_relaxed_pairs_equal_brute_force(spark, rows, within, cell):
    left, right = made_up(5, 30, "hot"), made_up(6, 25, "hot")
    found = rows(similarity.relaxed_pairs(
        types(spark, *left, "Gym", ""), types(spark, *right), vector_table(spark), within, stop_words=[], cell=cell))
    expected = sorted(t for t in relaxed_by_hand([*left, "Gym"], right) if t[2] <= within + 1e-12)
    assert [t[:2] for t in found] == [t[:2] for t in expected]
    assert [t[2] for t in found] == pytest.approx([t[2] for t in expected])


@pytest.mark.parametrize("n", [1, 40, 1460, 100_000])
def test_relaxed_top_equals_brute_force(spark, n):
    left, right = made_up(7, 30, "hot"), made_up(8, 25, "hot")
    left += [f"Hot{'-' * i}Spa" for i in range(1, 12)] + ["Gym", ""]
    right += [f"Spa{'.' * i}Hot" for i in range(1, 9)] + ["Unheard"]
    left, right = sorted(set(left)), sorted(set(right))
    scored = [(a, b, round(d, 9)) for a, b, d in relaxed_by_hand(left, right)]
    done = {t[:2] for t in scored}
    unscored = sorted((a, b, None) for a, b in itertools.product(left, right) if (a, b) not in done)
    expected = (sorted(scored, key=lambda t: (t[2], t[0], t[1])) + unscored)[:n]
    found = similarity.relaxed_top(types(spark, *left), types(spark, *right), vector_table(spark), n, stop_words=[])
    got = [tuple(r) for r in found.collect()]
    assert [t[:2] for t in got] == [t[:2] for t in expected]
    assert [t[2] for t in got] == pytest.approx([t[2] for t in expected])


def test_relaxed_without_shared_words(spark):
    """No pair alike by words: the radius grows until enough pairs lie within."""
    found = similarity.relaxed_top(types(spark, "Spa", "Bar"), types(spark, "Law", "Car"), vector_table(spark), 3, stop_words=[])
    expected = sorted(relaxed_by_hand(["Spa", "Bar"], ["Law", "Car"]), key=lambda t: t[2])[:3]
    assert [tuple(r)[:2] for r in found.collect()] == [t[:2] for t in expected]


def test_relaxed_without_vectors(spark):
    none = vector_table(spark).limit(0)
    assert similarity.relaxed_pairs(types(spark, "Spa"), types(spark, "Spa"), none, 1.0).count() == 0
    found = similarity.relaxed_top(types(spark, "Spa", "Bar"), types(spark, "Law", "Spa"), none, 3).collect()
    assert [tuple(r) for r in found] == [("Bar", "Law", None), ("Bar", "Spa", None), ("Spa", "Law", None)]


def licences(spark, origin, *kinds):
    return spark.createDataFrame([(origin, f"N{i}", "Open", "2010-01-01", None, k, "", "", "", None, None)
                                  for i, k in enumerate(kinds)], LICENCE)


def test_harmonise_steps(spark, rows):
    a, b = licences(spark, "Van", "Taxi Cab", "Spa", "Spa", "Bar"), licences(spark, "Tor", "Cab Owner", "Day Spa", "Gym")
    found = harmonise.candidates(a, b, 10)
    assert found.columns == ["BusinessType1", "BusinessType2", "IsMatch(Yes/No)"]
    assert rows(found) == [("Cab Owner", "Taxi Cab", ""), ("Day Spa", "Spa", "")]
    matched = spark.createDataFrame([("Cab Owner", "Taxi Cab", "Yes", 1), ("Day Spa", "Spa", "Yes", 2)],
                                    ["BusinessType1", "BusinessType2", "IsMatch(Yes/No)", "ordinal"])
    numbered = harmonise.clusters_to_name(a, b, matched, k=2, vector_size=4)
    assert rows(numbered, "business") == [("Bar",), ("Cab Owner",), ("Day Spa",), ("Gym",)]
    assert {r.cluster for r in numbered.collect()} <= {0, 1}
    named = spark.createDataFrame([("Cab Owner", "Transport", 1), ("Day Spa", "Health", 2)], "type string, cluster_name string, ordinal int")
    mapped = harmonise.map_types(a, b, matched, named)
    assert rows(mapped) == [("Bar", ""), ("Cab Owner", "Transport"), ("Day Spa", "Health"), ("Gym", ""),
                            ("Spa", "Health"), ("Taxi Cab", "Transport")]
    table = mapped.where("BusinessType <> 'Gym'").select(
        F.col("BusinessType").alias("type"), F.col("Cluster").alias("cluster_name"), F.lit(1).alias("ordinal"))
    final, missing = harmonise.finish(a, b, table)
    assert sorted(r.BusinessType for r in final.collect()) == ["", "Gym", "Health", "Health", "Health", "Transport", "Transport"]
    assert rows(missing, "BusinessType") == [("Gym",)]


def test_replaced_and_unmapped_in_one_join(spark, rows):
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("", 5)], "BusinessType string, n int")
    mapping = spark.createDataFrame([("a", "A"), ("b", None)], "key string, value string")
    replaced, unmapped = vocabulary.replaced_and_unmapped(facts, mapping)
    assert replaced.columns == unmapped.columns == facts.columns
    assert rows(replaced) == rows(vocabulary.replace_types(facts, mapping))
    assert rows(unmapped) == rows(vocabulary.unmapped_rows(facts, mapping)) == [(None, 4), ("", 5)]


def test_relaxed_candidates(spark):
    a, b = licences(spark, "Van", "Bar", "Spa"), licences(spark, "Tor", "Law", "Spa")
    found = harmonise.candidates(a, b, 2, vector_table(spark)).collect()
    assert tuple(found[0])[:2] == ("Spa", "Spa") and len(found) == 2
