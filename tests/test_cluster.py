"""K-means from fixed centres against a plain loop."""

import hashlib
import math
import random

from permitry.operators.cluster import cluster_types, cluster_vectors, first_centres, moved_centres, nearest_centre


def plain(points, k, rounds):
    firsts = {}
    for name in sorted(points):
        firsts.setdefault(points[name], name)
    order = sorted(firsts.items(), key=lambda f: hashlib.md5(f[1].encode()).hexdigest())
    centres = [v for v, _ in order[:k]]

    def nearest(v):
        return min(range(len(centres)), key=lambda c: (math.dist(v, centres[c]), c))

    for _ in range(rounds):
        members = [[v for v in points.values() if nearest(v) == c] for c in range(len(centres))]
        centres = [tuple(sum(x) / len(own) for x in zip(*own)) if own else old for own, old in zip(members, centres)]
    return {name: nearest(v) for name, v in points.items()}


def test_as_a_plain_loop(spark):
    rng = random.Random(4)
    points = {}
    for i in range(120):
        middle = (i % 5) * 3.0
        points[f"t{i}"] = tuple(middle + rng.random() for _ in range(3))
    points["same"] = points["t7"]
    table = spark.createDataFrame([(n, list(v)) for n, v in points.items()], "business string, vec array<double>").repartition(5)
    for rounds in (0, 1, 20):
        found = {r.business: r.cluster for r in cluster_vectors(table, 5, rounds).collect()}
        assert found == plain(points, 5, rounds)


def test_centres_without_rows_and_vectors_without_values(spark):
    rows = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [2.0, 0.0]), ("none", None)], "business string, vec array<float>")
    far = spark.createDataFrame([(0, [1.0, 0.0]), (1, [90.0, 90.0])], "cluster int, centre array<double>")
    moved = moved_centres(nearest_centre(rows.where("vec IS NOT NULL"), far), far)
    assert sorted(map(tuple, moved.collect())) == [(0, [1.0, 0.0]), (1, [90.0, 90.0])]
    assert {r.business: r.cluster for r in cluster_vectors(rows, 1).collect()} == {"a": 0, "b": 0, "none": None}
    assert first_centres(rows, 9).count() == 2
    assert cluster_vectors(rows.limit(0), 3).count() == 0


def test_types_by_given_vectors(spark):
    types = spark.createDataFrame([("Day Spa",), ("Spa",), ("Wine Bar",), ("Bar",), ("Unknown",), (None,)], "BusinessType string")
    vectors = spark.createDataFrame([("day", [0.0, 1.0]), ("spa", [0.0, 2.0]), ("wine", [9.0, 0.0]), ("bar", [8.0, 0.0])],
                                    "word string, vec array<float>")
    found = {r.business: r.cluster for r in cluster_types(types, 2, vectors=vectors).collect()}
    assert len(found) == 4 and found["Day Spa"] == found["Spa"] != found["Bar"] == found["Wine Bar"]
