"""Word-mover distances against all assignments of equal shares, and the rankings against all pairs."""

import itertools
import math

import numpy as np
import pytest
from test_vocabulary import made_up, similarity_words, types, vector_rows, vector_table

from permitry.operators import similarity
from permitry.operators.transport import mover_distance, plan


def by_assignment(cost, times_a, times_b):
    """Least cost over all ways to hand equal shares of one bag to those of the other."""
    size = math.lcm(sum(times_a), sum(times_b))
    rows = [i for i, t in enumerate(times_a) for _ in range(t * size // sum(times_a))]
    columns = [j for j, t in enumerate(times_b) for _ in range(t * size // sum(times_b))]
    return min(sum(cost[i, j] for i, j in zip(rows, order)) for order in set(itertools.permutations(columns))) / size


@pytest.mark.parametrize("times", [([1], [1, 2]), ([1, 1], [1, 2]), ([2, 1], [1, 1, 1]), ([1, 1, 1], [2, 1]), ([1, 1, 1, 1], [3, 1]), ([1, 2, 3], [3, 3])])
def test_like_every_assignment(times):
    rng = np.random.default_rng(len(times[0]))
    for round_ in range(15):
        cost = rng.integers(0, 6, (len(times[0]), len(times[1]))).astype(float) if round_ % 2 else rng.random((len(times[0]), len(times[1])))
        a, b = (np.array(t) / sum(t) for t in times)
        flow = plan(a, b, cost)
        assert flow.sum(axis=1) == pytest.approx(a) and flow.sum(axis=0) == pytest.approx(b) and flow.min() > -1e-9
        assert (flow * cost).sum() == pytest.approx(by_assignment(cost, *times))


def test_large_bags_have_a_proof_of_least_cost():
    """No cycle of the flow back and forth saves anything."""
    rng = np.random.default_rng(8)
    for size in (5, 30):
        cost = rng.random((size, size + 7))
        a, b = rng.random(size), rng.random(size + 7)
        flow = plan(a / a.sum(), b / b.sum(), cost)
        assert flow.sum(axis=1) == pytest.approx(a / a.sum()) and flow.sum(axis=0) == pytest.approx(b / b.sum())
        n = size + size + 7
        far = np.full((n, n), np.inf)
        far[:size, size:] = cost
        far[size:, :size] = np.where(flow > 1e-10, -cost, np.inf).T
        for k in range(n):
            far = np.minimum(far, far[:, k:k + 1] + far[k:k + 1, :])
        assert np.diag(far).min() > -1e-9


def test_distance_of_equal_and_single_bags():
    x, y = [0.0, 0.0], [3.0, 4.0]
    assert mover_distance([1.0], [x], [1.0], [y]) == pytest.approx(5)
    assert mover_distance([0.5, 0.5], [x, y], [0.5, 0.5], [y, x]) == pytest.approx(0)
    assert mover_distance([0.25, 0.75], [x, y], [1.0], [x]) == pytest.approx(3.75)


def exact_by_hand(left, right):
    known = {w: np.array(v, dtype=np.float32).astype(float) for w, v in vector_rows().items()}
    out, cache = [], {}
    for a, b in itertools.product(left, right):
        x, y = ([w for w in similarity_words(t) if w in known] for t in (a, b))
        if x and y:
            key = tuple(sorted(x)), tuple(sorted(y))
            if key not in cache:
                cost = np.array([[np.linalg.norm(known[u] - known[v]) for v in key[1]] for u in key[0]])
                cache[key] = by_assignment(cost, [1] * len(x), [1] * len(y))
            out.append((a, b, cache[key]))
    return out


def short(names):
    """Up to three words, as every assignment is tried."""
    return sorted({" ".join(name.split()[:3]) for name in names})


@pytest.mark.parametrize("n", [1, 40, 100_000])
def test_top_equals_brute_force(spark, n):
    left, right = short(made_up(7, 14, "hot")) + ["Gym"], short(made_up(8, 10, "hot")) + ["Unheard"]
    left, right = sorted({*left, *(f"Hot{'-' * i}Spa" for i in range(1, 8))}), sorted({*right, "Spa.Hot", "Spa Hot", "Spa Spa"})
    scored = [(a, b, round(d, 9)) for a, b, d in exact_by_hand(left, right)]
    done = {t[:2] for t in scored}
    unscored = sorted((a, b, None) for a, b in itertools.product(left, right) if (a, b) not in done)
    expected = (sorted(scored, key=lambda t: (t[2], t[0], t[1])) + unscored)[:n]
    report = {}
    found = similarity.mover_top(types(spark, *left), types(spark, *right), vector_table(spark), n, stop_words=[], report=report)
    got = [tuple(r) for r in found.collect()]
    assert [t[:2] for t in got] == [t[:2] for t in expected]
    assert [t[2] for t in got] == pytest.approx([t[2] for t in expected])
    assert 0 < report["solved"] <= report["bounded"]
    if n == 1:
        assert report["solved"] < report["bounded"] or report["bounded"] < 10


@pytest.mark.parametrize("within", [0.0, 1.2])
def test_pairs_equal_brute_force(spark, rows, within):
    left, right = short(made_up(5, 14, "hot")), short(made_up(6, 10, "hot"))
    found = rows(similarity.mover_pairs(types(spark, *left), types(spark, *right), vector_table(spark), within, stop_words=[]))
    expected = sorted(t for t in exact_by_hand(left, right) if t[2] <= within + 1e-9)
    assert [t[:2] for t in found] == [t[:2] for t in expected] and len(found) >= (within > 0)
    assert [t[2] for t in found] == pytest.approx([t[2] for t in expected], abs=1e-9)


def test_without_vectors(spark):
    none = vector_table(spark).limit(0)
    assert similarity.mover_pairs(types(spark, "Spa"), types(spark, "Spa"), none, 1.0).count() == 0
    assert similarity.mover_top(types(spark, "Spa"), types(spark, "Law"), none, 3).collect()[0]["distance"] is None
