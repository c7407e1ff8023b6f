"""Quality rules against plain counting."""

import random

import numpy as np
import pytest
from documents import prose, table, varied

from permitry.llm import quality_rules


def repeats(words):
    best = [0] * len(words)
    for i in range(len(words)):
        for j in range(len(words)):
            length = 0
            while i != j and max(i, j) + length < len(words) and words[i + length] == words[j + length]:
                length += 1
            best[i] = max(best[i], length)
    return best


def expected(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    again, covered = set(), set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            again.update(range(i, i + 5))
    best = repeats(words)
    for i, length in enumerate(best):
        if length >= quality_rules.LEAST:
            covered.update(range(i, i + length))
    seen, lines = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            lines += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    kept = not failed and 100 * len(covered) <= quality_rules.COVERED_PERCENT * len(words) and max(best) <= quality_rules.LONGEST
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(again), len(covered),
            max(best, default=0), failed, kept)


@pytest.mark.parametrize("parts", [1, 5])
def test_like_plain_counting(spark, parts):
    rng = random.Random(4)
    texts = varied(count=20) + ["a b " * 40, "same line here\nsame line here\n\nother", "# $ | <x> ünïcode é\x1c z"]
    for _ in range(25):
        own = prose(rng, rng.randrange(20, 90), rng.choice([3, 20, 500]))
        texts.append(f"{own} {prose(rng, 30)} {' '.join(own.split()[:rng.randrange(4, 20)])}")
    texts.append(f"{prose(rng, 300, 9999)} {(twice := prose(rng, 70, 9999))} {prose(rng, 900, 9999)} {twice}")
    found = {r["doc_id"]: tuple(r)[1:] for r in quality_rules.judged(table(spark, texts, parts)).collect()}
    assert found == {i: expected(t) for i, t in enumerate(texts)}
    assert any(f[-1] for f in found.values()) and any(not f[-1] and not f[-2] for f in found.values())


def test_suffix_array_like_all_pairs():
    rng = random.Random(1)
    for _ in range(120):
        texts = [[rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randrange(40))] for _ in range(rng.randrange(1, 5))]
        numbers = np.array([w for t in texts for w in t], np.uint64)
        assert quality_rules.longest_repeats(numbers, np.array([len(t) for t in texts])).tolist() == [x for t in texts for x in repeats(t)]


def test_repeated_rows_missing_ids_clashing_columns_and_empty(spark):
    docs = table(spark, ["a b c", "a b c", None], ids=[2, 2, None]).selectExpr("*", "1 AS n_words", "lang AS kept")
    found = [tuple(r) for r in quality_rules.judged(docs).collect()]
    assert sorted(r[1] for r in found) == [0, 3, 3] and not any(r[-1] for r in found)
    assert quality_rules.judged(table(spark, [])).count() == 0
