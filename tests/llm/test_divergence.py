"""Source divergence against plain dictionaries and whole numbers."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from documents import SCHEMA, varied

from permitry.llm import divergence, packed_terms

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms_of(text):
    return TERM.findall((text or "").translate(FOLD))


def expected(rows, fewest=10, top=10):
    rows = [(l or "", s or "", terms_of(t)) for l, s, t in rows]
    found = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        held = Counter(t for r in own for t in set(r[2]))
        kept = {t for t, n in held.items() if n >= fewest}
        counts = {s: Counter() for s in {r[1] for r in own}}
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in kept)
        everything = sum(counts.values(), Counter())

        def share(c, term):
            return 1 + (10 ** 9 * (c[term] + 2)) // (sum(c.values()) + 2 * len(kept))

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        for a, c in counts.items():
            pairs = [(-sum(far(share(c, t), share(d, t)) for t in kept), b.encode(), b) for b, d in counts.items() if b != a]
            above = [(-far(share(c, t), share(everything, t)), t.encode(), t) for t in c if share(c, t) > share(everything, t)]
            for part, items, most in (("pair", pairs, None), ("term", above, top)):
                found += [(lang, a, part, item, -value, rank) for rank, (value, _, item) in enumerate(sorted(items)[:most], 1)]
    return sorted(found)


def documents(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, l, s, 0) for i, (l, s, t) in enumerate(rows)], SCHEMA).repartition(parts)


def mixed(seed=2, count=200):
    rng, words = random.Random(seed), ["the", "The", "Ünï", "漢字", "a", "sixteen-letters!", "abcdefgh", "abcdefghi", "abcdefghijklmnop",
                                       "abcdefghijklmnopq", "l" * 40, "m" * 40, "é" * 30, "z9z", "x_y", "ÄB", "\u0080 "]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(count)] + varied()
    return [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None, "Ä"]), t) for t in texts]


def test_like_dictionaries(spark, rows):
    found = divergence.audit(documents(spark, mixed()))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(found) == expected(mixed())


@pytest.mark.parametrize("fewest, top", [(1, 3), (10 ** 6, 10)])
def test_other_bounds(spark, rows, fewest, top):
    found = rows(divergence.audit(documents(spark, mixed(3, 40)), fewest=fewest, top=top))
    assert found == expected(mixed(3, 40), fewest, top)
    assert fewest == 1 or {r[2] for r in found} == {"pair"} and {r[4] for r in found} == {0}


def test_groups_without_terms_and_ties(spark, rows):
    made = [("en", "a", "one two one")] * 12 + [("en", "b", "two one two")] * 12 + [("en", "c", None), ("en", "d", "12 3"), ("en", "e", "")]
    made += [("fr", "only", "mot")] * 20 + [(None, None, "rare"), (None, "x", "")]
    found = rows(divergence.audit(documents(spark, made)))
    assert found == expected(made)
    assert [r for r in found if r[0] == "en" and r[1] == "c" and r[2] == "pair"] and not [r for r in found if r[0] == "fr"]
    assert {r[4] for r in found if r[0] == ""} == {0}


def test_large_counts_stay_exact(spark):
    n = 3 * 10 ** 17
    counts = spark.createDataFrame([("en", s, t, c, 10) for s, c in (("a", n), ("b", n + 1)) for t in ("x", "y")] + [("en", "a", "z", 7, 10)]
                                   + [("en", s, None, 0, 0) for s in ("a", "b")], "lang string, source string, term string, n bigint, documents bigint")
    terms, _ = divergence.shares(counts)
    for row in terms.collect():
        assert row["p"] == 1 + 10 ** 9 * (row["n"] + 2) // ((2 * n + 7 if row["source"] == "a" else 2 * n + 2) + 6)
        everything = 2 * n + 1 if row["term"] != "z" else 7
        assert row["q"] == 1 + 10 ** 9 * (everything + 2) // (4 * n + 9 + 6)


def test_repeated_rows_empty_tables_clashing_names(spark, rows):
    made = mixed(5, 30) * 3
    docs = documents(spark, made).selectExpr("*", "'x' AS term", "1 AS n", "2 AS p", "text AS `a.b`", "3 AS documents", "4 AS kept")
    assert rows(divergence.audit(docs)) == expected(made)
    renamed = docs.selectExpr("text AS `the.text`", "lang AS `the.lang`", "source AS `the.source`", "'no' AS lang", "'no' AS text")
    assert rows(divergence.audit(renamed, "the.text", "the.lang", "the.source")) == expected(made)
    assert rows(divergence.audit(documents(spark, []))) == []


def test_very_long_texts_and_terms(spark, rows):
    made = [("en", "a", "long Term " * 300_000), ("en", "b", "q" * 1_000_000 + " " + "漢" * 300_000)] + [("en", "c", "long q")] * 9
    assert rows(divergence.audit(documents(spark, made), fewest=1)) == expected(made, 1)


@pytest.mark.parametrize("seed", range(4))
def test_buckets_count_like_a_dictionary(seed):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice("abAé") for _ in range(rng.choice([1, 2, 8, 9, 16, 17, 18, 40]))) for _ in range(rng.randrange(50))) for _ in range(30)]
    groups = np.sort(np.array([rng.randrange(4) for _ in texts]))
    coded = [t.encode() for t in texts]
    found = {}
    for lengths, joined, group, counts, documents in packed_terms.counted(
            np.frombuffer(b"".join(t + b"\0" for t in coded), np.uint8), np.cumsum([len(t) + 1 for t in coded]), groups):
        ends = np.cumsum(lengths)
        for end, length, g, n, d in zip(ends, lengths, group, counts, documents):
            assert (key := (joined[end - length:end].tobytes().decode(), int(g))) not in found
            found[key] = (int(n), int(d))
    uses = Counter((t, g) for text, g in zip(texts, groups.tolist()) for t in terms_of(text))
    held = Counter((t, g) for text, g in zip(texts, groups.tolist()) for t in set(terms_of(text)))
    assert found == {key: (n, held[key]) for key, n in uses.items()}


def test_radix_order():
    values = np.random.default_rng(1).integers(0, 2 ** 63, 5000).astype(np.uint64) * np.uint64(2)
    values[::7] = values[3]
    assert packed_terms._order(values).tolist() == np.argsort(values, kind="stable").tolist()


def test_counting_holds_little_beside_the_texts():
    """A slice of texts is counted in a few times its size, and its counts leave in batches of bounded size."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.choice([2, 3, 4, 6, 7]))) for _ in range(200_000)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(["a"] * len(texts)), pa.array(texts)], ["lang", "source", "text"])
    size = sum(len(t) for t in texts)
    del texts
    tracemalloc.start()
    sizes = [counts.num_rows for counts in divergence._counted([batch])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) > 70_000 and max(sizes) <= divergence.ROWS
    assert peak < 12 * size
