"""Small tables and plain Python versions that the tests of this folder share."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, texts, parts=3, ids=None):
    """Documents with the given texts, spread over partitions."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts, "doc_id")


def prose(rng, count, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def varied(seed=5, count=40):
    """Texts with copies, near copies, shared passages, empty and NULL ones."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    texts = [prose(rng, rng.randrange(0, 150)) for _ in range(count)]
    texts += [texts[3], texts[3], f"{texts[4]}\n", texts[5].replace(" ", "\t", 2)]
    for i in range(6, 14):
        texts.append(f"{texts[i]} {passage} {prose(rng, 20)}")
    for i in range(14, 22):
        words = texts[i].split()
        if words:
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    base = prose(rng, 120).split()
    for _ in range(30):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    texts += [None, "", " \n\t", "one", "ONE", "two words", None, "A b C", "a B c", "x y z w   q", "Ä ä " * 30]
    return texts


def roots(size, links):
    """Smallest number reachable from each, by plain union-find."""
    parent = list(range(size))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(size)]
