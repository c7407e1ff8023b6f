"""Passages found against all windows of all texts."""

import hashlib
from collections import Counter

import pytest
from documents import table, varied

from permitry.llm import substrings


def expected(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for own in words:
        gone = set()
        for i in range(len(own) - window + 1):
            if seen[tuple(own[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((len(own), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


@pytest.mark.parametrize("window", [2, 5, 8, 35])
@pytest.mark.parametrize("parts", [1, 7])
def test_like_all_windows(spark, window, parts):
    texts = varied() + ["again and again " * 30, "long " * 100]
    found = substrings.repeated_passages(table(spark, texts, parts), window=window, with_text=True).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(texts)
    for i, (count, gone, digest, kept) in enumerate(expected(texts, window)):
        row = by_id[i]
        assert (row["n_words"], row["n_removed"], row["kept_sha256"]) == (count, gone, digest)
        assert sum(b - a for a, b in row["removed_spans"]) == gone
        assert row["kept_text"] == (kept if gone else texts[i] or "")


def test_repeated_rows_lose_their_windows(spark):
    docs = table(spark, ["a b c d e f", "a b c d e f", None], ids=[4, 4, None])
    found = sorted((r["doc_id"] is None, r["n_words"], r["n_removed"])
                   for r in substrings.repeated_passages(docs, window=3).collect())
    assert found == [(False, 6, 6), (False, 6, 6), (True, 0, 0)]


def test_dropping_keeps_rows_and_columns(spark):
    docs = table(spark, ["x y z 1", "q x y z", "only here\nonce"]).selectExpr("*", "doc_id AS n_words", "lang AS id")
    found = substrings.drop_passages(docs, window=3)
    assert found.schema.names == docs.schema.names
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {0: "1", 1: "q", 2: "only here\nonce"}


def test_empty_table(spark):
    assert substrings.repeated_passages(table(spark, [])).count() == 0
