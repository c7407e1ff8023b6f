"""Exact deduplication against a dictionary of normalised texts."""

import hashlib
import re

import pytest
from documents import table, varied

from permitry.llm import exact


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(ids, texts):
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault(normalised(t), []).append(i)
    return sorted((i, min(groups[normalised(t)]), len(groups[normalised(t)]), i == min(groups[normalised(t)]),
                   hashlib.sha256(normalised(t).encode()).hexdigest()) for i, t in zip(ids, texts))


@pytest.mark.parametrize("share", [1000, 10])
def test_like_a_dictionary(spark, rows, monkeypatch, share):
    monkeypatch.setattr(exact, "SHARE", share)
    texts = varied() + ["hot copy"] * 50 + ["hot  copy"] * 10
    found = exact.find_copies(table(spark, texts))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows(found) == expected(range(len(texts)), texts)


def test_repeated_rows_and_missing_ids(spark):
    docs = table(spark, ["a", "a", "a", "b", "b", None], ids=[7, 7, 3, None, 5, None])
    found = [tuple(r) for r in exact.find_copies(docs).drop("text_sha256").collect()]
    assert sorted((r for r in found if r[2] == 3)) == [(3, 3, 3, True), (7, 3, 3, False), (7, 3, 3, False)]
    assert sorted((r for r in found if r[2] == 2), key=str) == [(5, 5, 2, True), (None, 5, 2, False)]
    assert [r for r in found if r[2] == 1] == [(None, None, 1, True)]
    twice = exact.drop_copies(table(spark, ["same", "same"], ids=[1, 1]))
    assert twice.count() == 1


def test_dropping_keeps_all_columns(spark):
    docs = table(spark, ["a b", "a  b", "c"]).selectExpr("*", "doc_id AS row", "lang AS digest", "true AS kept", "text AS keep_id")
    kept = exact.drop_copies(docs)
    assert kept.schema.names == docs.schema.names
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_empty_table(spark):
    assert exact.find_copies(table(spark, [])).count() == 0
    assert exact.drop_copies(table(spark, [])).count() == 0


def test_only_dataframe_operations(spark):
    plan = exact.find_copies(table(spark, ["a", "a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowSchema", "")
