"""One text far longer than a chunk or slice, next to short ones, in every operator."""

import random

import pytest
from documents import prose, table

from permitry.llm import (
    exact, html_text, licences, ngram_join, ordinal, packing, quality_rules, queries, sentence_pieces, substrings, toxicity,
)
from pyspark.sql import functions as F

WORDS = 500_000


@pytest.fixture(scope="module")
def long():
    rng = random.Random(11)
    head, passage = prose(rng, 400, 10 ** 6), prose(rng, 80, 10 ** 6)
    body = prose(rng, WORDS - 1000, 10 ** 6)
    return f"{head} {passage}\n{body} {licences.TEMPLATES['GPL-3.0']} {passage}"


@pytest.fixture(scope="module")
def docs(spark, long):
    rng = random.Random(12)
    changed = long.split()
    changed[1000] = "changed"
    return table(spark, [long, " ".join(changed), "short text", "x" * 3_000_000, *(prose(rng, 50) for _ in range(20))], 4).cache()


def of(found, key="doc_id"):
    return {row[key]: row for row in found.collect()}


def test_exact(docs, long):
    found = of(exact.find_copies(docs))
    assert all(row["group_size"] == 1 for row in found.values())


def test_near_copies(docs, long):
    found = of(ngram_join.near_copies(docs))
    words = long.lower().split()
    assert found[0]["n_shingles"] == len({tuple(words[i:i + 4]) for i in range(len(words) - 3)})
    assert found[1]["component_id"] == 0 and found[3]["n_shingles"] == 1


def test_passages(docs, long):
    found = of(substrings.repeated_passages(docs))
    count = len(long.split())
    assert found[0]["n_words"] == count
    # all but the windows around the changed word are found in both texts
    assert found[0]["n_removed"] == found[1]["n_removed"] + 0 == count - 1
    assert found[2]["n_removed"] == 0 and found[3]["n_words"] == 1


def test_packing(docs, long):
    from tokenizers import Tokenizer
    spec = queries.tokenizer()
    sums = of(packing.pack(docs, spec).groupBy("doc_id").agg(F.sum("length").alias("n")))
    library = Tokenizer.from_str(spec)
    for i, text in ((0, long), (3, "x" * 3_000_000)):
        assert sums[i]["n"] == len(library.encode(text, add_special_tokens=False).ids) + 1


def test_sentence_pieces(docs, long):
    model = queries.piece_model()
    found = of(sentence_pieces.encode(docs.where("doc_id <> 1"), model))
    library = sentence_pieces.Pieces(model).library
    assert found[0]["ids"] == library.encode(long) and found[0]["restored"]
    assert found[3]["ids"] == library.encode("x" * 3_000_000)


def test_rules_licences_and_models(spark, docs, long):
    rules = of(quality_rules.judged(docs))
    assert rules[0]["n_words"] == len(long.split()) and rules[0]["longest_repeat"] >= 80 and not rules[0]["kept"]
    assert of(licences.scan(docs))[0]["licence"] == "GPL-3.0"
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(24)], "doc_id bigint, quality int, toxic int")
    assert toxicity.scored(docs, labels).where("score between 0 and 1").count() == 24
    assert ordinal.graded(docs, labels, F.col("quality"), 1).where("tail_probability between 0 and 1").count() == 24


def test_html(spark):
    body = "".join(f"<p>{i} paragraph &amp; <b>more</b>" for i in range(60_000))
    pages = spark.createDataFrame([(1, "http://a.b/", f"<article>{body}</article>"), (2, "http://a.b/", "<div>" * 400 + "deep" + "</div>" * 400)],
                                  "page_id bigint, url string, html string")
    found = of(html_text.extract(pages), "page_id")
    assert found[1]["text"].count("\n\n") == 59_999 and found[2]["text"] == "deep"
