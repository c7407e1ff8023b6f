"""Fill-in-middle against a plain regular expression, the learned index against its offsets."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from documents import table, varied

from permitry.llm import fill_middle, rank_index


def expected(doc_id, text, seed="1"):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return doc_id, len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def check(spark, rows, texts, ids=None):
    docs = table(spark, texts, ids=ids)
    made = fill_middle.transform(docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    wanted = [expected(i, t) for i, t in zip(range(len(texts)) if ids is None else ids, texts)]
    order = lambda t: tuple((x is not None, x) for x in t)
    assert rows(made) == sorted(wanted, key=order)
    back = made.select("doc_id", fill_middle.restored().alias("text"))
    assert rows(back) == rows(docs.selectExpr("doc_id", "coalesce(text, '')"))
    return made


HARD = ["Ünï cödé 漢字 🙂🙂 a1b2", "<P", "<P>", "a<S>b", "P><M", "<M", "<<P<S<M", "\x00\x7f\n\r\t", "a", "ab" * 50, "é" * 300, "\n" * 700]


@pytest.mark.parametrize("part", [1 << 20, 64, 3, 1])
def test_like_a_regular_expression(spark, rows, monkeypatch, part):
    monkeypatch.setattr(fill_middle, "PART", part)
    made = check(spark, rows, varied() + HARD * 5)
    assert {r["form"] for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_every_cut_of_a_text():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["word", " ", "Ä", "x", "\n", "漢"]) for _ in range(rng.randrange(9))).encode() for _ in range(300)]
    ends = np.cumsum([len(t) for t in texts])
    index, ranks = fill_middle.boundaries(np.frombuffer(b"".join(texts), np.uint8), ends)
    first = 0
    for text, end, last in zip(texts, ends, ranks):
        places = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text.decode())] + [len(text.decode())]
        at = end - len(text) + np.array([len(text.decode()[:p].encode()) for p in places])
        assert last - first == len(places) - 1
        assert index.offsets(np.arange(first, last + 1)).tolist() == at.tolist()
        first = last


@pytest.mark.parametrize("steps", ["even", "uneven", "jumps", "giant"])
@pytest.mark.parametrize("size", [0, 1, 2, 4095, 4096, 30_011])
def test_index_gives_its_offsets_back(steps, size):
    rng = np.random.default_rng(size)
    wide = {"even": np.full(size, 3), "uneven": rng.integers(1, 12, size), "jumps": np.where(rng.random(size) < 0.01, 5000, 2),
            "giant": rng.integers(1, 1 << 40, size)}[steps]
    offsets = np.cumsum(wide, dtype=np.int64)
    index = rank_index.RankIndex()
    for part in np.array_split(offsets, 7):
        index.add(part)
    index.close()
    assert index.residuals.dtype == np.int8 and len(index.residuals) == size
    assert index.offsets(np.arange(size)).tolist() == offsets.tolist()
    picked = rng.integers(0, max(1, size), 50 if size else 0)
    assert index.offsets(picked).tolist() == offsets[picked].tolist()
    if steps in ("even", "uneven"):
        assert len(index.starts) <= size / 100 + 13


def test_nulls_repeated_rows_and_empty_tables(spark, rows):
    check(spark, rows, [None, "", "same text", "same text", "other <x> y", "some more words here"], ids=[1, 2, 3, 3, None, None])
    assert check(spark, rows, []).count() == 0


def test_clashing_columns_and_other_names(spark, rows):
    docs = table(spark, varied()[:30]).selectExpr("*", "1 AS id", "'z' AS n", "'y' AS form", "2 AS output", "3 AS `a.b`")
    assert rows(fill_middle.transform(docs)) == rows(fill_middle.transform(docs.select("doc_id", "text")))
    renamed = docs.selectExpr("doc_id AS `the.id`", "text AS `the.text`")
    assert rows(fill_middle.transform(renamed, "the.id", "the.text")) == rows(fill_middle.transform(docs))


def test_very_long_texts(spark, rows):
    check(spark, rows, ["long " * 500_000, "x" * 2_000_000, "äß 1" * 300_000, None])


def test_own_sentinels_and_seed(spark):
    made = fill_middle.transform(table(spark, ["one two three <P>"] * 40), seed="other", sentinels=("[p|", "[s|", "[m|"))
    found = made.select("*", fill_middle.restored(sentinels=("[p|", "[s|", "[m|")).alias("text")).collect()
    assert {r["text"] for r in found} == {"one two three <P>"} and len({r["form"] for r in found}) == 3
    assert all(r["output"].startswith({"plain": "one", "psm": "[p|", "spm": "[s|"}[r["form"]]) for r in found)
