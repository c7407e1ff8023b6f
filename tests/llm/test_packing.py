"""Packing: the plan by properties, the table against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from documents import table, varied

from permitry.llm import packing, queries


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_sequences(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 50, 1024])
    histogram = {rng.randrange(1, size + 1): rng.randrange(1, 500) for _ in range(rng.randrange(1, 60))}
    used, placed = {}, {}
    for length, rank, count, sequence, offset in packing.plan(histogram, size):
        for i in range(count):
            assert placed.setdefault((length, rank + i), (sequence + i, offset)) == (sequence + i, offset)
            used.setdefault(sequence + i, []).append((offset, length))
    assert len(placed) == sum(histogram.values())
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    tokens = sum(length * n for length, n in histogram.items())
    assert len(used) <= -(-tokens // size) * 11 / 9 + 1


def test_cuts():
    assert packing.cuts(1) == [1] and packing.cuts(1024) == [1024] and packing.cuts(1025) == [1, 1024]
    assert packing.cuts(3000, 1000) == [1000] * 3


@pytest.mark.parametrize("parts", [1, 6])
def test_like_the_library(spark, parts):
    from tokenizers import Tokenizer
    spec = queries.tokenizer()
    library = Tokenizer.from_str(spec)
    texts = varied() + ["word " * 3000, "x" * 5000, "a<|endoftext|>b", "漢字かな😀\u0000\r\n", "it's  we'll\t\t 12345"]
    ids = [library.encode(t or "", add_special_tokens=False).ids + [packing.END] for t in texts]
    found = packing.pack(table(spark, texts, parts), spec, with_ids=True)
    pieces, fill = {}, {}
    for row in found.collect():
        own = ids[row["doc_id"]][row["start"]:row["start"] + row["length"]]
        assert row["ids"] == own and zlib.crc32(np.array(own, "<u4").tobytes()) == row["ids_crc32"]
        pieces.setdefault(row["doc_id"], []).append((row["piece"], row["start"], row["length"]))
        fill.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    assert set(pieces) == set(range(len(texts)))
    for i, own in pieces.items():
        own.sort()
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert [s for _, s, _ in own] == [sum(n for _, _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, _, n in own) == len(ids[i]) and all(n == packing.SIZE for _, _, n in own[1:])
    for own in fill.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= packing.SIZE
    whole = packing.sequences(found).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(map(len, ids)) and max(len(r["ids"]) for r in whole) <= packing.SIZE


def test_repeated_rows_missing_ids_and_empty(spark):
    docs = table(spark, ["a", "a", None, ""], ids=[1, 1, None, None])
    found = packing.pack(docs, queries.tokenizer()).collect()
    assert sorted(r["length"] for r in found) == [1, 1, 2, 2] and len({(r["sequence_id"], r["offset"]) for r in found}) == 4
    assert packing.pack(table(spark, []), queries.tokenizer()).count() == 0


def test_other_tokenizers_go_to_their_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        spec = file.read()
    text = "Some words, and more!"
    assert packing.encoder(spec)(text).tolist() == Tokenizer.from_str(spec).encode(text, add_special_tokens=False).ids
