"""Quality rules on repetition, from a suffix array of the words of each text.

The suffixes of all texts of a slice are sorted together by prefix doubling; a text's number is part of its first
symbol, so suffixes of different texts never compare equal. Only suffixes that are still tied are sorted again.
The ranks of each round give the longest common prefix (LCP) of neighbours in the array. The longest prefix that a
suffix shares with a neighbour is the longest substring from there that occurs again, so the LCP intervals of
at least ``LEAST`` words, with all their occurrences, are the maximal repeated substrings; their union is what
repetition covers. The rules limit the covered share of the words and the longest repeat.

Base counts: words, their characters, symbols, lines equal to an earlier line, and words in 5-word windows that occur
twice or more in the text (positions whose neighbour LCP is 5 or more).

Defined cases: NULL text counts as empty; an empty text has zeros everywhere and fails the base rules, having too
few words; repeated rows get equal results; NULL ids are returned as they are; an empty table gives an empty result.
Columns other than id and text are not looked at.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm import words
from permitry.llm.slices import slices

WINDOW = 5
#: A repeated substring counts from this length on.
LEAST = 16
#: Most hundredths of the words that repeated substrings may cover, and most words of the longest one.
COVERED_PERCENT = 10
LONGEST = 60
FEWEST_WORDS = 10
REPEATED_PERCENT = 20
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\f"


def _dense_firsts(new, at):
    """For sorted items the array place of the first of their run; ``at`` is each item's place."""
    firsts = np.where(new, at, 0)
    return np.maximum.accumulate(firsts)


def longest_repeats(numbers, counts):
    """For each position of the concatenated texts, the length of the longest substring from there that occurs again
    in the same text (overlaps allowed)."""
    n = len(numbers)
    if not n:
        return np.zeros(0, np.int64)
    text_of = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    symbols = words.mixed(numbers ^ words.mixed(text_of.astype(np.uint64) + np.uint64(1)))
    order = np.lexsort((symbols, text_of))
    new = np.concatenate(([True], (np.diff(symbols[order]) != 0) | (np.diff(text_of[order]) != 0)))
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = _dense_firsts(new, place)
    ranks, width = [rank], 1
    while True:
        tied = np.concatenate((~new[1:], [False])) | ~new
        at = place[tied]
        if not len(at):
            break
        suffix = order[tied]
        following = np.minimum(suffix + width, n - 1)
        after = np.where(left[suffix] > width, rank[following] + 1, 0)
        again = np.lexsort((after, rank[suffix]))
        suffix, after = suffix[again], after[again]
        own = rank[suffix]
        order[at] = suffix
        new_here = np.concatenate(([True], (np.diff(own) != 0) | (np.diff(after) != 0)))
        new = np.ones(n, bool)
        new[at] = new_here
        rank = rank.copy()
        rank[suffix] = _dense_firsts(new_here, at)
        ranks.append(rank)
        width *= 2
    first, second = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    pairs = np.flatnonzero(ranks[0][first] == ranks[0][second])
    first, second, length = first[pairs], second[pairs], np.zeros(len(pairs), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        a, b = first + length, second + length
        fits = (left[first] > length) & (left[second] > length)
        same = fits & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
        length += same.astype(np.int64) << level
    common[pairs] = length
    best = np.zeros(n, np.int64)
    best[order[:-1]] = common
    best[order[1:]] = np.maximum(best[order[1:]], common)
    return best


def _covered(best, least):
    """Mask of positions inside a repeat of at least ``least`` words, by the longest repeat from each position."""
    starts = np.flatnonzero(best >= least)
    steps = np.zeros(len(best) + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + best[starts], -1)
    return np.cumsum(steps[:-1]) > 0


def _count(text, characters):
    return sum(text.count(bytes([c])) for c in characters)


def _duplicate_lines(text):
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            repeated += line in seen
            seen.add(line)
    return repeated


def _measure(batches, schema):
    numbers = words.Numbers()
    for whole in batches:
        for batch in slices(whole, 1):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            parts = [words.numbered(t.split(), numbers) for t in texts]
            counts = np.array([len(p) for p in parts])
            ends = np.cumsum(counts)
            best = longest_repeats(np.concatenate(parts), counts)

            def per_text(mask):
                sums = np.concatenate(([0], np.cumsum(mask)))
                return sums[ends] - sums[ends - counts]

            longest = np.zeros(len(texts), np.int64)
            np.maximum.at(longest, np.repeat(np.arange(len(texts)), counts), best)
            characters = pa.compute.fill_null(pa.compute.utf8_length(batch.column(1)), 0).to_numpy(False)
            out = [
                counts, characters - np.array([_count(t, _SPACES) for t in texts]), [_count(t, _SYMBOLS) for t in texts],
                [_duplicate_lines(t) for t in texts], per_text(words.covered(np.flatnonzero(best >= WINDOW), WINDOW, len(best))),
                per_text(_covered(best, LEAST)), longest]
            arrays = [pa.array(values, pa.int64()) for values in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=schema)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def measured(docs, id_column="doc_id", text_column="text"):
    """One row per document: id, the base counts, covered_words and longest_repeat."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = T.StructType([docs.schema[id_column], *(T.StructField(name, T.LongType()) for name in _COUNTS)])
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(partial(_measure, schema=to_arrow_schema(types)), types)


def judged(docs, id_column="doc_id", text_column="text", covered_percent=COVERED_PERCENT, longest=LONGEST):
    """``measured`` with base_failed and kept."""
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    repetitive = (100 * F.col("covered_words") > covered_percent * F.col("n_words")) | (F.col("longest_repeat") > longest)
    return measured(docs, id_column, text_column).withColumns({"base_failed": failed, "kept": ~failed & ~repetitive})
