"""Graded quality: cumulative-link (ordered logit) regression on hashed text, one weight vector for all grades.

P(grade > k) = sigmoid(s - t_k), with s = w . x shared by all grades and thresholds t_0 < t_1 < ...; each step
between thresholds is the exponential of a free parameter, so the order always holds. The expected grade and the tail
probability of reaching a grade come from the same s.

Features are relative frequencies, in groups of unit length: words, word shapes (runs of lower, upper and digits, with
the marks between), neighbouring shapes, and how many words and word pairs occurred before in the text. Words, shapes
and pairs are hashed to ``BITS`` bits.

Training reads a bounded sample in shards (``samples``) with AdaGrad steps, one task for a shard; weights and
thresholds are averaged, and the weights, at most 2 ** BITS of them, are broadcast. Scoring reads every whole text once.

Defined cases: NULL and empty texts get s = 0 plus nothing, so the thresholds alone decide; with training rows of
fewer than two grades every text is expected to have that grade (0 if there is none); repeated rows get equal
results; NULL ids are returned as they are; an empty table gives an empty result. Columns other than id and text are
not looked at.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm import samples, words
from permitry.llm.slices import slices

BITS = 18
EPOCHS = 4
RATE = 0.3
DECAY = 1e-6
KEEP_AT = 0.5
_SHARES = 8
#: Bytes whose words are hashed at once.
PART = 1 << 20
#: Training rows whose features are made at once.
TOGETHER = 64


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Classes of bytes for the shape of a word; marks are classes of their own.
_CLASS = np.array([ord("a") if 97 <= b < 123 or b >= 128 else ord("0") if 48 <= b < 58 else ord("A") if 65 <= b < 91 else b
                   for b in range(256)], np.uint8)
_MARKS = (b"#", b"*", b"$", b"%", b"&", b"|", b"!")


def _parts(data):
    """Cuts of an array of bytes into parts of about ``PART`` bytes that end between words."""
    first = 0
    while first < len(data):
        last = min(len(data), first + PART)
        while last < len(data) and not _SPACE[data[last]]:
            step = np.flatnonzero(_SPACE[data[last:last + PART]])
            last = last + int(step[0]) if len(step) else min(len(data), last + PART)
        yield first, last
        first = last


class Hasher:
    """Hashes of the words of a text and of their shapes, by sums of bytes times powers of an odd number."""

    def __init__(self):
        self.powers = self.inverse = np.empty(0, np.uint64)

    def _spans(self, values, starts, ends):
        if len(values) > len(self.powers):
            self.powers = words.powers(words.BASES[0], 2 * len(values))
            self.inverse = words.powers(pow(words.BASES[0], -1, 1 << 64), 2 * len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * self.powers[:len(values)], out=sums[1:])
        return words.mixed((sums[ends] - sums[starts]) * self.inverse[starts])

    def _part(self, data):
        space = _SPACE[data]
        edges = np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        kind = _CLASS[data]
        same = np.zeros(len(data), bool)
        same[1:] = kind[1:] == kind[:-1]
        run = same & ((kind == ord("a")) | (kind == ord("0")))
        # of capitals, two tell a run from a single one
        run[2:] |= same[2:] & same[1:-1] & (kind[2:] == ord("A"))
        place = np.concatenate(([0], np.cumsum(~run)))
        return starts, self._spans(data, starts, ends), self._spans(kind[~run], place[starts], place[ends])

    def of(self, data):
        """Places of the words, their hashes and the hashes of their shapes."""
        found = [(part[0] + first, *part[1:]) for first, last in _parts(data) for part in [self._part(data[first:last])]]
        none = np.empty(0, np.uint64)
        return [np.concatenate(column) for column in zip(*found)] if found else [none.astype(np.int64), none, none]


def _keys(values, texts, bits):
    """Sorted keys: the text's number in the first ``bits`` bits, then the first bits of the value."""
    keys = (texts.astype(np.uint64) << np.uint64(64 - bits)) | (values >> np.uint64(bits))
    keys.sort()
    return keys


def _hashed(values, texts, counts, bits):
    """Text, slot and value of each text's distinct slots."""
    keys = _keys(values & ~np.uint64((1 << 64 - BITS) - 1), texts, bits)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    text = (keys[first] >> np.uint64(64 - bits)).astype(np.int64)
    slots = ((keys[first] << np.uint64(bits)) >> np.uint64(64 - BITS)).astype(np.int64)
    return text, slots, np.sqrt(np.diff(first, append=len(keys)) / np.maximum(1, counts)[text])


def _inside(texts, width):
    """Places from which ``width`` words are of one text."""
    n = max(0, len(texts) - width + 1)
    return texts[:n] == texts[width - 1:width - 1 + n]


def features(texts, hasher):
    """Features of a list of texts (bytes): arrays text, slot, value, by text, and a row of shares for each text."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    places, as_words, as_shapes = hasher.of(np.frombuffer(b" ".join([*texts, b""]), np.uint8))
    of = np.searchsorted(ends, places, side="right")
    counts = np.bincount(of, minlength=len(texts))
    bits = max(1, len(texts).bit_length())
    pairs = _inside(of, 2)
    parts = [_hashed(as_words, of, counts, bits), _hashed(as_shapes, of, counts, bits),
             _hashed(words.rolling(as_shapes, 2)[pairs], of[:len(pairs)][pairs], counts - 1, bits)]
    shares = np.zeros((len(texts), _SHARES))
    for i, width in enumerate((1, 2, 4)):
        inside = _inside(of, width)
        keys = _keys(words.rolling(as_words, width)[inside], of[:len(inside)][inside], bits)
        new = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
        distinct = np.bincount((new >> np.uint64(64 - bits)).astype(np.int64), minlength=len(texts))
        runs = counts - width + 1
        shares[:, i] = np.where(runs > 0, 1 - distinct / np.maximum(1, runs), 0)
    again = np.flatnonzero((as_words[1:] == as_words[:-1]) & pairs)
    shares[:, 3] = np.bincount(of[again], minlength=len(texts)) / np.maximum(1, counts - 1)
    marks = np.array([sum(map(t.count, _MARKS)) for t in texts])
    shares[:, 4] = np.minimum(1, marks / np.maximum(1, counts))
    shares[:, 5] = 1 / (1 + counts)
    shares[:, 6] = np.minimum(1, np.log1p(counts) / 12)
    return [np.concatenate(column) for column in zip(*parts)], shares


def rows_of(found, shares):
    """Slots and values of each text; the last slots are its shares."""
    text, slots, values = found
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(1, len(shares)))
    last = np.arange(_SHARES) + (1 << BITS)
    return [(np.concatenate([s, last]), np.concatenate([v, own]))
            for s, v, own in zip(np.split(slots[order], cuts), np.split(values[order], cuts), shares)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Model:
    """Weights, thresholds in ascending order, and the grades they lie between."""

    def __init__(self, weights, thresholds, grades):
        self.weights, self.thresholds, self.grades = weights, thresholds, grades


def slopes(s, thresholds, level):
    """Derivatives of -log P(grade = level) by s and by each threshold."""
    above = _sigmoid(s - thresholds)
    tail = np.concatenate(([1.0], above, [0.0]))
    slope = np.concatenate(([0.0], above * (1 - above), [0.0]))
    chance = max(tail[level] - tail[level + 1], 1e-9)
    by_threshold = np.zeros(len(thresholds))
    if level > 0:
        by_threshold[level - 1] += slope[level] / chance
    if level < len(thresholds):
        by_threshold[level] -= slope[level + 1] / chance
    return -(slope[level] - slope[level + 1]) / chance, by_threshold


def fit(rows, levels):
    """Weights and thresholds from (slots, values) and level of each row, levels 0 to ``levels`` - 1."""
    weights, squares = np.zeros((1 << BITS) + _SHARES), np.full((1 << BITS) + _SHARES, 1e-8)
    first, steps = -1.0, np.zeros(levels - 2)
    seen = np.full(levels - 1, 1e-2)
    for _ in range(EPOCHS):
        for (slots, values), level in rows:
            gaps = np.exp(steps)
            thresholds = first + np.concatenate(([0.0], np.cumsum(gaps)))
            by_s, by_threshold = slopes(weights[slots] @ values, thresholds, level)
            step = by_s * values + DECAY * weights[slots]
            squares[slots] += step * step
            weights[slots] -= RATE * step / np.sqrt(squares[slots])
            by_first = by_threshold.sum()
            by_steps = np.cumsum(by_threshold[:0:-1])[::-1] * gaps
            moved = np.concatenate(([by_first], by_steps))
            seen += moved * moved
            first -= RATE * by_first / np.sqrt(seen[0])
            steps -= RATE * by_steps / np.sqrt(seen[1:])
    return weights, first + np.concatenate(([0.0], np.cumsum(np.exp(steps))))


def _fit_shard(table, grades):
    rows = sorted(zip(table.column("id").to_pylist(), table.column("text").cast(pa.binary()).to_pylist(),
                      table.column("label").to_pylist()), key=lambda r: xxhash.xxh64_intdigest(str(r[0]).encode()))
    hasher, learned = Hasher(), []
    for at in range(0, len(rows), TOGETHER):
        own = rows[at:at + TOGETHER]
        learned += zip(rows_of(*features([t for _, t, _ in own], hasher)), [grades.index(g) for _, _, g in own])
    weights, thresholds = fit(learned, len(grades))
    used = np.flatnonzero(weights)
    slots = np.concatenate([used, -1 - np.arange(len(thresholds))])
    return pa.table({"slot": pa.array(slots, pa.int64()), "weight": pa.array(np.concatenate([weights[used], thresholds]))})


def train(docs, labels, grade, id_column="doc_id", text_column="text", sample=samples.SAMPLE):
    """The model of the integer column ``grade`` of ``labels``; each of its grades gets a level."""
    rows = samples.training_rows(docs, labels, grade.cast("int"), id_column, text_column, sample)
    grades = sorted(row["label"] for row in rows.select("label").distinct().collect())
    if len(grades) < 2:
        return Model(np.zeros((1 << BITS) + _SHARES), np.empty(0), grades or [0])
    shards = rows.agg(F.countDistinct("shard")).first()[0]
    learned = rows.groupBy("shard").applyInArrow(partial(_fit_shard, grades=grades), "slot bigint, weight double")
    mean = learned.groupBy("slot").agg((F.sum("weight") / shards).alias("weight")).toPandas()
    slots, values = mean["slot"].to_numpy(), mean["weight"].to_numpy()
    weights = np.zeros((1 << BITS) + _SHARES)
    weights[slots[slots >= 0]] = values[slots >= 0]
    thresholds = np.zeros(len(grades) - 1)
    thresholds[-1 - slots[slots < 0]] = values[slots < 0]
    return Model(weights, thresholds, grades)


def _score(batches, weights, thresholds, grades, target, schema):
    hasher = Hasher()
    low, gaps = float(grades[0]), np.diff(np.array(grades, float))
    reach = np.searchsorted(grades, target)
    for whole in batches:
        for batch in slices(whole, 1):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            (text, slots, values), shares = features(texts, hasher)
            sums = np.bincount(text, weights[slots] * values, len(texts)) + shares @ weights[1 << BITS:]
            above = _sigmoid(sums[:, None] - thresholds[None, :])
            tail = above[:, reach - 1] if 0 < reach <= len(thresholds) else np.full(len(sums), float(reach == 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(low + above @ gaps), pa.array(tail)], schema=schema)


def score(docs, model, target, id_column="doc_id", text_column="text"):
    """Rows (id, expected_grade, tail_probability): the chance of grade ``target`` or more."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = T.StructType([docs.schema[id_column], T.StructField("expected_grade", T.DoubleType()),
                          T.StructField("tail_probability", T.DoubleType())])
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    run = partial(_score, weights=model.weights, thresholds=model.thresholds, grades=model.grades, target=target,
                  schema=to_arrow_schema(types))
    return rows.mapInArrow(run, types)


def graded(docs, labels, grade, target, id_column="doc_id", text_column="text", keep_at=KEEP_AT):
    """One row per document: id, held_out, expected_grade, tail_probability, kept."""
    found = score(docs, train(docs, labels, grade, id_column, text_column), target, id_column, text_column)
    return found.select(id_column, samples.held_out(id_column).alias("held_out"), "expected_grade", "tail_probability",
                        (F.col("tail_probability") >= keep_at).alias("kept"))
