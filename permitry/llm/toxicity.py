"""Toxicity scores: FTRL-proximal logistic regression over hashed words, word n-grams and skip-grams.

A text is lower-cased, punctuation separates words, and each distinct word, pair of neighbours and pair with one word
between is a feature, hashed to 64 bits, with value 1. FTRL keeps two sums for each coordinate: a learning rate of
its own, and an L1 threshold below which the weight is exactly zero. So the model is a short list of weights, which
is broadcast.

Training reads a bounded sample of labelled rows (``samples.SAMPLE``) and is sequential by nature, so it is one task of
bounded work; features of fewer than ``FEWEST`` sampled documents are left out first. Scoring reads every whole text
once.

Defined cases: NULL and empty texts have no features and get the model's bias; without training rows of both labels
the score is the smoothed share of label 1; repeated rows get equal scores; NULL ids are returned as they are; an empty
table gives an empty result. Columns other than id and text are not looked at.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm import samples, words
from permitry.llm.slices import slices

THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 4.0, 1.0, 3.0, 0.0
EPOCHS = 6
FEWEST = 3
BIAS = np.uint64(1)
_PUNCTUATION = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))
_SCREEN_BITS = 18
_COUNT_BITS = 25
_STEP = 256


def features(text, numbers):
    """Hashes of the words, neighbouring pairs and skipping pairs of a text (bytes), with repetitions."""
    own = words.numbered(text.lower().translate(_PUNCTUATION).split(), numbers)
    pairs = words.rolling(own, 2)
    skips = words.mixed(own[:-2] * np.uint64(words.BASES[1]) + own[2:])
    return np.concatenate([own, pairs, skips])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(texts, labels):
    """Keys and weights that are not zero, of FTRL-proximal over the rows in the order given."""
    numbers, seen, shift = words.Numbers(), np.zeros(1 << _COUNT_BITS, np.uint8), np.uint64(64 - _COUNT_BITS)
    for text in texts:
        slots = np.unique(features(text, numbers) >> shift)
        seen[slots] = np.minimum(seen[slots] + 1, FEWEST)
    # found a second time rather than held: most features are rare and go
    found = []
    for text in texts:
        own = features(text, numbers)
        found.append(np.unique(np.append(own[seen[own >> shift] >= FEWEST], BIAS)))
    # in steps, so that neither all features at once nor their order are held beside them
    keys = np.unique(np.concatenate([np.unique(np.concatenate(found[i:i + _STEP])) for i in range(0, len(found), _STEP)]))
    rows = []
    for i, own in enumerate(found):
        rows.append(np.searchsorted(keys, own).astype(np.int32))
        found[i] = None
    z, n = np.zeros(len(keys)), np.zeros(len(keys))
    threshold = np.full(len(keys), L1)
    threshold[np.searchsorted(keys, BIAS)] = 0

    def weights(at):
        z_at = z[at]
        active = np.abs(z_at) > threshold[at]
        return np.where(active, -(z_at - np.sign(z_at) * threshold[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0)

    for _ in range(EPOCHS):
        for at, label in zip(rows, labels):
            w = weights(at)
            gradient = _sigmoid(w.sum()) - label
            rate = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - rate * w
            n[at] += gradient * gradient
    w = weights(np.arange(len(keys)))
    return keys[w != 0], w[w != 0]


def _fit_rows(table):
    order = np.argsort([hash_of(i) for i in table.column("id").to_pylist()], kind="stable")
    texts = table.column("text").cast(pa.binary()).to_pylist()
    labels = table.column("label").to_numpy()
    keys, weights = fit([texts[i] for i in order], labels[order])
    return pa.table({"key": pa.array(keys.view(np.int64)), "weight": pa.array(weights)})


def hash_of(value):
    """A fixed order of training rows that has nothing to do with their ids' order."""
    import xxhash
    return xxhash.xxh64_intdigest(str(value).encode())


def train(docs, labels, label_column="toxic", id_column="doc_id", text_column="text", sample=samples.SAMPLE):
    """The model: (keys, weights) as arrays, keys ascending."""
    rows = samples.training_rows(docs, labels, F.col(label_column).cast("int"), id_column, text_column, sample)
    ones, all_rows = rows.agg(F.sum("label"), F.count("*")).first()
    if not ones or ones == all_rows:
        ratio = ((ones or 0) + 1) / (all_rows + 2)
        return np.array([BIAS]), np.array([np.log(ratio / (1 - ratio))])
    model = rows.withColumn("learner", F.lit(0)).groupBy("learner").applyInArrow(_fit_rows, "key bigint, weight double").toPandas()
    keys = model["key"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], model["weight"].to_numpy()[order]


class _Scorer:
    def __init__(self, keys, weights):
        self.keys, self.weights, self.numbers = keys, weights, words.Numbers()
        self.bias = weights[keys == BIAS].sum()
        self.screen = np.zeros(1 << _SCREEN_BITS, bool)
        self.screen[keys >> np.uint64(64 - _SCREEN_BITS)] = True

    def __call__(self, texts):
        """Scores of an Arrow array of texts; a feature counts once for each text."""
        found = [features(t or b"", self.numbers) for t in texts.cast(pa.binary()).to_pylist()]
        everything = np.concatenate(found)
        of = np.repeat(np.arange(len(found)), [len(f) for f in found])
        likely = self.screen[everything >> np.uint64(64 - _SCREEN_BITS)]
        everything, of = everything[likely], of[likely]
        n = max(1, len(self.keys))
        at = np.minimum(np.searchsorted(self.keys, everything), n - 1)
        there = self.keys[at] == everything if len(self.keys) else np.zeros(len(at), bool)
        pairs = np.unique(of[there] * n + at[there])
        return _sigmoid(np.bincount(pairs // n, self.weights[pairs % n], len(found)) + self.bias)


def _score(batches, keys, weights, schema):
    scorer = _Scorer(keys, weights)
    for whole in batches:
        for batch in slices(whole, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(batch.column(1)))], schema=schema)


def _keep_below(batches, keys, weights, at, threshold):
    scorer = _Scorer(keys, weights)
    for whole in batches:
        for batch in slices(whole, at):
            yield batch.filter(pa.array(scorer(batch.column(at)) < threshold))


def score(docs, model, id_column="doc_id", text_column="text"):
    """Rows (id, score) for every document."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = T.StructType([docs.schema[id_column], T.StructField("score", T.DoubleType())])
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(partial(_score, keys=model[0], weights=model[1], schema=to_arrow_schema(types)), types)


def scored(docs, labels, id_column="doc_id", text_column="text", threshold=THRESHOLD):
    """One row per document: id, held_out, score, predicted."""
    found = score(docs, train(docs, labels, "toxic", id_column, text_column), id_column, text_column)
    return found.select(id_column, samples.held_out(id_column).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs, labels, id_column="doc_id", text_column="text", threshold=THRESHOLD):
    """The documents that score below the threshold, with all their columns."""
    model = train(docs, labels, "toxic", id_column, text_column)
    run = partial(_keep_below, keys=model[0], weights=model[1], at=docs.columns.index(text_column), threshold=threshold)
    # by place, as any name may be one that has to be quoted
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
