"""Pairs of words whose vectors are near, by a ball cover instead of all pairs.

About sqrt(V) words of the right side are centres, ``MOST`` at most; every word belongs to the cell of its nearest centre
and knows its distance to it. A left word within ``reach`` of a right word r of cell c is, by the triangle inequality,

* no further from c than from its own nearest centre and twice ``reach``, as r is nearest to c,
* about as far from c as r is: the two distances differ by ``reach`` at most.

Words are dealt once, in order of cell and distance, and stored in packs of up to ``BLOCK`` vectors as bytes. A pack knows
the cells of its right words and between which distances they lie there, and for every centre between which distances its
left words lie that the first rule allows. Packs meet in a cartesian product of the stored table with itself, on which both
rules are a condition: a task reads the two parts that it compares, and no copy of a vector is shuffled or kept for the
packs that it meets, however many these are. Inside a meeting both rules hold for each word; distances are a product of
matrices in single precision where its rounding is small next to ``reach``, and what it lets through is computed again in
double precision. Nothing is approximate.

Defined cases: a word without vector is near nothing; repeated words are rows of their own.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.session import cut

BLOCK = 2000
#: Packs of one file of the stored table, about.
PACKS = 4
#: Centres are sent to every task: this bounds them.
MOST = 4096
#: Words whose distances are held at once.
STRIP = 256
#: Pairs whose vectors are compared again at once.
EXACT = 1 << 13
_LEFT, _RIGHT = 1, 2
_PLACED = "word string, vec array<float>, sides tinyint, cell int, at double"
#: Words of a pack with their vectors, sides, cells and distances as bytes; what its right and its left words reach.
_PACK = ("words array<string>, vectors binary, sides binary, cells binary, at binary, "
         "segments array<struct<cell: int, low: double, high: double>>, lows array<double>, highs array<double>")
_MET = ("words", "vectors", "sides", "cells", "at")
_VECTOR = T.ArrayType(T.FloatType())


def _matrix(column):
    """Vectors of an Arrow list column as rows."""
    values = column.values.to_numpy(zero_copy_only=False) if len(column) else np.empty(0)
    offsets = column.offsets.to_numpy()
    return np.asarray(values[offsets[0]:offsets[-1]], float).reshape(len(column), -1)


def _squares(vectors):
    return (vectors * vectors).sum(1)


def _distances(vectors, centres):
    """Distances to centres, and how far from exact those of a vector may be: differences of squares lose half of the digits."""
    squares, others = _squares(vectors), _squares(centres)
    far = np.sqrt(np.maximum(squares[:, None] + others[None, :] - 2 * vectors @ centres.T, 0))
    return far, 1e-6 * (1 + np.sqrt(squares) + np.sqrt(others.max()))


def _strips(size):
    return [slice(start, min(size, start + STRIP)) for start in range(0, size, STRIP)]


def _to_nearest(batches, centres):
    """Each word with its nearest centre."""
    for batch in batches:
        if batch.num_rows:
            vectors = _matrix(batch.column(1))
            cells = np.concatenate([_distances(vectors[strip], centres)[0].argmin(1) for strip in _strips(len(vectors))])
            at = np.sqrt(_squares(vectors - centres[cells]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32()), pa.array(at)], ["word", "vec", "sides", "cell", "at"])


def _segments(cells):
    """Places at which the runs of equal cells start, and the end."""
    return [*np.flatnonzero(np.diff(cells, prepend=-1)).tolist(), len(cells)]


def _pack(rows, centres, reach):
    vectors, sides, cells, at = _matrix(rows.column(1)), *(rows.column(i).to_numpy(False) for i in (2, 3, 4))
    right, left = (sides & _RIGHT) > 0, (sides & _LEFT) > 0
    cuts = _segments(cells[right])
    segments = [{"cell": int(cells[right][a]), "low": float(at[right][a]), "high": float(at[right][b - 1])} for a, b in zip(cuts, cuts[1:])]
    lows, highs = np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
    own, near = vectors[left], at[left][:, None]
    for strip in _strips(len(own)):
        far, slack = _distances(own[strip], centres)
        slack = slack[:, None]
        allowed = far <= near[strip] + 2 * reach + 2 * slack
        lows = np.minimum(lows, np.where(allowed, far - slack, np.inf).min(0))
        highs = np.maximum(highs, np.where(allowed, far + slack, -np.inf).max(0))
    schema = [pa.string(), None, None, None, None, pa.struct([("cell", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]), pa.float64(), pa.float64()]
    values = [rows.column(0), vectors.astype(np.float32).tobytes(), sides.astype(np.uint8).tobytes(), cells.astype(np.int32).tobytes(),
              at.astype(float).tobytes(), segments, lows, highs]
    columns = [pa.array([v], pa.binary()) if kind is None else _one_list(v, kind) for v, kind in zip(values, schema)]
    return pa.RecordBatch.from_arrays(columns, ["words", "vectors", "sides", "cells", "at", "segments", "lows", "highs"])


def _one_list(values, kind):
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(batches, centres, reach, block):
    """Packs of a part whose rows come in order of cell and distance."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        full = rows.num_rows // block * block
        for start in range(0, full, block):
            yield _pack(rows.slice(start, block), centres, reach)
        rest = rows.slice(full)
    if rest is not None and rest.num_rows:
        yield _pack(rest, centres, reach)


def _rounding(a, b, kind):
    """By how much a squared distance from a product of matrices of this kind may be off."""
    return 8 * (a.shape[1] + 8) * np.finfo(kind).eps * (_squares(a).max(initial=0) + _squares(b).max(initial=0))


def _meet(a, near_a, b, cells_b, at_b, centres, reach):
    """Index pairs of rows of a and b within ``reach``, and the number of pairs of which coordinates were looked at.

    ``near_a`` is how far the left words are from their nearest centres; b is in order of cell and distance.
    """
    cuts, limit, compared, found = _segments(cells_b), reach * reach, 0, [(np.empty(0, int), np.empty(0, int))]
    kind = np.float32 if _rounding(a, b, np.float32) <= limit / 16 else np.float64
    bound = limit + _rounding(a, b, kind)
    # the product of these is the squared distance
    ones = np.ones((max(len(a), len(b)), 1))
    wide_a = np.hstack([-2 * a, _squares(a)[:, None], ones[:len(a)]]).astype(kind)
    wide_b = np.hstack([b, ones[:len(b)], _squares(b)[:, None]]).astype(kind)
    at_a, slack = _distances(a, centres[cells_b[cuts[:-1]]])
    allowed = at_a <= (near_a + 2 * reach + 2 * slack)[:, None]
    for n, (first, last) in enumerate(zip(cuts, cuts[1:])):
        far, at = at_a[:, n], at_b[first:last]
        rows = np.flatnonzero(allowed[:, n] & (far >= at[0] - reach - slack) & (far <= at[-1] + reach + slack))
        rows = rows[np.argsort(far[rows], kind="stable")]
        part, far, off = wide_a[rows], far[rows], slack[rows]
        for strip in _strips(len(rows)):
            width = reach + off[strip].max()
            low, high = np.searchsorted(at, far[strip][0] - width), np.searchsorted(at, far[strip][-1] + width, side="right")
            squares = part[strip] @ wide_b[first + low:first + high].T
            compared += squares.size
            i, j = np.nonzero(squares <= bound)
            i, j = rows[i + strip.start], j + first + low
            for k in range(0, len(i), EXACT):
                some_i, some_j = i[k:k + EXACT], j[k:k + EXACT]
                close = _squares(a[some_i] - b[some_j]) <= limit
                found.append((some_i[close], some_j[close]))
    i, j = (np.concatenate(column) for column in zip(*found))
    return i, j, compared


def _read(row, side):
    """Words, vectors, cells and distances of the words of a pack on this side."""
    words, (vectors, sides, cells, at) = row[0].flatten(), (c[0].as_buffer() for c in row[1:])
    own = np.flatnonzero(np.frombuffer(sides, np.uint8) & side)
    vectors = np.frombuffer(vectors, np.float32).reshape(len(words), -1)
    return words.take(pa.array(own)), vectors[own].astype(float), np.frombuffer(cells, np.int32)[own], np.frombuffer(at, float)[own]


def _compare(batches, centres, reach, counted):
    """Pairs of words of two packs that meet, or the numbers of compared pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            columns = [c.slice(row, 1) for c in batch.columns]
            words_l, a, _, near_a = _read(columns[:len(_MET)], _LEFT)
            words_r, b, cells_b, at_b = _read(columns[len(_MET):], _RIGHT)
            i, j, compared = _meet(a, near_a, b, cells_b, at_b, centres, reach)
            if counted:
                yield pa.RecordBatch.from_arrays([pa.array([compared])], ["compared"])
            elif len(i):
                yield pa.RecordBatch.from_arrays([words_l.take(pa.array(i)), words_r.take(pa.array(j))], ["near", "word"])


def _meetings(lexicon, reach):
    """The packs of all words, each next to those whose right words may be near its left ones, and the centres; None if a side is empty."""
    side = F.when(F.col("in_left") > 0, _LEFT).otherwise(0) + F.when(F.col("in_right") > 0, _RIGHT).otherwise(0)
    rows = lexicon.select("word", F.col("vec").cast(_VECTOR).alias("vec"), side.cast("tinyint").alias("sides")).where("vec IS NOT NULL AND sides > 0")
    right = F.col("sides") >= _RIGHT
    count, count_l, count_r = rows.agg(F.count("*"), F.count_if(F.col("sides") != _RIGHT), F.count_if(right)).first()
    if not count_l or not count_r:
        return None
    wanted = min(MOST, int(np.ceil(np.sqrt(count_r))))
    picked = rows.where(right).orderBy(F.xxhash64("word"), "word").limit(wanted).select("vec").collect()
    centres = np.array([r["vec"] for r in picked], float)

    placed = rows.mapInArrow(partial(_to_nearest, centres=centres), _PLACED)
    dealt = placed.repartitionByRange(-(-count // (PACKS * BLOCK)), "cell", "at", "word").sortWithinPartitions("cell", "at")
    packs = cut(dealt.mapInArrow(partial(_packed, centres=centres, reach=reach, block=BLOCK), _PACK))
    lefts = packs.select(*[F.col(c).alias(f"{c}_l") for c in _MET], "lows", "highs")
    rights = packs.select(*[F.col(c).alias(f"{c}_r") for c in _MET], "segments")
    met = F.exists("segments", lambda s: (F.get("lows", s["cell"]) <= s["high"] + reach) & (F.get("highs", s["cell"]) >= s["low"] - reach))
    pairs = lefts.join(rights.hint("shuffle_replicate_nl"), met)
    return pairs.select(*[f"{c}_l" for c in _MET], *[f"{c}_r" for c in _MET]), centres


def near_words(lexicon, reach, counted=False):
    """Pairs (near, word) of a left and a right word within ``reach``, a little more for rounding.

    ``lexicon`` has a row per word with ``vec`` and, in ``in_left`` and ``in_right``, how often each side holds it. With
    ``counted`` rows (compared) instead: of how many pairs of words coordinates were looked at, by pair of packs.
    """
    width = float(reach) * (1 + 1e-6) + 1e-6
    schema = "compared bigint" if counted else "near string, word string"
    found = _meetings(lexicon, width)
    if found is None:
        return lexicon.sparkSession.createDataFrame([], schema)
    pairs, centres = found
    return pairs.mapInArrow(partial(_compare, centres=centres, reach=width, counted=counted), schema)
