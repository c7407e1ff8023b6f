"""Fill-in-middle transformation: each text cut at two random unit boundaries and put together again in another order.

Units are ``[A-Za-z]+|[^A-Za-z]``: a run of ASCII letters, or one other code point. The two cuts, the form and its order
come from the SHA-256 of the seed and the id, so they depend on nothing else.

The offsets of all unit boundaries of a slice of texts go into a learned rank index (``rank_index``): straight pieces of
bounded error with one byte of residual a boundary. A text's number of units gives its cut ranks; the index predicts their
offsets and the residuals correct them exactly. The boundaries are found in parts of ``PART`` bytes, so a giant text
needs one byte a boundary and not its offsets.

Forms: ``plain``, the text itself, if it is empty, holds a sentinel or is not chosen; ``psm``, prefix, suffix, middle, each
after its sentinel; ``spm``, suffix, prefix, middle. ``restored`` takes the text from output and form again.

Defined cases: NULL text counts as empty, a NULL id as the empty text in the seed; repeated rows get equal results; an
empty table gives an empty result; columns other than id and text are not looked at, whatever their names.
"""

from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm.rank_index import RankIndex
from permitry.llm.slices import slices

SEED = "1"
#: Percent of the texts that are transformed, and of those in the order suffix, prefix, middle.
CHOSEN, SUFFIX_FIRST = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PART = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _inside(data):
    """Bytes that continue a code point."""
    return (data & 0xC0) == 0x80


def _starts(data, ends):
    """Offsets of the first byte of each unit, in parts; ``ends`` are the ends of the texts, where units end too."""
    for first in range(0, len(data), PART):
        part = data[first:first + PART]
        letter = _LETTER[part]
        joined = np.empty(len(part), bool)
        joined[1:] = letter[1:] & letter[:-1]
        joined[0] = first > 0 and letter[0] and _LETTER[data[first - 1]]
        here = ends[np.searchsorted(ends, first):np.searchsorted(ends, first + len(part))]
        joined[here - first] = False
        yield np.flatnonzero(~(joined | _inside(part))) + first


def boundaries(data, ends):
    """The index of all unit boundaries of texts that follow each other, and the rank of each text's end."""
    index, counted, ranks = RankIndex(), 0, np.zeros(len(ends), np.int64)
    seen = 0
    for starts in _starts(data, ends):
        until = np.searchsorted(ends, starts[-1], side="right") if len(starts) else seen
        ranks[seen:until] = counted + np.searchsorted(starts, ends[seen:until])
        seen, counted = until, counted + len(starts)
        index.add(starts)
    ranks[seen:] = counted
    index.add(np.array([len(data)], np.int64))
    return index.close(), ranks


def _draws(id_, seed):
    """Four numbers of 32 bits."""
    digest = sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def _form(text, draws, sentinels):
    if not text or draws[2] % 100 >= CHOSEN or any(s in text for s in sentinels):
        return "plain"
    return "spm" if draws[3] % 100 < SUFFIX_FIRST else "psm"


def _length(text):
    return len(text) - int(np.count_nonzero(_inside(np.frombuffer(text, np.uint8))))


def _transformed(texts, ids, seed, sentinels):
    """Columns n, form, prefix_chars, middle_chars, output of a list of texts (bytes)."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    index, ranks = boundaries(np.frombuffer(b"".join(texts), np.uint8), ends)
    counts = np.diff(ranks, prepend=0)
    draws = [_draws(i, seed) for i in ids]
    cuts = np.sort(np.array([(d[0] % (n + 1), d[1] % (n + 1)) for d, n in zip(draws, counts.tolist())], np.int64), axis=1)
    places = index.offsets(cuts + (ranks - counts)[:, None]) - (ends - [len(t) for t in texts])[:, None]
    prefix, suffix, middle = sentinels
    rows = []
    for text, draw, (low, high) in zip(texts, draws, places.tolist()):
        form = _form(text, draw, sentinels)
        if form == "plain":
            rows.append((form, None, None, text))
            continue
        a, b, c = text[:low], text[low:high], text[high:]
        output = prefix + a + suffix + c + middle + b if form == "psm" else suffix + c + prefix + a + middle + b
        rows.append((form, _length(a), _length(b), output))
    return [counts, *zip(*rows)]


def _run(batches, seed, sentinels, schema):
    types = [field.type for field in schema][1:]
    for whole in batches:
        for batch in slices(whole, 1):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = _transformed(texts, batch.column(0).to_pylist(), seed, sentinels)
            made = [pa.array(c, pa.binary()).cast(t) if t == pa.string() and c is columns[-1] else pa.array(c, t)
                    for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], schema=schema)


def transform(docs, id_column="doc_id", text_column="text", seed=SEED, sentinels=(PREFIX, SUFFIX, MIDDLE)):
    """One row per document: id, n (units), form, prefix_chars, middle_chars (NULL if plain), output."""
    from pyspark.sql.pandas.types import to_arrow_schema

    named = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()),
             ("output", T.StringType())]
    types = T.StructType([T.StructField("id", docs.select(F.col(f"`{id_column}`")).schema[0].dataType)]
                         + [T.StructField(*n) for n in named])
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    run = partial(_run, seed=seed, sentinels=tuple(s.encode() for s in sentinels), schema=to_arrow_schema(types))
    return rows.mapInArrow(run, types).withColumnRenamed("id", id_column)


def restored(output="output", form="form", sentinels=(PREFIX, SUFFIX, MIDDLE)):
    """Column: the text that an output of a form was made from."""
    import re
    parts = F.split(F.col(output), "|".join(re.escape(s) for s in sentinels))
    part = [F.get(parts, F.lit(i)) for i in range(4)]
    return (F.when(F.col(form) == "psm", F.concat(part[1], part[3], part[2]))
            .when(F.col(form) == "spm", F.concat(part[2], part[3], part[1])).otherwise(F.col(output)))
