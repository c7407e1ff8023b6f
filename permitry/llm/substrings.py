"""Exact substring deduplication with fixed-block anchors.

Every window of ``window`` words that also starts anywhere else, in the same document or another, is removed.

1. Index: each document is cut into non-overlapping blocks of ``(window + 1) // 2`` words. Any window holds at
   least one whole block of its own document.
2. Probe: every rolling window of block length looks for indexed blocks of equal words. A window repeated
   elsewhere holds a block of its document, and the other place holds the same words at some offset, so both
   places get a hit.
3. Extend: every whole window around a hit is compared by a 96-bit fingerprint of all its words; the union of
   the windows found twice is the set of maximal exact repeats.

Steps 2 and 3 are exchanges of fingerprints by chunks of documents (``exchange``): no pairs are formed, a
passage in a third of all documents costs one entry a chunk. The fingerprints of step 2 are shortened to
10 bits more than the corpus has words; a false hit there only makes step 3 compare a window in vain.

Defined cases: NULL text counts as empty; texts shorter than a window are returned whole; repeated rows are
places of their own, so both lose their windows; NULL ids are returned as they are; an empty table gives an
empty result. Columns other than id and text are not looked at.
"""

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm import exchange, words
from permitry.session import written

WINDOW = 35
_ALIGNED, _REPEATED = 2, 1


class _Chunk:
    """The words of a chunk as numbers, one document after the other."""

    def __init__(self, blob, numbers, window):
        self.ids, self.texts = exchange.unpacked(blob)
        self.words = [t.split() for t in self.texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.counts)
        self.window, self.block = window, (window + 1) // 2
        parts = [words.numbered(w, numbers) for w in self.words]
        self.numbers = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        # positions from which a window fits into the document
        self.left = np.repeat(self.ends, self.counts) - np.arange(len(self.numbers))
        self.long = np.repeat(self.counts >= window, self.counts)

    def block_keys(self, key_bits):
        """Distinct shortened fingerprints of block length, and for each position that has one its place there."""
        at = np.flatnonzero(self.long & (self.left >= self.block))
        prints = words.rolling(self.numbers, self.block)
        prints = prints[at] >> np.uint64(64 - key_bits) if len(at) else np.empty(0, np.uint64)
        keys, place, counts = np.unique(prints, return_inverse=True, return_counts=True)
        return at, keys, place, counts

    def block_flags(self, at, place, counts):
        flags = (counts > 1).astype(np.uint8) * _REPEATED
        starts = np.repeat(self.ends - self.counts, self.counts)[at]
        flags[place[(at - starts) % self.block == 0]] |= _ALIGNED
        return flags

    def candidates(self, hits):
        """Positions of whole windows that hold a block with a hit."""
        sums = np.concatenate(([0], np.cumsum(hits)))
        fits = np.flatnonzero(self.left >= self.window)
        return fits[sums[np.minimum(fits + self.window - self.block + 1, len(hits))] > sums[fits]]

    def window_keys(self, at):
        """Distinct 96-bit fingerprints of the windows at ``at`` in ascending order, their counts, and each one's place."""
        if not len(at):
            return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        first = words.rolling(self.numbers, self.window)[at]
        second = (words.rolling(self.numbers, self.window, 1)[at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new = np.concatenate(([True], (np.diff(a) != 0) | (np.diff(b) != 0)))
        firsts = np.flatnonzero(new)
        place = np.empty(len(at), np.int64)
        place[order] = np.cumsum(new) - 1
        return a[firsts], b[firsts], np.diff(np.append(firsts, len(a))), place


def _hit_positions(chunk, replies, bits, key_bits):
    at, keys, place, _ = chunk.block_keys(key_bits)
    hits = np.zeros(len(chunk.numbers), bool)
    hits[at] = exchange.replied(replies, keys, bits, key_bits)[place] > 0
    return hits


def _send_blocks(batches, window, bits, key_bits):
    numbers = words.Numbers()
    for batch in batches:
        for chunk_id, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist()):
            chunk = _Chunk(blob, numbers, window)
            at, keys, place, counts = chunk.block_keys(key_bits)
            yield exchange.blocks(chunk_id, keys, chunk.block_flags(at, place, counts), bits, key_bits)


def _send_windows(batches, window, bits, key_bits):
    numbers = words.Numbers()
    for batch in batches:
        for row in batch.to_pylist():
            chunk = _Chunk(row["blob"], numbers, window)
            at = chunk.candidates(_hit_positions(chunk, row["replies"], bits, key_bits))
            first, second, counts, _ = chunk.window_keys(at)
            yield exchange.blocks(row["chunk"], first, (counts > 1).astype(np.uint8), bits, more=second)


def _result(batches, window, bits, key_bits, schema, with_text):
    numbers = words.Numbers()
    for batch in batches:
        for row in batch.to_pylist():
            chunk = _Chunk(row["blob"], numbers, window)
            at = chunk.candidates(_hit_positions(chunk, row["replies"], bits, key_bits))
            first, _, _, place = chunk.window_keys(at)
            again = at[exchange.replied(row["found"], first, bits)[place] > 0]
            removed = words.covered(again, window, len(chunk.numbers))
            sums = np.concatenate(([0], np.cumsum(removed)))
            out = {"n_words": chunk.counts, "n_removed": sums[chunk.ends] - sums[chunk.ends - chunk.counts]}
            kept, runs, texts = [], [], []
            for text, own, end, gone in zip(chunk.texts, chunk.words, chunk.ends, out["n_removed"]):
                if gone:
                    mask = removed[end - len(own):end]
                    runs.append(list(map(list, zip(*(x.tolist() for x in words.spans(mask))))))
                    own = [w for w, drop in zip(own, mask.tolist()) if not drop]
                else:
                    runs.append([])
                kept.append(b" ".join(own))
                texts.append(kept[-1] if gone else text)
            out["removed_spans"] = runs
            out["kept_sha256"] = [hashlib.sha256(text).hexdigest() for text in kept]
            if with_text:
                out["kept_text"] = [text.decode() for text in texts]
            arrays = [chunk.ids] + [pa.array(out[f.name], f.type) for f in schema if f.name != schema[0].name]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def repeated_passages(docs, id_column="doc_id", text_column="text", window=WINDOW, with_text=False):
    """One row per document: id, n_words, n_removed, removed_spans (word positions, end exclusive), kept_sha256.

    ``with_text`` adds kept_text: the text as it is if nothing was removed, else the kept words joined by one space.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    packed, kind = exchange.chunks(docs, id_column, text_column)
    packed = written(packed)
    size = packed.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bits = exchange.bucket_bits(size / 6)
    key_bits = min(64, max(bits, int(np.ceil(np.log2(size / 2 + 2))) + 10))
    settings = {"window": window, "bits": bits, "key_bits": key_bits}

    sent = packed.select("chunk", "blob").mapInArrow(partial(_send_blocks, **settings), exchange.BLOCK)
    hits = written(exchange.meet(sent, lambda places, flags: (places > 1) & ((flags & _ALIGNED) > 0)))
    probed = packed.select("chunk", "blob").join(hits, "chunk")
    windows = probed.mapInArrow(partial(_send_windows, **settings), exchange.BLOCK)
    found = exchange.meet(windows, lambda places, flags: places > 1).withColumnRenamed("replies", "found")
    answers = hits.join(written(found), "chunk", "left")

    schema = pa.schema([
        ("id", to_arrow_type(kind)), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("removed_spans", pa.list_(pa.list_(pa.int64()))), ("kept_sha256", pa.string()),
        *([("kept_text", pa.string())] if with_text else []),
    ])
    types = T.StructType([
        T.StructField(id_column, kind), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed_spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("kept_sha256", T.StringType()),
        *([T.StructField("kept_text", T.StringType())] if with_text else []),
    ])
    named = pa.schema([(id_column if f.name == "id" else f.name, f.type) for f in schema])
    both = packed.select("chunk", "blob").join(answers, "chunk", "left")
    return both.mapInArrow(partial(_result, schema=named, with_text=with_text, **settings), types)


def drop_passages(docs, text_column="text", window=WINDOW):
    """All documents with all their columns, their texts without the passages that occur elsewhere."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("id")
    found = repeated_passages(docs.select(others, text_column), "id", text_column, window, with_text=True)
    return found.select(*[F.col("kept_text" if c == text_column else f"id.`{c}`").alias(c) for c in docs.columns])
