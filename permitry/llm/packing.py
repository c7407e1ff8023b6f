"""Best-fit packing of tokenised documents into sequences, planned on the length histogram.

1. Each document becomes its token ids and an end id; one longer than a sequence is cut into whole sequences with
   the shorter piece first. A task numbers its pieces of each length.
2. The histogram has at most as many rows as a sequence has tokens. Best-fit decreasing runs over these counts,
   not over documents: whole ranges of equal open sequences take one piece each. The plan is a list of runs,
   "pieces number a to b of length l go to sequences s, s + 1, ... at offset o".
3. A piece's rank within its length is its number in its task plus the pieces of that length in earlier tasks; the
   plan turns the rank into a sequence and an offset. No length, however frequent, is sorted or gathered.

The plan depends on the histogram alone, whose size is bounded by the sequence length, so it is sent to all tasks.

The vocabulary is read from a file of the ``tokenizers`` library on the driver. Byte-level BPE with merges in id
order is run by tiktoken's implementation on those ranks, which gives the same ids four times as fast; anything
else is run by ``tokenizers`` itself.

Defined cases: NULL text counts as empty; an empty text is its end id alone; repeated rows are packed each; NULL ids
are returned as they are; an empty table gives an empty result. Columns other than id and text are not looked at.
"""

import bisect
import json
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.session import written

SIZE = 1024
END = 2
#: Fixed value: how byte-level BPE splits a text before merging.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RANK_BITS = 44


def _byte_letters():
    """Letter -> byte: printable bytes stand for themselves, the others for letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _plain_byte_bpe(spec):
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
        return False
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
    return [model["vocab"][m] for m in merged] == list(range(256, 256 + len(merged)))


def encoder(text):
    """Function from a text to its ids (numpy, unsigned 32 bits), from the content of a tokenizer file."""
    spec = json.loads(text)
    if not _plain_byte_bpe(spec):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(text)
        return lambda t: np.array(tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
    import tiktoken
    letters, special = _byte_letters(), {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(map(letters.get, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda t: encoding.encode_to_numpy(t, allowed_special="all")


def cuts(length, size=SIZE):
    """Lengths of the pieces of a document of ``length`` tokens: the first may be shorter."""
    first = length % size or size
    return [first] + [size] * ((length - first) // size)


def _pieces(batches, spec, size, end, schema, with_ids):
    encode, part, seen = encoder(spec), TaskContext.get().partitionId(), [0] * (size + 1)
    for batch in batches:
        source, columns = [], [[] for _ in range(6)]
        ids_out = []
        for row, text in enumerate(batch.column(1).to_pylist()):
            ids, start = np.append(encode(text or ""), np.uint32(end)).astype("<u4"), 0
            for piece, length in enumerate(cuts(len(ids), size)):
                own = ids[start:start + length]
                source.append(row)
                for column, value in zip(columns, (piece, start, length, zlib.crc32(own.tobytes()), part, seen[length])):
                    column.append(value)
                if with_ids:
                    ids_out.append(own)
                start += length
                seen[length] += 1
        arrays = [batch.column(0).take(pa.array(source, pa.int64())), *columns]
        if with_ids:
            arrays.append(ids_out)
        yield pa.RecordBatch.from_arrays(
            [arrays[0], *(pa.array(values, field.type) for values, field in zip(arrays[1:], list(schema)[1:]))], schema=schema)


class _Open:
    """Ranges (first sequence, how many) of open sequences by the room they have left."""

    def __init__(self):
        self.rooms, self.ranges = [], {}

    def add(self, room, first, count):
        if count:
            if room not in self.ranges:
                bisect.insort(self.rooms, room)
                self.ranges[room] = []
            self.ranges[room].append((first, count))

    def tightest(self, length):
        """Take a range with the least room that is enough, as (room, first, count), or None."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, count = self.ranges[room].pop()
        if not self.ranges[room]:
            del self.ranges[room], self.rooms[at]
        return room, first, count


def plan(histogram, size=SIZE):
    """Runs (length, first rank, pieces, first sequence, offset) for a histogram {length: pieces}."""
    runs, still_open, sequences = [], _Open(), 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left and (found := still_open.tightest(length)):
            room, first, count = found
            take = min(count, left)
            runs.append((length, rank, take, first, size - room))
            still_open.add(room - length, first, take)
            still_open.add(room, first + take, count - take)
            rank, left = rank + take, left - take
        each = size // length
        for per, count in ((each, left // each), (left % each, 1)):
            if per and count:
                for slot in range(per):
                    runs.append((length, rank, count, sequences, slot * length))
                    rank += count
                still_open.add(size - per * length, sequences, count)
                sequences += count
    return [run for run in runs if run[0]]


def _placed(batches, runs, schema):
    runs = np.array(sorted(runs), np.int64).reshape(-1, 5)
    keys = (runs[:, 0] << _RANK_BITS) + runs[:, 1]
    for batch in batches:
        length, rank = batch.column("length").to_numpy(False), batch.column("rank").to_numpy(False)
        at = np.searchsorted(keys, (length << _RANK_BITS) + rank, "right") - 1
        batch = batch.drop_columns(["rank"])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(runs[at, 3] + rank - runs[at, 1]), pa.array(runs[at, 4])], schema=schema)


def pack(docs, spec, id_column="doc_id", text_column="text", size=SIZE, end=END, with_ids=False):
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset; ``with_ids`` adds its ids.

    ``spec`` is the content of a tokenizer file.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[id_column].dataType
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    long = T.LongType()
    fields = [(id_column, kind), ("piece", T.IntegerType()), ("start", long), ("length", long), ("ids_crc32", long),
              ("part", long), ("nth", long), *([("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])]
    types = T.StructType([T.StructField(*f) for f in fields])
    cut = partial(_pieces, spec=spec, size=size, end=end, schema=to_arrow_schema(types), with_ids=with_ids)
    pieces = written(picked.mapInArrow(cut, types))

    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(earlier, ["part", "length"]).select(
        *[f.name for f in types if f.name not in ("part", "nth")], (F.col("earlier") + F.col("nth")).alias("rank"))
    out = T.StructType([f for f in types if f.name not in ("part", "nth")])
    out = out.add("sequence_id", long).add("offset", long)
    return ranked.mapInArrow(partial(_placed, runs=plan(histogram, size), schema=to_arrow_schema(out)), out)


def sequences(packed):
    """Rows (sequence_id, ids) from pieces with ids; a sequence has at most as many pieces as tokens."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
