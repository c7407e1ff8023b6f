"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

Encoding is a best path: pieces are arcs between places of the normalised text. For a unigram model an arc weighs its
score. For a BPE model a sequence of pieces is the encoding exactly if every two neighbours, encoded together, stay as
they are; so arcs weigh zero, and neighbours that would merge may not follow each other. Both are max-plus paths whose
state is the last piece.

1. A giant document is split into chunks of fixed length. The state at an edge is the piece that ends at or reaches
   over it.
2. Each chunk, alone, gives its transfer matrix: the weight of the best way from every state at its left edge to
   every state at its right edge. At a place that no piece can cross (before a space that follows something else) all
   states are one, so such a chunk only walks to the first and from the last of these places; a chunk without them,
   as in scripts without spaces, is walked whole.
3. The max-plus product is associative: runs of ``FAN`` matrices are multiplied into one, independently of each other,
   runs of those into one again, until a document has at most ``FAN``. Their best states give each run its own first
   and last state, from which it finds the states between its parts, alone again, down to the chunks. No task holds
   more than ``FAN`` matrices of a document for each step.
4. Each chunk, alone, writes its pieces between its two states; what lies between places that no piece can cross is
   encoded by the SentencePiece library, as are all documents of up to one chunk.

The ids are those of the library for the whole text. The model is a parameter, read on the driver and sent to the tasks.

Defined cases: NULL counts as empty; empty texts have no ids; repeated rows are encoded each; NULL ids of documents are
returned as they are; an empty table gives an empty result. Columns other than id and text are not looked at. Models
without byte fallback are refused, as their texts cannot be restored.
"""

import re
import zlib
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm.slices import slices
from permitry.session import written

CHUNK = 1 << 14
#: Matrices that are multiplied in one step.
FAN = 16
_SPACE = "▁"
_EDGE = re.compile(f"(?<=[^{_SPACE}]){_SPACE}")
_START = -1
_LONGEST = 64
_CACHED = 100_000


class Pieces:
    """A model and the lattice of its pieces."""

    def __init__(self, model):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        if not spec.trainer_spec.byte_fallback or spec.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models with byte fallback can be used")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.unigram = spec.trainer_spec.model_type == 1
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        self.scores = {p.piece: p.score for p in spec.pieces if p.type in (1, 4, 5)}
        self.numbers = {p.piece: i for i, p in enumerate(spec.pieces) if p.type in (1, 4, 5)}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == 6}
        self.longest = max(map(len, self.scores))
        if self.longest >= _LONGEST:
            raise ValueError(f"pieces of {_LONGEST} characters or more are not supported")
        self.unknown = min(self.scores.values()) - 10
        self.can_split = not any(_EDGE.search(p) for p in self.scores)
        self.whole, self.follows = {}, {}
        self.back = {i: p.replace(_SPACE, " ").encode() for p, i in self.numbers.items()}
        self.back |= {i: bytes([b]) for b, i in self.bytes.items()}

    def merged(self, text):
        """The BPE pieces of a short text."""
        parts = list(text)
        while True:
            best = max(((self.scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores),
                       default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def weight(self, piece):
        """Weight of an arc, None if there is no such arc."""
        if piece not in self.scores:
            return (self.unknown if self.unigram else 0.0) if len(piece) == 1 else None
        if self.unigram:
            return self.scores[piece]
        if piece not in self.whole:
            self.whole[piece] = self.merged(piece) == [piece]
        return 0.0 if self.whole[piece] else None

    def may_follow(self, piece, after):
        if self.unigram or piece is None:
            return True
        if (piece, after) not in self.follows:
            if len(self.follows) > _CACHED:
                self.follows.clear()
            self.follows[piece, after] = self.merged(piece + after) == [piece, after]
        return self.follows[piece, after]

    def arcs(self, text, at):
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            weight = self.weight(text[at:end])
            if weight is not None:
                yield text[at:end], end, weight

    def walk(self, text, reached, stop):
        """Best ways on from ``reached`` {end: {piece: (weight, where from)}} with arcs that start before ``stop``.

        A weight is a number, or an array with one number for each entry.
        """
        for at in range(min(reached), stop):
            if at not in reached:
                continue
            for piece, end, weight in self.arcs(text, at):
                best = None
                for last, (so_far, _) in reached[at].items():
                    if self.may_follow(last, piece):
                        if best is None:
                            best = so_far, last
                        elif isinstance(so_far, np.ndarray):
                            best = np.maximum(best[0], so_far), last
                        elif so_far > best[0]:
                            best = so_far, last
                if best is not None:
                    reached.setdefault(end, {})[piece] = best[0] + weight, best[1]
        return reached

    def splits(self, text, first, last):
        """First and last place in [first, last] that no piece crosses, or None."""
        if not self.can_split:
            return None
        found = _EDGE.search(text, max(first, 1), last + 1)
        if found is None:
            return None
        place = text.rfind(_SPACE, found.start(), last + 1)
        while place > found.start() and text[place - 1] == _SPACE:
            place -= 1
        return found.start(), place

    def states(self, text, edge):
        """States at an edge: pieces that start before it and end at or after it, as offset of the end and length."""
        return [(end - edge) * _LONGEST + end - start for start in range(max(0, edge - self.longest), edge)
                for _, end, _ in self.arcs(text, start) if end >= edge]

    def piece_at(self, text, edge, state):
        end = edge + state // _LONGEST
        return text[end - state % _LONGEST:end], end

    def transfer(self, text, edge, stop, first, last):
        """(entries, exits, matrix) of the chunk [edge, stop) of ``text``, which has context on both sides."""
        entries = [_START] if first else self.states(text, edge)
        reached = {}
        for i, state in enumerate(entries):
            piece, end = (None, edge) if first else self.piece_at(text, edge, state)
            own = np.full(len(entries), -np.inf)
            own[i] = 0
            reached.setdefault(end, {})[piece] = own, None
        split = self.splits(text, edge + self.longest, stop - 1)
        if split:
            ways = self.walk(text, reached, split[0])
            head = np.max([w for w, _ in ways[split[0]].values()], axis=0) if split[0] in ways else np.full(len(entries), -np.inf)
            reached = self.walk(text, {split[1]: {None: (0.0, None)}}, stop)
        else:
            reached = self.walk(text, reached, stop)
        exits, columns = [], []
        for end, pieces in reached.items():
            if end >= stop and (not last or end == stop):
                for piece, (weight, _) in pieces.items():
                    if piece is not None and end - len(piece) < stop:
                        exits.append((end - stop) * _LONGEST + len(piece))
                        columns.append(head + weight if split else weight)
        return entries, exits, np.array(columns).T.reshape(len(entries), len(exits))

    def _path(self, text, piece, at, stop, goal=None):
        """Pieces from state (piece, at) to a cut at ``stop``, or to the arc ``goal`` (piece, end) that starts before it."""
        reached = self.walk(text, {at: {piece: (0.0, None)}}, stop)
        if goal is None:
            end, own = stop, max(reached[stop], key=lambda p: reached[stop][p][0])
        else:
            own, end = goal
        path = []
        while (own, end) != (piece, at):
            path.append(own)
            own, end = reached[end][own][1], end - len(own)
        return path[::-1]

    def ids(self, pieces):
        found = []
        for piece in pieces:
            number = self.numbers.get(piece)
            found += [number] if number is not None else [self.bytes[b] for b in piece.encode()]
        return found

    def between(self, text, edge, stop, entry, leaving):
        """Ids of the pieces that start in the chunk [edge, stop), given the states at its edges."""
        piece, at = (None, edge) if entry == _START else self.piece_at(text, edge, entry)
        goal = self.piece_at(text, stop, leaving)
        split = self.splits(text, at, goal[1] - len(goal[0]))
        if not split or split[0] == split[1]:
            return self.ids(self._path(text, piece, at, stop, goal))
        inner = text[split[0]:split[1]].replace(_SPACE, " ")
        head = self._path(text, piece, at, split[0]) if split[0] > at else []
        tail = self._path(text, None, split[1], stop, goal)
        return [*self.ids(head), *self.library.encode(inner[1:] if self.prefix else inner), *self.ids(tail)]

    def decoded(self, ids):
        text = b"".join(map(self.back.get, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _aligned(matrix, exits, entries):
    """The columns of a matrix by the states its right neighbour begins with."""
    column = {state: i for i, state in enumerate(exits)}
    found = np.full((len(matrix), len(entries)), -np.inf)
    for j, state in enumerate(entries):
        if state in column:
            found[:, j] = matrix[:, column[state]]
    return found


def product(left, right):
    """Max-plus product of two neighbouring (entries, exits, matrix)."""
    first = _aligned(left[2], left[1], right[0])
    best = np.full((len(left[0]), len(right[1])), -np.inf)
    for k in range(len(right[0])):
        np.maximum(best, first[:, k, None] + right[2][k], out=best)
    return left[0], right[1], best


def best_states(tables, entry=_START, leaving=None):
    """Entry and exit state of each of some neighbouring (entries, exits, matrix), from ``entry`` to ``leaving``.

    Without ``leaving`` the best way ends where it likes.
    """
    so_far, ways, before = None, [], None
    for entries, exits, matrix in tables:
        if so_far is None:
            so_far = np.where(np.array(entries) == entry, 0.0, -np.inf)
        else:
            so_far = _aligned(so_far[None, :], before, entries)[0]
        total = so_far[:, None] + matrix
        ways.append((entries, exits, np.argmax(total, axis=0)))
        so_far, before = np.max(total, axis=0), exits
    if leaving is None:
        leaving = before[int(np.argmax(so_far))]
    found = []
    for entries, exits, way in reversed(ways):
        first = entries[way[exits.index(leaving)]]
        found.append((first, leaving))
        leaving = first
    return found[::-1]


def _digest(pieces, text, ids):
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), zlib.crc32(raw), pieces.decoded(ids) == text, ids


def _short(batches, model, schema, with_ids):
    pieces = Pieces(model)
    for whole in batches:
        for batch in slices(whole, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            columns = zip(*[_digest(pieces, t, pieces.library.encode(t)) for t in texts])
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=schema)


_CHUNKS = "doc bigint, chunk int, last boolean, edge int, stop int, text string"


def _split(batches, model, size):
    """Chunks of the normalised texts, with as much context on both sides as a piece may reach."""
    pieces = Pieces(model)
    for whole in batches:
        for batch in slices(whole, 1):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = pieces.library.normalize(text)
                count = max(1, len(text) // size)
                for chunk in range(count):
                    edge, stop = chunk * size, len(text) if chunk == count - 1 else (chunk + 1) * size
                    left = max(0, edge - pieces.longest)
                    rows.append((doc, chunk, chunk == count - 1, edge - left, stop - left, text[left:stop + pieces.longest]))
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.string())
            names = ["doc", "chunk", "last", "edge", "stop", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


_MATRIX = "doc bigint, chunk int, entries array<int>, exits array<int>, matrix array<double>"


def _matrix_rows(kind, rows):
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()))
    return kind.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc", "chunk", "entries", "exits", "matrix"])


def _transfers(batches, model):
    pieces = Pieces(model)
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            entries, exits, matrix = pieces.transfer(row["text"], row["edge"], row["stop"], row["chunk"] == 0, row["last"])
            rows.append((row["doc"], row["chunk"], entries, exits, matrix.ravel()))
        yield _matrix_rows(pa.RecordBatch, rows)


def _runs(table):
    """Rows of each run of neighbouring matrices, in order."""
    runs = {}
    for row in table.to_pylist():
        runs.setdefault((row["doc"], row["run"]), []).append(row)
    for run, rows in runs.items():
        rows.sort(key=lambda r: r["chunk"])
        yield run, rows, [(r["entries"], r["exits"], np.array(r["matrix"]).reshape(len(r["entries"]), -1)) for r in rows]


def _products(table):
    """One matrix for each run."""
    out = []
    for (doc, run), _, tables in _runs(table):
        entries, exits, matrix = reduce(product, tables)
        out.append((doc, run, entries, exits, matrix.ravel()))
    return _matrix_rows(pa.Table, out)


_STATES = "doc bigint, chunk int, entry int, leaving int"


def _states(table):
    """States at the edges of the parts of each run, whose own first and last state are known or free."""
    out = []
    for (doc, _), rows, tables in _runs(table):
        states = best_states(tables, rows[0]["entry"], rows[0]["leaving"])
        out += [(doc, r["chunk"], *edges) for r, edges in zip(rows, states)]
    kinds, names = (pa.int64(), pa.int32(), pa.int32(), pa.int32()), ["doc", "chunk", "entry", "leaving"]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _by_run(rows, count, function, types):
    """Apply a function to runs of ``FAN`` rows; small runs share a group."""
    bucket = F.pmod(F.xxhash64("doc", "run"), F.lit(max(16, count // 2000))).alias("bucket")
    return rows.groupBy(bucket).applyInArrow(function, types)


def _edge_states(matrices, count, longest):
    """Rows (doc, chunk, entry, leaving) of all chunks; ``longest`` is the number of chunks of the longest document."""
    levels, run = [matrices], F.expr(f"chunk div {FAN}").cast("int")
    while longest > FAN:
        levels.append(written(_by_run(levels[-1].withColumn("run", run), count, _products, _MATRIX)))
        longest, count = -(-longest // FAN), -(-count // FAN)
    free = F.lit(_START).alias("entry"), F.lit(None).cast("int").alias("leaving")
    top = levels.pop().select("*", *free, F.lit(0).alias("run"))
    states = _by_run(top, count, _states, _STATES)
    while levels:
        count *= FAN
        known = states.withColumnRenamed("chunk", "run")
        states = _by_run(levels.pop().withColumn("run", run).join(known, ["doc", "run"]), count, _states, _STATES)
    return states


def _written_out(batches, model):
    pieces = Pieces(model)
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ids = pieces.between(r["text"], r["edge"], r["stop"], r["entry"], r["leaving"])
            out.append((r["doc"], r["chunk"], np.array(ids, "<u4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))], ["doc", "chunk", "ids"])


def _joined(batches, model, schema):
    """Documents from their id blocks."""
    pieces = Pieces(model)
    for batch in batches:
        texts = batch.column(1).to_pylist()
        blocks = [b"".join(part["ids"] for part in sorted(parts, key=lambda p: p["chunk"])) for parts in batch.column(2).to_pylist()]
        columns = zip(*[_digest(pieces, t, np.frombuffer(b, "<u4").tolist()) for t, b in zip(texts, blocks)])
        arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=schema)


def encode(docs, model, id_column="doc_id", text_column="text", size=CHUNK, with_ids=True):
    """One row per document: id, n_ids, ids_crc32, restored (decoding gives the text again), and the ids.

    ``model`` is the content of a model file. Documents longer than two chunks are scanned in parallel.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    types = T.StructType([docs.schema[id_column], T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                          T.StructField("restored", T.BooleanType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if not with_ids:
        types = T.StructType(types.fields[:-1])
    schema = to_arrow_schema(types)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    short = rows.where(F.length("text") < 2 * size).mapInArrow(
        partial(_short, model=model, schema=schema, with_ids=with_ids), types)

    giant = rows.where(F.length("text") >= 2 * size).select(F.monotonically_increasing_id().alias("doc"), "id", "text")
    giant = written(giant)
    chunks = written(giant.select("doc", "text").mapInArrow(partial(_split, model=model, size=size), _CHUNKS))
    matrices = written(chunks.mapInArrow(partial(_transfers, model=model), _MATRIX))
    count, last = chunks.agg(F.count("*"), F.max("chunk")).first()
    states = _edge_states(matrices, count, (last or 0) + 1)
    blocks = chunks.join(states, ["doc", "chunk"]).mapInArrow(partial(_written_out, model=model), "doc bigint, chunk int, ids binary")
    whole = blocks.groupBy("doc").agg(F.collect_list(F.struct("chunk", "ids")).alias("parts"))
    found = giant.join(whole, "doc").select("id", "text", "parts")
    return short.unionByName(found.mapInArrow(partial(_joined, model=model, schema=schema), types))


def _decode(batches, model, schema):
    pieces = Pieces(model)
    for batch in batches:
        texts = [pieces.decoded(ids or ()) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=schema)


def decode(encoded, model, id_column="doc_id", ids_column="ids"):
    """Rows (id, text) from ids; NULL ids give an empty text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = T.StructType([encoded.schema[id_column], T.StructField("text", T.StringType())])
    return encoded.select(id_column, ids_column).mapInArrow(partial(_decode, model=model, schema=to_arrow_schema(types)), types)
