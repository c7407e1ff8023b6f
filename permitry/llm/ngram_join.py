"""Jaccard join on word n-grams with a token-group matrix; near copies as connected components of its links.

1. Shingles that occur in one document only are found by an exchange of fingerprints between chunks of
   documents (``exchange``). A document of which too few shingles occur anywhere else has no link.
2. The rest is reduced to its distinct shingle sets, so copies cost nothing further.
3. Groups: sets with the same smallest shared shingle form a group; near copies nearly always do. A large group
   is dealt into parts of about ``PART`` sets, and each part also gets the group's leaders, a few fixed
   members. Links inside a part are found exactly; labels name what is connected so far.
4. Matrix: for each token the parts whose union of prefix tokens has it, with bounds on the sizes of their sets and
   their labels. A set of n shingles needs ceil(t * n) common ones, so it and its partner share one of their
   n - ceil(t * n) + 1 rarest: two parts can only hold a link if they share a prefix token. Its shared
   shingles also bound how large the partner may be.
5. Only such pairs of parts are opened, and only if they have different labels; their overlaps are counted by a
   product of two 0/1 matrices. One link joins two labels; components of the labels give the result.

Pairs of sets are never rows of a table: a group of m near copies costs at most (m / PART) ** 2 pairs of parts, and one
of parts that are already connected costs none. Intersections are counted on 64-bit shingle fingerprints.

Defined cases: NULL and empty texts have no shingles and no link; a text with fewer words than n is one shingle;
repeated rows are linked; a NULL id never names a component unless all its ids are NULL; an empty table gives
an empty result. Columns other than id and text are not looked at.
"""

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm import exchange, words
from permitry.llm.components import components
from permitry.llm.rows import numbered
from permitry.session import written

PART = 256
LEADERS = 4
SETS_PER_TASK = 1500
PAIRS_PER_TASK = 200
#: Columns of the 0/1 matrices that are multiplied at once.
_COLUMNS = 4096


def shingles(text, n, numbers):
    """Ascending distinct fingerprints of the word n-grams of a text (bytes), A-Z in lower case."""
    found = words.numbered(text.lower().split(), numbers)
    if len(found) >= n:
        return np.unique(words.rolling(found, n))
    return words.mixed(words.rolling(found, len(found)) + np.uint64(len(found))) if len(found) else found


def needed(size, percent):
    """Common shingles that a set of this size must have with a partner."""
    return -(-percent * size // 100)


def _send(batches, n, bits, key_bits):
    numbers = words.Numbers()
    for batch in batches:
        for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist()):
            sets = [shingles(text, n, numbers) for text in exchange.unpacked(blob)[1]]
            keys, counts = np.unique(np.concatenate(sets) >> np.uint64(64 - key_bits), return_counts=True)
            yield exchange.blocks(chunk, keys, (counts > 1).astype(np.uint8), bits, key_bits)


def _sets(batches, n, percent, bits, key_bits, schema):
    """All documents with their set size; those that may have a link with their shared shingles."""
    numbers, shift = words.Numbers(), np.uint64(64 - key_bits)
    for batch in batches:
        for row in batch.to_pylist():
            ids, texts = exchange.unpacked(row["blob"])
            sets = [shingles(text, n, numbers) for text in texts]
            keys = np.unique(np.concatenate(sets) >> shift)
            codes = exchange.replied(row["replies"], keys, bits, key_bits)
            out = [], [], [], [], []
            for own in sets:
                code = codes[np.searchsorted(keys, own >> shift)]
                shared = code > 0
                linked = len(own) > 0 and np.count_nonzero(shared) >= needed(len(own), percent)
                out[0].append(len(own))
                out[1].append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if linked else None)
                out[2].append(int(own[shared][:1].view(np.int64)[0]) if linked else None)
                out[3].append(exchange.pack_sorted(own[shared]) if linked else None)
                out[4].append(exchange.squeezed(code[shared]) if linked else None)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(values, field.type) for values, field in zip(out, list(schema)[1:]))], schema=schema)


def _prefix(n, tokens, codes, percent):
    """The shared tokens among the rarest ones; unique shingles come first and need no place here."""
    size = n - needed(n, percent) + 1 - (n - len(tokens))
    return tokens[np.lexsort((tokens, codes))[:size]]


def linked(left, right, percent):
    """Matrix of links between two lists of (n, shared tokens)."""
    n, m = (np.array([size for size, _ in side])[:, None] for side in (left, right))
    s, t = (np.array([len(tokens) for _, tokens in side])[:, None] for side in (left, right))
    possible = (100 + percent) * np.minimum(s, t.T) >= percent * (n + m.T)
    rows, columns = np.flatnonzero(possible.any(1)), np.flatnonzero(possible.any(0))
    found = np.zeros(possible.shape, bool)
    if not len(rows):
        return found
    tokens = [np.concatenate([side[i][1] for i in own]) for side, own in ((left, rows), (right, columns))]
    of = [np.repeat(np.arange(len(own)), [len(side[i][1]) for i in own]) for side, own in ((left, rows), (right, columns))]
    both = np.intersect1d(np.unique(tokens[0]), np.unique(tokens[1]), assume_unique=True)
    overlap = np.zeros((len(rows), len(columns)), np.float32)
    for first in range(0, len(both), _COLUMNS):
        block = both[first:first + _COLUMNS]
        sides = []
        for own, members, count in zip(tokens, of, overlap.shape):
            at = np.minimum(np.searchsorted(block, own), len(block) - 1)
            there = block[at] == own
            sides.append(np.zeros((count, len(block)), np.float32))
            sides[-1][members[there], at[there]] = 1
        overlap += sides[0] @ sides[1].T
    enough = (100 + percent) * overlap.astype(np.int64) >= percent * (n[rows] + m[columns].T)
    found[np.ix_(rows, columns)] = enough
    return found


def _labels(links):
    """For each row of a symmetric matrix the smallest row it is connected with."""
    labels = np.full(len(links), -1)
    for i in range(len(links)):
        if labels[i] < 0:
            todo = np.array([i])
            while len(todo):
                labels[todo] = i
                todo = np.flatnonzero(links[todo].any(0) & (labels < 0))
    return labels


_MEMBERS = "key binary, copy boolean, part_id bigint, label binary, n bigint, shared bigint, prefix array<bigint>, tokens binary"


def _within_parts(table, percent):
    """Labels of the sets of some parts."""
    parts = {}
    for row in table.to_pylist():
        parts.setdefault(row["part_id"], []).append(row)
    out = []
    for rows in parts.values():
        rows.sort(key=lambda row: (not row["leader"], row["key"]))
        sets = [(row["n"], exchange.unpack_sorted(row["tokens"])) for row in rows]
        labels = _labels(linked(sets, sets, percent)) if len(sets) > 1 else [0]
        for row, (n, tokens), label in zip(rows, sets, labels):
            prefix = _prefix(n, tokens, exchange.unsqueezed(row["codes"], np.uint8), percent).view(np.int64)
            out.append({"key": row["key"], "copy": row["copy"], "part_id": row["part_id"], "label": rows[label]["key"],
                        "n": n, "shared": len(tokens), "prefix": prefix, "tokens": row["tokens"]})
    return pa.Table.from_pylist(out, pa.schema([
        ("key", pa.binary()), ("copy", pa.bool_()), ("part_id", pa.int64()), ("label", pa.binary()), ("n", pa.int64()),
        ("shared", pa.int64()), ("prefix", pa.list_(pa.int64())), ("tokens", pa.binary())]))


def _between_parts(table, percent):
    """Pairs of labels that are linked, from opened pairs of parts."""
    pairs, edges = {}, set()
    for row in table.to_pylist():
        pairs.setdefault(row["pair"], ([], []))[row["side"]].append(row)
    for sides in pairs.values():
        if all(sides):
            sets = [[(row["n"], exchange.unpack_sorted(row["tokens"])) for row in rows] for rows in sides]
            for i, j in zip(*np.nonzero(linked(*sets, percent))):
                edges.add((sides[0][i]["label"], sides[1][j]["label"]))
    edges = sorted((a, b) for a, b in edges if a != b)
    return pa.table({"a": pa.array([a for a, _ in edges], pa.binary()), "b": pa.array([b for _, b in edges], pa.binary())})


def _placed(sets):
    """Sets with their part; those of large groups also as leaders in the group's other parts."""
    leaders = [F.min(F.when(F.pmod(F.xxhash64("key"), F.lit(LEADERS)) == i, F.col("key"))) for i in range(LEADERS)]
    large = sets.groupBy("home").agg(F.count("*").alias("m"), F.array(*leaders).alias("leaders")).where(F.col("m") > PART)
    # written, so that the join has two plain sides and Spark can split the sets of a large group
    large = written(large.select("home", "leaders", F.ceil(F.col("m") / PART).cast("int").alias("parts")))
    sized = sets.join(large, "home", "left").withColumns({
        "parts": F.coalesce("parts", F.lit(1)),
        "leader": F.coalesce(F.array_contains("leaders", F.col("key")), F.lit(False))})
    own = F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int")
    everywhere = F.when(F.col("leader"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    rows = sized.select("key", "n", "tokens", "codes", "home", "leader", own.alias("own"), F.explode(everywhere).alias("part"))
    return rows.withColumns({"copy": F.col("part") != F.col("own"), "part_id": F.xxhash64("home", "part")})


def _relabelled(members, edges):
    roots = components(edges)
    named = members.join(roots, members["label"] == roots["node"], "left")
    return named.withColumn("label", F.coalesce("root", "label")).drop("node", "root")


def _in_tasks(rows, key, tasks):
    """Group ``key`` values into ``tasks`` even buckets."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(tasks)).cast("int")).groupBy("bucket")


def link_labels(sets, percent):
    """Rows (key, label) for distinct sets (key, n, tokens, codes, home): the label is the component's."""
    tasks = max(16, -(-sets.count() // SETS_PER_TASK))
    members = _in_tasks(_placed(sets), "part_id", tasks).applyInArrow(partial(_within_parts, percent=percent), _MEMBERS)
    members = written(members)
    leaders = members.where("copy").select("key").distinct()
    known = members.join(leaders, "key", "left_semi").select("key", "label")
    members = members.where("not copy")
    named = written(_relabelled(members.select("part_id", "label", "n", "shared", "prefix"), known))

    tokens = named.select(F.explode("prefix").alias("token"), "part_id", "label", "n", "shared")
    matrix = tokens.groupBy("token", "part_id").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.min("n").alias("n"), F.max("shared").alias("shared"))
    left, right = (matrix.toDF("token", *(f"{c}_{side}" for c in matrix.columns[1:])) for side in "lr")
    fits = (F.col("part_id_l") < F.col("part_id_r")) & (
        (100 + percent) * F.least("shared_l", "shared_r") >= percent * (F.col("n_l") + F.col("n_r")))
    same = (F.col("first_l") == F.col("last_l")) & (F.col("first_r") == F.col("last_r")) & (F.col("first_l") == F.col("first_r"))
    pairs = left.join(right, (left["token"] == right["token"]) & fits & ~same)
    pairs = written(pairs.select("part_id_l", "part_id_r").distinct().withColumn("pair", F.monotonically_increasing_id()))
    sides = pairs.select("pair", F.posexplode(F.array("part_id_l", "part_id_r")).alias("side", "part_id"))
    opened = sides.join(members, "part_id").select("pair", "side", "label", "n", "tokens")
    tasks = max(16, -(-pairs.count() // PAIRS_PER_TASK))
    edges = _in_tasks(opened, "pair", tasks).applyInArrow(partial(_between_parts, percent=percent), "a binary, b binary")
    return _relabelled(members.select("key", "label"), known.toDF("a", "b").unionByName(edges))


def near_copies(docs, id_column="doc_id", text_column="text", n=4, percent=85):
    """One row per document: id, n_shingles, component_id (the smallest id reachable by links)."""
    from pyspark.sql.pandas.types import to_arrow_type

    packed, kind = exchange.chunks(docs, id_column, text_column)
    packed = written(packed)
    size = packed.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bits = exchange.bucket_bits(size / 6)
    key_bits = min(64, max(bits, int(np.ceil(np.log2(size / 2 + 2))) + 10))
    settings = {"n": n, "bits": bits, "key_bits": key_bits}
    sent = packed.select("chunk", "blob").mapInArrow(partial(_send, **settings), exchange.BLOCK)
    # 0 for a unique shingle, else the class of its frequency: how often 1 doubles to reach its places
    replies = exchange.meet(sent, lambda places, flags: np.ceil(np.log2(places)))

    types = T.StructType([
        T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()),
        T.StructField("home", T.LongType()), T.StructField("tokens", T.BinaryType()), T.StructField("codes", T.BinaryType())])
    schema = pa.schema([("id", to_arrow_type(kind)), ("n", pa.int64()), ("key", pa.binary()), ("home", pa.int64()),
                        ("tokens", pa.binary()), ("codes", pa.binary())])
    both = packed.select("chunk", "blob").join(replies, "chunk", "left")
    rows = written(both.mapInArrow(partial(_sets, percent=percent, schema=schema, **settings), types))

    sets = rows.where("key is not null").groupBy("key").agg(F.max(F.struct("n", "home", "tokens", "codes")).alias("s"))
    labels = link_labels(written(sets.select("key", "s.*")), percent)

    named = rows.where("key is not null").select("id", "n", "key").join(labels, "key")
    # written, so that the join below has two plain sides and Spark can split a label that many rows have
    least = written(named.groupBy("label").agg(F.min("id").alias("component_id")))
    alone = rows.where("key is null").select("id", "n", F.col("id").alias("component_id"))
    found = named.join(least, "label").select("id", "n", "component_id").unionByName(alone)
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs, id_column="doc_id", text_column="text", n=4, percent=85):
    """The document with the smallest id of each component, with all its columns; a NULL id comes last."""
    rows, own = numbered(docs), F.col(f"doc.`{id_column}`")
    key = F.struct(F.isnull(own).alias("none"), own.alias("id"), "row").alias("key")
    found = near_copies(rows.select(key, F.col(f"doc.`{text_column}`").alias("text")), "key", "text", n, percent)
    dropped = found.where("component_id.row <> key.row").select("key.row")
    return rows.join(dropped, "row", "left_anti").select("doc.*")
