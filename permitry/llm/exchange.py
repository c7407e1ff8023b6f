"""Find out which fingerprints occur in several places without moving rows of single fingerprints.

Documents are packed into chunks of a few MB. A chunk sends each of its distinct fingerprints once, sorted and
delta-coded, in one block for each bucket of the fingerprint range. The task of a bucket sees the blocks of all
chunks, decides about every fingerprint, and answers each block with one byte for each fingerprint in the
block's own order. So a fingerprint in a third of all documents costs one entry a chunk, all buckets are even,
nothing is paired, and nothing reaches the driver.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20
BUCKET_ENTRIES = 1 << 21


def squeezed(array):
    """Bytes of a numpy array, compressed, with the length in front."""
    raw = np.ascontiguousarray(array).tobytes()
    return len(raw).to_bytes(8, "little") + _codec().compress(raw, asbytes=True)


def unsqueezed(data, kind):
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(_codec().decompress(data[8:], size, asbytes=True), kind)


def _codec():
    return pa.Codec("zstd", compression_level=1)


def pack_sorted(values):
    """Ascending 64-bit numbers as differences, byte by byte: the empty high bytes compress away."""
    steps = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return squeezed(steps.T)


def unpack_sorted(data):
    planes = unsqueezed(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def chunks(docs, id_column="doc_id", text_column="text", size=CHUNK_BYTES):
    """Rows (chunk, docs, bytes, blob): ids and texts of some documents as a compressed Arrow table.

    Ids and texts may be NULL. A chunk closes when its texts reach ``size`` bytes, so only a single longer text
    makes a larger one.
    """
    kind = docs.schema[id_column].dataType
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def pack(batches):
        part, made, held, size_held = TaskContext.get().partitionId(), 0, [], 0

        def close():
            nonlocal made, held, size_held
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=_codec())
            with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                out.write_table(table)
            row = [[(part << 32) | made], [table.num_rows], [size_held], [sink.getvalue().to_pybytes()]]
            made, held, size_held = made + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["chunk", "docs", "bytes", "blob"])

        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy(False)
            first = 0
            for i, length in enumerate(lengths):
                size_held += int(length)
                if size_held >= size:
                    held.append(batch.slice(first, i + 1 - first))
                    first = i + 1
                    yield close()
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield close()

    rows = picked.mapInArrow(pack, "chunk bigint, docs bigint, bytes bigint, blob binary")
    return rows, kind


def unpacked(blob):
    """Ids (an Arrow array) and texts (a list of bytes, NULL as empty) of a chunk."""
    table = pa.ipc.open_stream(blob).read_all().combine_chunks()
    texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
    return table.column("id").combine_chunks(), texts


def bucket_bits(entries):
    """Bits of a bucket number so that a bucket holds about ``BUCKET_ENTRIES`` of ``entries``; 16 buckets at least."""
    return max(4, int(np.ceil(np.log2(max(1, entries) / BUCKET_ENTRIES))))


BLOCK = "bucket int, chunk bigint, keys binary, more binary, flags binary"


def blocks(chunk, keys, flags, bits, key_bits=64, more=None):
    """Record batch of the blocks of one chunk; ``keys`` ascending, ``more`` further 32 bits of each key."""
    edges = bounds(keys, bits, key_bits)
    rows = [(b, edges[b], edges[b + 1]) for b in range(1 << bits) if edges[b] < edges[b + 1]]
    return pa.RecordBatch.from_arrays([
        pa.array([b for b, _, _ in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()),
        pa.array([pack_sorted(keys[i:j]) for _, i, j in rows], pa.binary()),
        pa.array([squeezed(more[i:j]) if more is not None else None for _, i, j in rows], pa.binary()),
        pa.array([squeezed(flags[i:j]) for _, i, j in rows], pa.binary()),
    ], ["bucket", "chunk", "keys", "more", "flags"])


def bounds(keys, bits, key_bits=64):
    """Where each bucket begins in ascending ``keys`` of ``key_bits`` bits."""
    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(key_bits - bits)
    return np.append(np.searchsorted(keys, firsts), len(keys))


def meet(sent, decide):
    """Answers (chunk, replies) to blocks: ``decide(places, flags)`` for every distinct key.

    ``places`` counts the blocks that hold the key, and once more each block whose flag 1 is set (the chunk has
    it several times); ``flags`` is the union of the flags. The decision is a byte; blocks of which all keys get
    0 are not answered.
    """
    def answer(table):
        chunk_ids = table.column("chunk").to_numpy()
        keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
        flags = np.concatenate([unsqueezed(f, np.uint8) for f in table.column("flags").to_pylist()])
        sizes = np.array([len(k) for k in keys])
        keys = np.concatenate(keys)
        more = table.column("more").to_pylist()
        if more[0] is None:
            order = np.argsort(keys)
            change = np.diff(keys[order]) != 0
        else:
            more = np.concatenate([unsqueezed(m, np.uint32) for m in more])
            order = np.lexsort((more, keys))
            change = (np.diff(keys[order]) != 0) | (np.diff(more[order]) != 0)
        firsts = np.flatnonzero(np.concatenate(([True], change)))
        seen = flags[order]
        places = np.add.reduceat(1 + (seen & 1).astype(np.int64), firsts)
        decided = decide(places, np.bitwise_or.reduceat(seen, firsts)).astype(np.uint8)
        reply = np.empty(len(keys), np.uint8)
        reply[order] = np.repeat(decided, np.diff(np.append(firsts, len(keys))))
        ends = np.cumsum(sizes)
        rows = [(int(c), int(b), squeezed(reply[e - n:e]))
                for c, b, e, n in zip(chunk_ids, table.column("bucket").to_numpy(), ends, sizes) if reply[e - n:e].any()]
        return pa.table({
            "chunk": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([r[1] for r in rows], pa.int32()),
            "reply": pa.array([r[2] for r in rows], pa.binary())})

    answers = sent.groupBy("bucket").applyInArrow(answer, "chunk bigint, bucket int, reply binary")
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "reply")).alias("replies"))


def replied(replies, keys, bits, key_bits=64):
    """The decision for each of ascending ``keys`` from the answers a chunk got (None: no answer at all)."""
    codes = np.zeros(len(keys), np.uint8)
    edges = bounds(keys, bits, key_bits)
    for answer in replies or ():
        codes[edges[answer["bucket"]]:edges[answer["bucket"] + 1]] = unsqueezed(answer["reply"], np.uint8)
    return codes
