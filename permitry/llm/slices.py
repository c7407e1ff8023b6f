"""Record batches in parts of bounded text, so that a task's arrays stay small whatever the batch."""

import numpy as np
import pyarrow as pa
import pyarrow.compute

SLICE_BYTES = 2 << 20


def slices(batch, column, size=SLICE_BYTES):
    """Parts of a record batch whose texts in ``column`` have about ``size`` bytes; a longer text is a part alone."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def gathered(batches, column, size):
    """Record batches put together as long as their texts in ``column`` have up to ``size`` bytes."""
    held, held_bytes = [], 0
    for batch in batches:
        if held and held_bytes + batch.column(column).nbytes > size:
            whole, held, held_bytes = _joined(held), [], 0
            yield whole
            del whole
        held.append(batch)
        held_bytes += batch.column(column).nbytes
    if held:
        yield _joined(held)


def _joined(batches):
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)
