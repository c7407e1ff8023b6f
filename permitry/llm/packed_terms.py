"""Terms of texts counted in numpy: short ones packed into one or two 64-bit words, long ones sorted by bytes.

A term is a maximal run of ASCII letters and of code points from U+0080 on, A-Z in lower case. Terms go into buckets by
length: up to 8 bytes (in two buckets) are one word, up to 16 two, with the first byte highest, so that numbers are in the
order of bytes; they are sorted by radix, digit by digit. Longer terms have a bucket for each length and are sorted as
bytes. Equal terms then follow each other and are counted by runs. One bucket is held at a time, with places of 32 bits.
"""

import numpy as np

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[97:123] = _TERM[128:] = True
_WORD = 8
#: Lengths that are packed and sorted together; longer terms by bytes.
_BUCKETS = ((1, 4), (5, 8), (9, 16))
#: Terms packed, or bytes looked at, at once.
_PART = 1 << 16


def _place(size):
    """The kind of whole numbers that hold places of as many bytes."""
    return np.int32 if size < 2 ** 31 else np.int64


def _order(words):
    """Stable order of 64-bit numbers, by least significant digits of 16 bits; a digit that all share is passed over."""
    order, digits = None, words.astype("<u8", copy=False).view("<u2").reshape(-1, 4)
    for digit in range(4):
        values = digits[:, digit]
        if len(values) and (values != values[0]).any():
            step = np.argsort(values if order is None else values[order], kind="stable").astype(_place(len(values)))
            order = step if order is None else order[step]
    return np.arange(len(words), dtype=_place(len(words))) if order is None else order


def _packed(data, starts, lengths, word):
    """Eight bytes of each term, or as many as it has, from its ``word``-th eight on as one number.

    ``data`` ends in eight bytes more than any term. Terms are looked at in parts, as each step is an array of its own.
    """
    views = np.ndarray((len(data) - _WORD + 1,), ">u8", data, strides=(1,))
    found = np.empty(len(starts), np.uint64)
    for first in range(0, len(starts), _PART):
        part = slice(first, first + _PART)
        used = np.minimum(lengths[part] - _WORD * word, _WORD)
        keep = ~np.uint64(0) << (np.uint64(8) * (_WORD - used).astype(np.uint64))
        found[part] = views[starts[part] + _WORD * word].astype(np.uint64) & keep
    return found


def _runs(changes, documents):
    """First place, number of places and number of documents of each run; ``changes`` marks places unlike the one before."""
    first = np.flatnonzero(changes)
    new = changes.copy()
    new[1:] |= documents[1:] != documents[:-1]
    return first, np.diff(first, append=len(changes)), np.add.reduceat(new, first, dtype=np.int64) if len(first) else first


def _changes(data, kind):
    """Places at which terms start and end, in turn; the last byte is in no term."""
    found, last = [], np.zeros(1, bool)
    for first in range(0, len(data), _PART):
        inside = np.concatenate([last, _TERM[data[first:first + _PART]]])
        found.append((np.flatnonzero(inside[1:] != inside[:-1]) + first).astype(kind))
        last = inside[-1:]
    return np.concatenate(found)


def _unlike(*columns):
    """Places that differ from the one before in a column."""
    changes = np.ones(len(columns[0]), bool)
    changes[1:] = False
    for column in columns:
        changes[1:] |= column[1:] != column[:-1]
    return changes


def _bytes_of(words):
    """Lengths and joined bytes of packed terms, one row of words for each."""
    cells = words.astype(">u8").view(np.uint8).reshape(len(words), words.size // max(1, len(words)) * _WORD)
    used = cells != 0
    return used.sum(axis=1), cells[used]


def counted(data, documents, groups):
    """Count the terms of texts in ``data``, bytes in which a zero byte follows each text.

    ``documents`` are the ends of the texts, ascending, and ``groups`` their groups, ascending too. Yields for each bucket
    (lengths, joined bytes, group, count, number of documents) with one entry for each term and group.
    """
    data = np.concatenate([_FOLD[data], np.zeros(2 * _WORD, np.uint8)])
    kind = _place(len(data))
    places = _changes(data, kind)
    starts, lengths = places[::2].copy(), places[1::2] - places[::2]
    del places
    # how many terms start before the end of each text
    before = np.concatenate([[0], np.searchsorted(starts, documents)])
    document = np.repeat(np.arange(len(documents), dtype=_place(len(documents))), np.diff(before))
    for least, most in _BUCKETS:
        at = np.flatnonzero((lengths >= least) & (lengths <= most)).astype(kind)
        columns = [_packed(data, starts[at], lengths[at], i) for i in range(-(-most // _WORD))]
        order = np.arange(len(at), dtype=kind)
        for column in reversed(columns):
            order = order[_order(column[order])]
        columns, at = [c[order] for c in columns], at[order]
        del order, column
        yield _entries(_bytes_of, columns, document[at], groups)
        del columns, at
    long = np.flatnonzero(lengths > _BUCKETS[-1][1]).astype(kind)
    long = long[np.argsort(lengths[long], kind="stable")]
    for at in np.split(long, np.flatnonzero(np.diff(lengths[long])) + 1):
        if len(at):
            size = int(lengths[at[0]])
            terms = np.ndarray((len(data) - size + 1,), f"S{size}", data, strides=(1,))[starts[at]]
            order = np.argsort(terms, kind="stable")
            yield _entries(lambda t, size=size: (np.full(len(t), size), np.frombuffer(t.tobytes(), np.uint8)),
                           [terms[order]], document[at[order]], groups)


def _entries(bytes_of, columns, document, groups):
    """Runs of equal terms within a group; terms are in order and, for one term, documents and so groups too."""
    group = groups[document]
    first, counts, documents = _runs(_unlike(*columns, group), document)
    picked = [c[first] for c in columns]
    return (*bytes_of(picked[0] if len(picked) == 1 else np.stack(picked, axis=1)), group[first], counts, documents)
