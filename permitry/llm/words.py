"""Words of a text as 64-bit numbers, and rolling fingerprints of runs of words, in numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text, which is what
``bytes.split()`` returns. Its number is the xxHash of its bytes.
"""

import numpy as np
import xxhash

KNOWN_WORDS = 100_000
_MASK = (1 << 64) - 1
#: Odd bases of the two fingerprints; B ** d - 1 has few factors of two for any distance d.
BASES = (0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4B | 5)


class Numbers(dict):
    """Word -> number; forgets all words when it holds ``KNOWN_WORDS``."""

    def __missing__(self, word):
        if len(self) >= KNOWN_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


def numbered(words, numbers):
    """Array of the numbers of a list of words."""
    return np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))


def mixed(values):
    """Every bit of the result depends on every bit of the value (a bijection of 64-bit numbers)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def powers(base, count):
    """The first ``count`` powers of a base, from its power 0."""
    found = np.full(count, base, np.uint64)
    if count:
        found[0] = 1
    return np.multiply.accumulate(found)


def rolling(numbers, width, lane=0):
    """Fingerprint of the ``width`` numbers from each position; one less for each position than fits."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = BASES[lane]
    source = mixed(numbers ^ np.uint64(BASES[1])) if lane else numbers
    sums = np.zeros(len(numbers) + 1, np.uint64)
    np.cumsum(source * powers(base, len(numbers)), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return mixed((sums[width:] - sums[:n]) * powers(inverse, n))


def covered(starts, width, length):
    """Mask of ``length`` positions that lie in a window of ``width`` from one of ``starts``."""
    steps = np.zeros(length + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, length), -1)
    return np.cumsum(steps[:-1]) > 0


def spans(mask):
    """Maximal runs of true as two arrays, starts and ends."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]
