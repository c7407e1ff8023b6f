"""A learned index from rank to offset: straight pieces of bounded error, and the residuals that make it exact."""

import numpy as np

#: Residuals are kept in eight bits.
ERROR = 127
#: Ranks in the longest piece, a power of two.
LONGEST = 4096


def _fitted(block):
    """Base, slope and error at each place, of the line through the ends of each row, moved to the middle of its errors."""
    slope = (block[:, -1] - block[:, 0]) / max(1, block.shape[1] - 1)
    line = np.rint(slope[:, None] * np.arange(block.shape[1])).astype(np.int64) + block[:, :1]
    errors = block - line
    middle = (errors.max(axis=1) + errors.min(axis=1)) >> 1
    return block[:, 0] + middle, slope, errors - middle[:, None]


class RankIndex:
    """Ascending offsets, added in parts; ``offsets(ranks)`` gives them back exactly.

    A piece starts as ``LONGEST`` ranks and is halved until no error exceeds ``ERROR``; a single rank has none. Kept are
    one byte a rank and three numbers a piece, whatever the length of the text.
    """

    def __init__(self):
        self.size = 0
        self._starts, self._bases, self._slopes, self._residuals = [], [], [], []
        self._left = np.empty(0, np.int64)

    def add(self, offsets):
        offsets = np.concatenate([self._left, offsets])
        whole = len(offsets) // LONGEST * LONGEST
        self._fit(offsets[:whole], LONGEST)
        self._left = offsets[whole:]

    def close(self):
        """Fit what is left and make the index ready."""
        at = 0
        width = LONGEST
        while width:
            if len(self._left) - at >= width:
                self._fit(self._left[at:at + width], width)
                at += width
            else:
                width >>= 1
        order = np.argsort(np.concatenate(self._starts)) if self._starts else np.empty(0, np.int64)
        self.starts, self.bases, self.slopes = (
            np.concatenate(part)[order] if part else np.empty(0) for part in (self._starts, self._bases, self._slopes))
        self.residuals = np.concatenate(self._residuals) if self._residuals else np.empty(0, np.int8)
        self._starts = self._bases = self._slopes = self._residuals = self._left = None
        return self

    def _fit(self, offsets, width):
        if not len(offsets):
            return
        residuals = np.zeros(len(offsets), np.int8)
        starts = np.arange(0, len(offsets), width)
        while len(starts):
            block = offsets[starts[:, None] + np.arange(width)]
            bases, slopes, errors = _fitted(block)
            good = np.abs(errors).max(axis=1) <= ERROR
            self._starts.append(self.size + starts[good])
            self._bases.append(bases[good])
            self._slopes.append(slopes[good])
            residuals[starts[good][:, None] + np.arange(width)] = errors[good]
            width >>= 1
            starts = (starts[~good][:, None] + np.array([0, width])).ravel()
        self._residuals.append(residuals)
        self.size += len(offsets)

    def offsets(self, ranks):
        """The prediction of each rank's piece, corrected by its residual."""
        piece = np.searchsorted(self.starts, ranks, side="right") - 1
        predicted = self.bases[piece] + np.rint(self.slopes[piece] * (ranks - self.starts[piece])).astype(np.int64)
        return predicted + self.residuals[ranks]
