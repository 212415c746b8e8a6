"""A learned rank index: from the rank of a boundary to its offset, by error-bounded lines and stored residuals."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class RankIndex(NamedTuple):
    """Lines over ranks and, for every rank, what its line misses the offset by."""

    first: np.ndarray  # first rank of each segment
    base: np.ndarray  # offset at that rank
    slope: np.ndarray  # offsets per rank
    residual: np.ndarray  # one byte per rank where max_error allows

    def offset(self, rank: int) -> int:
        """The exact offset of a boundary: the line's prediction, corrected."""
        k = int(np.searchsorted(self.first, rank, side="right")) - 1
        return int(np.floor(self.base[k] + self.slope[k] * (rank - self.first[k]))) + int(self.residual[rank])


def fit(offsets: np.ndarray, max_error: int) -> RankIndex:
    """Fits ascending offsets (rank 0, 1, ...), one at least, with lines that miss none by more than ``max_error``.

    A segment starts at a point and takes further points as long as one slope through its start meets all of them
    within the bound (a cone that narrows). The cone is computed over a window that doubles until it closes, so the
    work is proportional to the number of offsets whatever the length of the segments.
    """
    first, base, slopes = [], [], []
    start, n = 0, len(offsets)
    while start < n:
        window = 32
        while True:
            y = offsets[start + 1:start + window] - offsets[start]
            x = np.arange(1, len(y) + 1)
            high = np.minimum.accumulate((y + max_error) / x)
            low = np.maximum.accumulate((y - max_error) / x)
            closed = np.flatnonzero(high < low)
            if len(closed) or start + window >= n:
                break
            window *= 2
        taken = int(closed[0]) if len(closed) else len(y)
        first.append(start)
        base.append(offsets[start])
        slopes.append((high[taken - 1] + low[taken - 1]) / 2 if taken else 0.0)
        start += taken + 1
    first, base, slope = np.array(first), np.array(base), np.array(slopes)
    line = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    predicted = np.floor(base[line] + slope[line] * (np.arange(n) - first[line])).astype(np.int64)
    residual = (offsets - predicted).astype(np.int8 if max_error < 126 else np.int64)
    return RankIndex(first, base, slope, residual)
