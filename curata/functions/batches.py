"""Arrow batches in parts of bounded bytes, for per-row Python over wide rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text turned into Python strings at once.
PART_BYTES = 1 << 20


def parts(texts: pa.Array, size: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive rows with about ``size`` bytes of text; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    lo = 0
    while lo < len(ends):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield lo, hi
        lo = hi
