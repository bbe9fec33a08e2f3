"""Arrow batches cut by the bytes of their texts, so that what a task unpacks at once is bounded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batches, at: int, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batches`` whose column ``at`` holds about ``size`` bytes; a longer text is alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = ends[start] - lengths[start]
            end = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, end - start)
            start = end
