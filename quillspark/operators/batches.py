"""Arrow batches in parts whose texts are bounded, so that a task's Python objects don't grow with its batches."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of text of which a task makes Python objects at a time; a longer text is a part of its own.
PART_BYTES = 2_000_000


def bounded(batches, column: str, most: int = PART_BYTES) -> Iterator:
    """The batches in slices, in order, of rows whose texts are at most so many bytes together; an empty batch is one slice."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first, n = 0, batch.num_rows
        while first < n or n == 0:
            before = ends[first - 1] if first else 0
            after = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(first, after - first)
            first = after
            if n == 0:
                break
