"""Arrow batches cut by the bytes of their texts, and list columns built from flat arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text and rows that a task works on at a time; a longer text is worked on alone, whole.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 2_000


def text_slices(
    batches: Iterable[pa.RecordBatch], column: int = 1, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices of about ``most_bytes`` of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start, before = 0, 0
        while start < len(batch):
            stop = int(np.searchsorted(ends, before + most_bytes, side="right"))
            stop = min(max(stop, start + 1), start + most_rows)
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


def list_column(parts: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A column of lists, one for each array of ``parts``."""
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    flat = np.concatenate(parts) if len(parts) else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
