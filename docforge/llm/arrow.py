"""Helpers for the operators that run over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters handled at once by the array code; a longer text is a slice of its own, whole.
SLICE_CHARS = 1 << 19


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the array code holds about ``most`` characters at a time; no row is cut or left out."""
    for batch in batches:
        lengths = batch.column(column)
        lengths = pc.binary_length(lengths).fill_null(0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def codepoints(text: str) -> np.ndarray:
    """The code points of a string."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def list_array(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))
