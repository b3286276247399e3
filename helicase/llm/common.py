"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from helicase.sources.store import discard, materialised, shared_dir

__all__ = ["by_text", "binary_parts", "discard", "materialised", "shared_dir", "sliced"]

#: Text bytes that one step of an Arrow function handles at a time.
SLICE_BYTES = 4 << 20


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, into the bytes) and bytes of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)


def sliced(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose strings in that column hold at most so many bytes (one row at least)."""
    offsets, _ = binary_parts(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def by_text(fn: Callable[[list[str]], list[pa.Array]], names: list[str], keep: list[str], text: str = "text", most: int = SLICE_BYTES):
    """A mapInArrow function: columns in keep pass, fn makes the others from the texts (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            pa.default_memory_pool().release_unused()  # of the batch before
            if not whole.num_rows:
                continue
            at = whole.schema.get_field_index(text)
            for batch in sliced(whole, at, most):
                texts = ["" if x is None else x for x in batch.column(at).to_pylist()]
                kept = [batch.column(batch.schema.get_field_index(k)) for k in keep]
                yield pa.RecordBatch.from_arrays([*kept, *fn(texts)], names=[*keep, *names])

    return run
