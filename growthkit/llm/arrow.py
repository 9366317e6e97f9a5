"""Arrow batches cut into slices that fit in a worker's memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

#: Bytes of text that are worked on at once; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 20


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; null counts as empty."""
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, most_rows: int | None = None
) -> Iterator[tuple]:
    """(batch slice, bytes, offsets) for runs of rows that hold up to `limit` bytes of text, and up to `most_rows` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_buffers(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            to = min(to, at + most_rows) if most_rows else to
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def arrow_type(kind: DataType) -> pa.DataType:
    """The Arrow type of a column that goes back to Spark as `kind`; every type of Spark that Arrow has."""
    return to_arrow_type(kind)
