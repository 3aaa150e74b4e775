"""Arrow batches in portions, to bound what a task holds as Python objects."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a portion, unless a single text has more: of what is worked on at once, and of what is
#: put together before it is sent.
PORTION, PARCEL_PORTION = 1 << 19, 1 << 23


def portions(batches, column: str, size: int = PORTION) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with about so many bytes of text, and their texts; null texts are empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths, dtype=np.int64) // size
        cuts = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1, len(lengths)] if len(lengths) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(int(a), int(b - a))
            yield part, [text or "" for text in part.column(part.schema.get_field_index(column)).to_pylist()]


def columns_of(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(name)) for name in names]
