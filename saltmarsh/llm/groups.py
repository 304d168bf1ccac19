"""Groups of rows in a partition that is sorted by their keys, one after another."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tokens import column_of


def gathered(df: DataFrame, *keys: str, then: tuple[str, ...] = ()) -> DataFrame:
    """Rows with equal keys in one partition, one after another."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *then)


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The runs of rows with equal keys (non-null integers). One group is held at a time."""
    rows: list[pa.RecordBatch] = []
    open_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = np.stack([column_of(batch, c).to_numpy(zero_copy_only=False) for c in keys], axis=1)
        cuts = (np.flatnonzero((parts[1:] != parts[:-1]).any(axis=1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if (now := tuple(parts[a].tolist())) != open_key:
                if rows:
                    yield pa.Table.from_batches(rows)
                rows, open_key = [], now
            rows.append(batch.slice(a, b - a))
    if rows:
        yield pa.Table.from_batches(rows)
