"""A text service called for batches of distinct texts, such as a translator behind an endpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task has as Python strings at a time, if no single text is longer.
SLICE_BYTES = 1 << 20


def _answers(texts: pa.Array, call: Callable[[str], str]) -> Iterator[pa.Array]:
    """The answers to a batch's texts, by slices."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    ends = np.append(np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES)) + 1, len(texts))
    start = 0
    for end in ends.tolist():
        given = texts[start:end].dictionary_encode()
        answers = pa.array([call(t) if t else "" for t in given.dictionary.to_pylist()], pa.string())
        yield pc.fill_null(answers.take(given.indices), "")
        start = end


def transformed(df: DataFrame, column: str, call: Callable[[str], str], name: str) -> DataFrame:
    """``df`` with ``name`` = call(text); null and '' give ''. Within a slice of a batch each different text is sent once."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from _answers(texts, call)

    return df.withColumn(name, run(F.col(column)))
