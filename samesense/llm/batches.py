"""Per-text work in Arrow batches of bounded size, for what column functions cannot say."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType

SLICE_BYTES = 4 << 20
SLICE_ROWS = 512

Work = Callable[[list[str]], pa.Array]


def slices(texts: pa.Array, most_rows: int = SLICE_ROWS, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with at most ``most_bytes`` of text and ``most_rows`` each, or one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64"))
    start = 0
    while start < len(texts):
        limit = (sizes[start - 1] if start else 0) + most_bytes
        end = min(max(int(np.searchsorted(sizes, limit, "right")), start + 1), start + most_rows, len(texts))
        yield start, end
        start = end


def append(docs: DataFrame, text: str, name: str, kind: DataType, start: Callable[[], Work]) -> DataFrame:
    """``docs`` with a column ``name`` computed from each text (null: the empty text).

    ``start()`` runs once per task and returns the function that maps a list of texts to
    an Arrow array. Texts are handed over a few megabytes at a time, so a task's memory
    does not depend on the number of rows in a batch.
    """
    place = docs.columns.index(text)
    schema = StructType([*docs.schema.fields]).add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            texts = batch.column(place)
            for low, high in slices(texts):
                part = batch.slice(low, high - low)
                made = work([t if t is not None else "" for t in part.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])

    return docs.mapInArrow(run, schema)
