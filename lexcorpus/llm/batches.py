"""Arrow batches of rows with a text: further columns, or fewer rows, all else left as it is."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

Texts = list[str | None]


ROWS = 1000


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``ROWS`` rows at most, so that few texts become Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def extended(docs: DataFrame, text: str, columns: str, compute: Callable[[Texts], Sequence]) -> DataFrame:
    """``docs`` without its texts and with ``columns`` (a DDL list), which ``compute`` makes from
    the texts of a batch, an array or list for each."""
    at = docs.columns.index(text)
    kept = [i for i in range(len(docs.columns)) if i != at]
    new = StructType.fromDDL(columns)
    schema = StructType([*[docs.schema[i] for i in kept], *new])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [x if isinstance(x, pa.Array) else pa.array(x) for x in compute(batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *made], names=schema.names)

    return docs.mapInArrow(work, schema)


def filtered(docs: DataFrame, text: str, keep: Callable[[Texts], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose texts ``keep`` marks."""
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array(np.asarray(keep(batch.column(at).to_pylist()), bool)))

    return docs.mapInArrow(work, docs.schema)
