"""Documents on their way through Arrow batches: each text once, and in groups of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts of a batch are handled in groups of about this many bytes.
GROUP_BYTES = 4 << 20


def with_text(docs: DataFrame, carry: list[str] | None = None, **more: Column) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default), unless it is among them ``text``, and ``more`` columns."""
    names = docs.columns if carry is None else carry
    row = F.struct(*(docs[c] for c in names)).alias("row")
    return docs.select(row, *([] if "text" in names else ["text"]), *(c.alias(n) for n, c in more.items()))


def text_column(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of ``with_text``, also where its row has been put into a further ``row``."""
    if "text" in batch.schema.names:
        return batch.column("text")
    column = batch.column("row")
    while "text" not in [f.name for f in column.type]:
        column = column.field("row")
    return column.field("text")


def by_bytes(batch: pa.RecordBatch, size: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``size`` bytes, at least a row each; a batch without rows is one."""
    lengths = np.array(pc.fill_null(pc.binary_length(text_column(batch)), 0), np.int64)
    end, first = np.cumsum(lengths), 0
    while first < batch.num_rows or not batch.num_rows:
        before = end[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(end, before + size, "right")))
        yield batch.slice(first, stop - first)
        first = stop
        if not batch.num_rows:
            return
