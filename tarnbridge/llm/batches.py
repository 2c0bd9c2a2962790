"""Arrow batches in tasks: small slices by bytes, and output built from columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

#: Bytes of text that a task handles at a time; a longer text is handled alone.
SLICE_BYTES = 500_000


def slices(batches, text_at: int = 1, size: int = SLICE_BYTES):
    """Lists of the batches' columns, cut so that the texts of a list have about ``size`` bytes.

    A batch is cut while it is Arrow, so Python objects are made for one slice at a time.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = before = 0
        while begin < len(ends):
            end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield [c.to_pylist() for c in batch.slice(begin, end - begin).columns]
            begin, before = end, int(ends[end - 1])


def arrow(ddl: str, doc_id: DataType | None = None) -> tuple[str, pa.Schema]:
    """A DDL schema (``{id}`` stands for the identifier's type) and its Arrow form."""
    ddl = ddl.format(id=doc_id.simpleString() if doc_id is not None else "long")
    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)
