"""Bounded samples of labelled rows, to fit the small models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def byte_windows(text: Column, n: int, size: int) -> Column:
    """At most n windows of ``size`` bytes, evenly spaced over the text's UTF-8 bytes."""
    data = F.encode(text, "UTF-8")
    room = F.greatest(F.octet_length(data) - size, F.lit(0))
    count = F.least(F.lit(n), F.ceil(F.octet_length(data) / size).cast("int"))
    starts = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.floor(room * i / F.greatest(count - 1, F.lit(1))).cast("int"))
    return F.transform(starts, lambda s: F.substring(data, s + 1, F.lit(size)))


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """The rows with the smallest hashes of ``doc_id``, the same for any partitioning."""
    return docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
