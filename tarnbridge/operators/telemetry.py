"""What scans were built: the last one, and a bounded log. No value of a literal is kept."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "query_id long, catalog string, table_name string, projected_columns string, pushed_filters string, residual_columns string, not_pushed_reasons string, partitions int, limit_rows long, offset_rows long, bridge_time_us long, error string"


@dataclass
class QueryRecord:
    query_id: int
    catalog: str
    table_name: str
    projected_columns: str = ""
    filters: Callable[[], tuple] | None = None
    partitions: int | None = None
    limit: int | None = None
    offset: int | None = None
    bridge_time_us: int | None = None
    error: str | None = None

    def row(self) -> tuple:
        """The plan is looked at when the record is asked for, not at each scan."""
        if callable(self.filters):
            found = self.filters()
            self.filters = found
        pushed, residual, reasons = self.filters or ([], [], [])
        return (self.query_id, self.catalog, self.table_name, self.projected_columns, " AND ".join(pushed), ",".join(residual), ",".join(reasons), self.partitions, self.limit, self.offset, self.bridge_time_us, self.error)


class Telemetry:
    """The records of one bridge; ``log_size`` 0 keeps no log."""

    def __init__(self, log_size: int = 0):
        self.last: QueryRecord | None = None
        self.count, self.log = 0, deque(maxlen=log_size)

    def resize(self, log_size: int) -> None:
        self.log = deque(self.log, maxlen=log_size)

    def record(self, **fields) -> QueryRecord:
        self.count += 1
        self.last = QueryRecord(self.count, **fields)
        self.log.appendleft(self.last)
        return self.last

    def frame(self, spark: SparkSession, records) -> DataFrame:
        return spark.createDataFrame([r.row() for r in records], COLUMNS)


class Timer:
    def __enter__(self):
        self.start = time.perf_counter()
        return self

    def __exit__(self, *_):
        self.us = int((time.perf_counter() - self.start) * 1e6)
