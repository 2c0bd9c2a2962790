"""What a scan or query is kept in: tables, Parquet and CSV files. Sources are never written to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conninfo import BridgeError


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which driver and executors share; a temporary folder serves for a local master only."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not conf.get("spark.master", "").startswith("local"):
        raise BridgeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(root or _local_root()).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="spark-tarnbridge-")


def snapshot(df: DataFrame, table: str, path: str | None = None, replace: bool = True) -> DataFrame:
    """The rows as a table of the session's catalog, at ``path`` or in the warehouse; without ``replace`` an existing one is an error."""
    writer = df.write.mode("overwrite" if replace else "error").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def to_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), codec: str = "zstd") -> DataFrame:
    """The rows as Parquet, with a folder for each value of ``partition_by``.

    Rows are dealt by those columns first, so a folder gets few files; a rebalance lets
    adaptive execution split a value that holds many rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("compression", codec).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def to_csv(df: DataFrame, path: str, separator: str = ";") -> DataFrame:
    """The rows as CSV with a header, read back with their types; quotes are doubled inside quotes."""
    options = {"header": True, "sep": separator, "quote": '"', "escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "nullValue": "\\N"}
    df.write.mode("overwrite").options(**options).csv(path)
    return df.sparkSession.read.schema(df.schema).options(**options, multiLine=True).csv(path)


def sorted_parquet(df: DataFrame, path: str, *keys: str) -> DataFrame:
    """The rows in ranges of the keys, sorted in each file, so that row groups hold narrow ranges for filters to skip."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def refresh_window(spark: SparkSession, path: str, fresh: DataFrame, column: str, since, new_path: str) -> DataFrame:
    """A snapshot at ``new_path``: of the one at ``path`` the rows before ``since``, and ``fresh`` rows from then on.

    The window is a filter on both sides, so nothing is joined; rows with a null in ``column`` stay as they were.
    """
    old = spark.read.parquet(path).filter((F.col(column) < F.lit(since)) | F.col(column).isNull())
    return to_parquet(old.unionByName(fresh.filter(F.col(column) >= F.lit(since))), new_path)
