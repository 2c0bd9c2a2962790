"""Incremental reads of a growing relation by a watermark column, as Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_relation(spark: SparkSession, path: str, watermark: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """A streaming DataFrame over a folder of Parquet files that grows, with the folder's own schema."""
    schema = spark.read.parquet(path).schema
    df = spark.readStream.schema(schema).parquet(path)
    return df.withWatermark(watermark, delay) if watermark else df
