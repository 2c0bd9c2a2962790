"""Joins that Spark's planner would make a nested loop of, as equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def band_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, width: float) -> DataFrame:
    """Pairs of rows whose numbers differ by at most ``width``; rows with a null have none.

    Both sides are dealt into bins of that width, and the right side's rows stand in three
    bins, so the join is by equal bins and each pair is made once. Column names must differ.
    """
    bin_ = lambda c: F.floor(F.col(c) / F.lit(float(width))).cast("long")
    near = right.withColumn("__bin", F.explode(F.sequence(bin_(right_on) - 1, bin_(right_on) + 1)))
    both = left.withColumn("__bin", bin_(left_on)).join(near, "__bin").drop("__bin")
    return both.filter(F.abs(F.col(left_on) - F.col(right_on)) <= width)


def as_of_join(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, value: str) -> DataFrame:
    """``left`` with the ``value`` of the last row of ``right`` with the same ``by`` and a time that is not later; null where there is none.

    Both sides go through one window, so there is one shuffle and no pair is made. Of rows of ``right``
    with equal times the greatest value counts.
    """
    columns = left.columns
    held = left.select(F.col(by).alias("k"), F.col(left_time).alias("t"), F.lit(1).alias("side"), F.lit(None).cast(right.schema[value].dataType).alias("v"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    other = right.select(F.col(by).alias("k"), F.col(right_time).alias("t"), F.lit(0).alias("side"), F.col(value).alias("v"), F.lit(None).cast(held.schema["row"].dataType).alias("row"))
    so_far = Window.partitionBy("k").orderBy("t", "side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = held.unionByName(other).withColumn("v", F.last("v", ignorenulls=True).over(so_far))
    return found.filter("side = 1").select("row.*", F.col("v").alias(f"last_{value}"))
