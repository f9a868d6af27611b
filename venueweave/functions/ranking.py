"""The first row of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in this order; Spark keeps one row per key and task before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")
