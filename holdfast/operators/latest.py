"""Newest row per key, and the newest slice of a table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark turns the filter into a group limit below the shuffle, so each task sends
    at most one row per key.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).where(F.col("_rank") == 1).drop("_rank")


def newest(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry the greatest value of a column.

    The maximum is a scalar subquery, so a table partitioned by the column is pruned
    to one partition when it is read.
    """
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())
