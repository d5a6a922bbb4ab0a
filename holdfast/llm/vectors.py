"""Shared by the vector searches: which rows take part, blocks, and the best of each query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable_vectors(df: DataFrame, id_column: str, vector_column: str, kind: str, zero_allowed: bool) -> DataFrame:
    """(id, v): components as `kind`.  Repeated ids give a row each.

    Left out: null ids, null and empty vectors, vectors with null or non-finite components, and zero vectors
    unless allowed.  Other columns are not read.
    """
    v = f"`{vector_column}`"
    asked = f"`{id_column}` IS NOT NULL AND {v} IS NOT NULL AND size({v}) > 0"
    asked += f" AND forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    if not zero_allowed:
        asked += f" AND exists({v}, x -> x <> 0)"
    return df.where(asked).select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.expr(kind.format(v=v)).alias("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors of an Arrow list column as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def ranked(found: DataFrame, top: int, score_type: str) -> DataFrame:
    """The `top` best of each query, ties to the smaller vec_id, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", F.col("score").cast(score_type))
