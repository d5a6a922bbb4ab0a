"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of the pivots nearest to it.  In every block of vectors it is
posted in the inverted files of these pivots.  A query reads the files of its own nearest pivots and
so gets the footrule distance of both orders (a pivot missing from one stands behind its end); the
block's vectors of least distance are ranked again by exact inner products.

Largest inner product becomes nearness of directions by one more component, which lifts all vectors
to the greatest length and is 0 for queries.  Pivots are a bounded sample of the vectors; every vector
is indexed.  Both sides are dealt in blocks by a hash of the id, so no pivot, however popular, is a
task of its own, and a block gives its best few per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import stored
from .vectors import matrix, ranked, usable_vectors

PIVOTS = 128
POSTED = 64
CANDIDATES = 768
BLOCK = 4096
QUERY_BLOCK = 2048
TOP = 20


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """For every row its nearest pivots in order, ties to the earlier pivot."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :posted].astype(np.int16)


def agreements(query: np.ndarray, files: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """For every vector of a block the sum over common pivots of (length - later place).

    The footrule distance of two orders of `length` pivots is length * (length + 1) less twice this.
    """
    length = len(query)
    out = np.zeros(n, np.int32)
    for place, pivot in enumerate(query.tolist()):
        rows, places = files[pivot]
        out[rows] += length - np.maximum(places, place)
    return out


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    top: int = TOP,
    pivots: int = PIVOTS,
    posted: int = POSTED,
    candidates: int = CANDIDATES,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` nearest found of each query, rows of its own id left out.

    Nearness is the largest inner product, in double precision; ties go to the smaller vec_id.  A
    query has fewer rows only if there are fewer other vectors of its length.  Every block offers its `candidates`
    nearest orders (a block that small is compared whole), so recall does not fall as blocks are added.

    * Rows that take no part: see `usable_vectors`; zero vectors take none.
    * Repeated ids are rows of their own; several queries of one id are answered as one.
    * Vectors of different lengths are never compared; each length has its own blocks and pivots.
    * Empty tables: no rows.  Only the two named columns are read; others may have any name.
    """
    spark = vectors.sparkSession
    root = workspace(spark)
    kind, d = "CAST({v} AS array<double>)", F.size("v").alias("d")
    rows = stored(usable_vectors(vectors, id_column, vector_column, kind, False).select("*", d), "vectors", root)
    asked = stored(usable_vectors(queries, id_column, vector_column, kind, False).select("*", d), "queries", root)
    length = F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")
    # One row per length of vectors.
    sizes = {row["d"]: row for row in rows.groupBy("d").agg(F.count("*").alias("n"), F.max(length).alias("most")).collect()}
    asked_sizes = {row["d"]: row["n"] for row in asked.groupBy("d").agg(F.count("*").alias("n")).collect()}
    blocks = {size: max(1, -(-row["n"] // block)) for size, row in sizes.items()}
    query_blocks = {size: max(1, -(-n // query_block)) for size, n in asked_sizes.items() if size in sizes}
    if not query_blocks:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).where("false")
    # Equal vectors make one pivot, so a common vector cannot fill the sample.
    wide = [size for size, row in sizes.items() if row["n"] > candidates]
    distinct = rows.where(F.col("d").isin(wide)).groupBy("d", F.xxhash64("v").alias("h")).agg(F.min("v").alias("v"))
    order = Window.partitionBy("d").orderBy(F.xxhash64("h"), "h")
    points = {}
    for row in distinct.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pivots).orderBy("d", "place").collect():
        points.setdefault(row["d"], []).append(row["v"])
    for size, found in points.items():
        found = np.array(found)
        found = np.c_[found, np.sqrt(np.maximum(sizes[size]["most"] - (found**2).sum(axis=1), 0))]
        points[size] = found / np.linalg.norm(found, axis=1, keepdims=True)
    held = spark.sparkContext.broadcast((points, {size: row["most"] for size, row in sizes.items()}))

    def number(counts: dict[int, int]):
        return F.element_at(F.create_map(*(F.lit(x) for pair in counts.items() for x in pair)), F.col("d"))

    def dealt(frame: DataFrame, own: str, own_blocks: dict[int, int], other: str, other_blocks: dict[int, int]) -> DataFrame:
        frame = frame.where(F.col("d").isin(list(query_blocks))).withColumn(own, F.pmod(F.xxhash64("id"), number(own_blocks)).cast("int"))
        return frame.withColumn(other, F.explode(F.sequence(F.lit(0), number(other_blocks) - 1)))

    left, right = dealt(rows, "i", blocks, "j", query_blocks), dealt(asked, "j", query_blocks, "i", blocks)

    def run(own: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if len(own) and len(theirs):
            own = own.sort_by("id")
            ids, v = own.column("id").to_numpy(), matrix(own.column("v"))
            query_ids, q = theirs.column("id").to_numpy(), matrix(theirs.column("v"))
            n = len(ids)
            orders = None
            if n > candidates:
                points, most = held.value[0][v.shape[1]], held.value[1][v.shape[1]]
                deep = min(posted, len(points))
                lifted = np.c_[v, np.sqrt(np.maximum(most - (v**2).sum(axis=1), 0))]
                own_orders = nearest_pivots(lifted, points, deep)
                by_pivot = np.argsort(own_orders.ravel(), kind="stable")
                edges = np.searchsorted(own_orders.ravel()[by_pivot], np.arange(len(points) + 1))
                files = [(by_pivot[a:b] // deep, by_pivot[a:b] % deep) for a, b in zip(edges[:-1], edges[1:])]
                orders = nearest_pivots(np.c_[q, np.zeros(len(q))], points, deep)
            for place, (query_id, query) in enumerate(zip(query_ids.tolist(), q)):
                near = np.arange(n)
                if orders is not None:
                    # Stable: equal distances keep the order of ids.
                    near = np.argsort(-agreements(orders[place], files, n), kind="stable")[: candidates + 1]
                    near = np.sort(near)
                near = near[ids[near] != query_id]
                # Row by row the same sums, so equal vectors get equal scores.
                scores = (v[near] * query).sum(axis=1)
                best = np.argsort(-scores, kind="stable")[:top]
                out[0].append(np.full(len(best), query_id))
                out[1].append(ids[near[best]])
                out[2].append(scores[best])
        columns = [pa.array(np.concatenate(x) if x else [], kind) for x, kind in zip(out, (pa.int64(), pa.int64(), pa.float64()))]
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    keys = ("d", "i", "j")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    return ranked(found, top, "double")
