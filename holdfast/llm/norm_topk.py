"""Exact search for the largest inner products, by buckets of vectors of like length.

A query's score with any vector of a bucket is at most |query| * (greatest length of the bucket), so
with the query's running bound (its k-th best score so far) a bucket has a local threshold on the
cosine, bound / (|query| * greatest length).  Above 1 the bucket is skipped.  A small threshold leaves
only the length to prune by; a large one confines the leading coordinates of every possible match to
narrow ranges, and only vectors within them are multiplied out.  All pruning keeps ties.

Lengths are bucketed geometrically; a bucket of many rows is dealt to several blocks.  Queries carry
a bound from a bounded sample of the longest vectors, so most buckets are ruled out before a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import stored
from .vectors import matrix, ranked, usable_vectors

SCALE = 256
TOP = 5
RATIO = 1.05
BLOCK = 4096
QUERY_BLOCK = 2048
SEEDS = 1024
COORDINATES = 4
COSINE = 0.3
CHUNK = 512


def coordinate_matches(cosines: np.ndarray, query: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit vectors (rows) can have this cosine with the unit query, by its leading coordinates.

    If u.q >= t then |u_f - t' q_f| <= sqrt((1 - t'^2)(1 - q_f^2)) for t' = u.q, so u_f lies between
    the least and greatest of that range over t' in [t, 1].
    """
    keep = np.ones(len(cosines), bool)
    for f in np.argsort(-np.abs(query))[:COORDINATES].tolist():
        x = float(np.clip(query[f], -1, 1))
        slack = np.sqrt(max(0.0, (1 - threshold**2) * (1 - x * x)))
        low = -1.0 if -x >= threshold else threshold * x - slack
        high = 1.0 if x >= threshold else threshold * x + slack
        keep &= (cosines[:, f] >= low - 1e-9) & (cosines[:, f] <= high + 1e-9)
    return keep


def best_of_block(ids: np.ndarray, v: np.ndarray, lengths: np.ndarray, query_id: int, query: np.ndarray, bound: float, top: int):
    """(ids, scores) of the `top` best of a block for one query, or fewer, leaving out what is below `bound`.

    The block is in order of length, the longest first, and is worked through in chunks.
    """
    size = float(np.sqrt(query @ query))
    unit = query / size if size else query
    kept_ids, kept = np.zeros(0, np.int64), np.zeros(0)
    for low in range(0, len(ids), CHUNK):
        longest = lengths[low]
        chunk = slice(low, min(low + CHUNK, len(ids)))
        if bound > 0 and size * longest < bound * (1 - 1e-12):
            break
        picked = np.arange(chunk.start, chunk.stop)
        threshold = bound / (size * longest) if bound > 0 and size * longest > 0 else 0.0
        if threshold > COSINE:
            own = lengths[chunk]
            picked = picked[coordinate_matches(v[chunk] / np.where(own > 0, own, 1)[:, None], unit, min(1.0, threshold * (1 - 1e-12))) & (own > 0)]
        elif threshold > 0:
            picked = picked[lengths[chunk] * size >= bound * (1 - 1e-12)]
        picked = picked[ids[picked] != query_id]
        # Whole numbers below 2^53: exact in any order.
        scores = v[picked] @ query
        all_ids, scores = np.concatenate((kept_ids, ids[picked])), np.concatenate((kept, scores))
        best = np.lexsort((all_ids, -scores))[:top]
        kept_ids, kept = all_ids[best], scores[best]
        if len(kept) == top:
            bound = max(bound, kept[-1])
    return kept_ids, kept


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    top: int = TOP,
    scale: int = SCALE,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
    seeds: int = SEEDS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` largest inner products of each query, rows of its own id left out.

    Components x count as floor(scale * x).  Ties go to the smaller vec_id; fewer rows only if there
    are fewer other vectors of the query's length.  Exact while products stay below 2^53.

    * Rows that take no part: see `usable_vectors`; zero vectors do take part, with score 0.
    * Repeated ids are rows of their own; several queries of one id are answered as one.
    * Vectors with different numbers of components are never compared.
    * Empty tables: no rows.  Only the two named columns are read; others may have any name.
    """
    spark = vectors.sparkSession
    root = workspace(spark)
    kind = f"transform({{v}}, x -> floor({scale}D * CAST(x AS double)))"
    size, d = F.expr("sqrt(aggregate(v, 0D, (s, x) -> s + CAST(x AS double) * x))").alias("length"), F.size("v").alias("d")
    rows = usable_vectors(vectors, id_column, vector_column, kind, True).select("*", d, size)
    rows = stored(rows.withColumn("bucket", F.when(F.col("length") > 0, F.floor(F.log("length") / F.log(F.lit(RATIO)))).otherwise(-1).cast("int")), "vectors", root)
    asked = usable_vectors(queries, id_column, vector_column, kind, True).select("*", d, size)
    # One row per number of components and bucket: at most the number of geometric steps between doubles for each.
    buckets = rows.groupBy("d", "bucket").agg(F.count("*").alias("n"), F.max("length").alias("longest")).orderBy("d", "bucket").collect()
    parts = {(row["d"], row["bucket"]): -(-row["n"] // block) for row in buckets}

    seeded: dict[int, tuple[list[int], list[list[int]]]] = {}
    for row in rows.orderBy(F.desc("length"), "id").limit(seeds).select("id", "v").collect():
        own = seeded.setdefault(len(row["v"]), ([], []))
        own[0].append(row["id"])
        own[1].append(row["v"])
    held = spark.sparkContext.broadcast({k: (np.array(ids, np.int64), np.array(v, np.float64)) for k, (ids, v) in seeded.items()})

    def bounded(batches):
        known = held.value
        for batch in batches:
            bounds = np.full(batch.num_rows, -np.inf)
            for k, (query_id, query) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                query = query.values.to_numpy().astype(np.float64)
                if len(query) in known:
                    ids, v = known[len(query)]
                    scores = (v @ query)[ids != query_id]
                    if len(scores) >= top:
                        bounds[k] = np.partition(scores, len(scores) - top)[len(scores) - top]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bounds)], names=["id", "v", "d", "length", "bound"])

    asked = stored(asked.mapInArrow(bounded, "id bigint, v array<bigint>, d int, length double, bound double"), "queries", root)
    query_blocks = max(1, -(-asked.count() // query_block))
    if not parts:
        return asked.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("score")).where("false")

    part = F.element_at(F.create_map(*(F.lit(x) for (size, bucket), n in parts.items() for x in (f"{size} {bucket}", n))), F.concat_ws(" ", "d", "bucket"))
    left = rows.withColumn("i", F.pmod(F.xxhash64("id"), part).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    known = [
        F.struct(F.lit(row["d"]).alias("d"), F.lit(row["bucket"]).alias("bucket"), F.lit(parts[row["d"], row["bucket"]]).alias("parts"), F.lit(row["longest"]).alias("longest"))
        for row in buckets
    ]
    near = F.filter(F.array(*known), lambda b: (b["d"] == F.col("d")) & ((F.col("bound") <= 0) | (b["longest"] * F.col("length") * (1 + 1e-12) >= F.col("bound"))))
    right = asked.withColumn("j", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    right = right.withColumn("at", F.explode(near)).withColumn("i", F.explode(F.expr("sequence(0, at.parts - 1)"))).select("id", "v", "d", "bound", F.col("at.bucket").alias("bucket"), F.col("i").cast("int").alias("i"), "j")

    def run(own: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if len(own) and len(theirs):
            own = own.sort_by([("length", "descending"), ("id", "ascending")])
            ids, v, lengths = own.column("id").to_numpy(), matrix(own.column("v")), own.column("length").to_numpy()
            query_ids, q, bounds = theirs.column("id").to_numpy(), matrix(theirs.column("v")), theirs.column("bound").to_numpy()
            for query_id, query, bound in zip(query_ids.tolist(), q, bounds.tolist()):
                best, scores = best_of_block(ids, v, lengths, query_id, query, bound, top)
                out[0].append(np.full(len(best), query_id))
                out[1].append(best)
                out[2].append(scores.astype(np.int64))
        columns = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out]
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    keys = ("d", "bucket", "i", "j")
    found = left.select("id", "v", "length", *keys).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    return ranked(found, top, "bigint")
