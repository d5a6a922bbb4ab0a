"""Whitening of integer vectors by a weighted multiplicity covariance.

Equal vectors are one group with a multiplicity.  Sums, covariance, projection and the check of the
result run over groups, each weighted by its multiplicity (or by one), so a vector that fills a third
of the table costs as much as one that comes once.  Every group is whitened once and joined back to
its rows by a 128-bit hash.

Sums are exact integers; entries are centred as integers before they become doubles, so a large common
offset costs no digits.  What meets on the driver is of fixed size: one sum per dimension, the
covariance matrix, and 32 moments of the whitened components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
TURNS = 32
CHUNK = 1 << 16
ROWS = 4096
HOT = 256
SALTS = 64
SMALL = 1 << 20

RESULT = "id bigint, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def integer_vectors(df: DataFrame, id_column: str, vector_column: str, scale: int, offset: int) -> DataFrame:
    """(id, x) with x = floor(scale * entry) + offset, for rows whose vector has entries, all of them finite.

    A vector with an entry of 2^52 / scale or more takes no part either, as no double holds its x exactly.
    """
    v = f"`{vector_column}`"
    bound = f"abs(double(x)) < {float(1 << 52)} / {scale}"
    asked = f"{v} IS NOT NULL AND size({v}) > 0 AND forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND {bound})"
    x = f"transform({v}, x -> CAST(floor({scale} * CAST(x AS double)) AS bigint) + {offset}L)"
    return df.where(asked).select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.expr(x).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches, with their vectors as rows and their weights."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            x = part.column(part.schema.get_field_index("x")).flatten().to_numpy().reshape(part.num_rows, -1)
            yield part, x, part.column(part.schema.get_field_index("weight")).to_numpy()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the exact weighted sum of every dimension, and of the weights under -1."""
    high = low = None
    total = 0
    for _, x, weight in _blocks(batches):
        # Each half times the weights fits 64 bits up to 2^35 rows in a task.
        upper, lower = weight @ (x >> 26), weight @ (x & ((1 << 26) - 1))
        high, low = (upper, lower) if high is None else (high + upper, low + lower)
        total += int(weight.sum())
    if high is not None:
        sums = [total, *((int(a) << 26) + int(b) for a, b in zip(high, low))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums) - 1), pa.int32()), pa.array(map(str, sums))], names=["place", "total"])


def _scatter(base: np.ndarray, rest: np.ndarray) -> Callable:
    """Task: the weighted centred product, in chunks of whole rows."""

    def run(batches):
        d = len(base)
        product = np.zeros((d, d))
        any_rows = False
        for _, x, weight in _blocks(batches):
            centred = (x - base).astype(np.float64) - rest
            product += (centred * weight[:, None]).T @ centred
            any_rows = True
        if any_rows:
            step = max(1, CHUNK // d)
            chunks = [product[k : k + step].tobytes() for k in range(0, d, step)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())], names=["chunk", "product"])

    return run


def _added(rows: pa.Table) -> pa.Table:
    """One chunk as the sum of several tasks' chunks."""
    total = sum(np.frombuffer(part.as_py()) for part in rows.column("product"))
    return pa.table({"chunk": rows.column("chunk")[:1], "product": pa.array([total.tobytes()], pa.binary())})


def covariance(groups: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Of (x, weight): centred before multiplying, divisor n.  Tasks' sums are added up in two steps."""
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    parts = groups.mapInArrow(_scatter(base, rest), "chunk int, product binary")
    parts = parts.withColumn("turn", F.pmod(F.xxhash64("product"), F.lit(TURNS)))
    for keys in (("chunk", "turn"), ("chunk",)):
        parts = parts.groupBy(*keys).applyInArrow(_added, "chunk int, product binary")
    found = sorted(parts.collect(), key=lambda row: row["chunk"])
    return np.concatenate([np.frombuffer(bytes(row["product"])) for row in found]).reshape(len(sums), -1) / n


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greatest eigenvalues falling, their unit eigenvectors as columns, and their share of the trace.

    A direction without variance, up to rounding, cannot be whitened and is left out.  The entry
    of greatest size of each eigenvector is positive.
    """
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > values[0] * len(values) * np.finfo(np.float64).eps * 8
    values, vectors = values[real][:most], vectors[:, real][:, :most]
    if len(values):
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors, values / np.trace(covariance) if len(values) else values


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The sum over dimensions of (n * x - S)^2 for every row, in whole numbers of any size."""
    base, rest = [s // n for s in sums], [s % n for s in sums]
    near = x - np.array(base, np.int64)
    small = np.abs(near).max(axis=1, initial=0) < SMALL
    near_small = np.where(small[:, None], near, 0)
    # n^2 sum(y^2) - 2 n sum(y r) + sum(r^2), where y is small and r below n is cut in two halves.
    low, high = (np.array([half(r) for r in rest], np.int64) for half in (lambda r: r & (SMALL - 1), lambda r: r >> 20))
    squares, by_low, by_high = (near_small * near_small).sum(axis=1), near_small @ low, near_small @ high
    last = sum(r * r for r in rest)
    found = [n * n * a - 2 * n * (b + (c << 20)) + last for a, b, c in zip(squares.tolist(), by_low.tolist(), by_high.tolist())]
    for row in np.flatnonzero(~small).tolist():
        found[row] = sum((n * int(value) - s) ** 2 for value, s in zip(x[row], sums))
    return found


def _whitened(n: int, sums: list[int], matrix: np.ndarray) -> Callable:
    """Task: every group's deviation and components."""
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def run(batches):
        for part, x, _ in _blocks(batches):
            values = ((x - base).astype(np.float64) - rest) @ matrix
            offsets = np.arange(0, values.size + 1, matrix.shape[1] or 1, dtype=np.int32) if matrix.shape[1] else np.zeros(len(x) + 1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(part.schema.get_field_index(name)) for name in ("h1", "h2", "copies", "weight")),
                    pa.array(map(str, exact_deviations(x, n, sums)), pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel())),
                ],
                names=["h1", "h2", "copies", "weight", "deviation", "whitened"],
            )

    return run


def _merged(parts: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """Weight, mean and centred product of several disjoint parts."""
    n, mean, product = parts[0]
    for m, other, added in parts[1:]:
        gap, both = other - mean, n + m
        product = product + added + np.outer(gap, gap) * (n * m / both)
        mean, n = mean + gap * (m / both), both
    return n, mean, product


def _moments(k: int) -> Callable:
    """Task: weight, mean and centred product of its whitened vectors."""

    def run(batches):
        parts = []
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                block = batch.slice(first, ROWS)
                weight = block.column(0).to_numpy().astype(np.float64)
                values = block.column(1).flatten().to_numpy().reshape(-1, k)
                mean = weight @ values / weight.sum()
                centred = values - mean
                parts = [_merged([*parts, (weight.sum(), mean, (centred * weight[:, None]).T @ centred)])]
        for n, mean, product in parts:
            yield pa.RecordBatch.from_arrays([pa.array([np.r_[n, mean, product.ravel()].tobytes()], pa.binary())], names=["moments"])

    return run


def _unpacked(packed: bytes, k: int) -> tuple[float, np.ndarray, np.ndarray]:
    values = np.frombuffer(packed)
    return values[0], values[1 : k + 1], values[k + 1 :].reshape(k, k)


def identity_error(whitened: DataFrame, k: int) -> float:
    """Of (weight, whitened): the largest absolute entry of the covariance less the identity."""

    def added(rows: pa.Table) -> pa.Table:
        n, mean, product = _merged([_unpacked(part.as_py(), k) for part in rows.column("moments")])
        return pa.table({"moments": pa.array([np.r_[n, mean, product.ravel()].tobytes()], pa.binary())})

    parts = whitened.select("weight", "whitened").mapInArrow(_moments(k), "moments binary")
    parts = parts.groupBy(F.pmod(F.xxhash64("moments"), F.lit(TURNS))).applyInArrow(added, "moments binary")
    n, _, product = _merged([_unpacked(bytes(row["moments"]), k) for row in parts.collect()])
    return float(np.abs(product / n - np.eye(k)).max())


def _joined_back(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Rows with their group's columns.  Groups of more than 1 / 256 of all rows, of which there are
    fewer than 256, are spread over salts on both sides; no other key can be hot."""
    hot = groups.where(F.col("copies") * HOT > total).select("h1", "h2", F.lit(True).alias("hot"))
    salted = rows.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
    )
    last = F.when(F.col("copies") * HOT > total, F.lit(SALTS - 1)).otherwise(F.lit(0)).cast("bigint")
    spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return salted.join(spread, ["h1", "h2", "salt"])


def whiten(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    weights: str = "copies",
    scale: int = SCALE,
    offset: int = OFFSET,
    dimension: int | None = None,
) -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) for every row that takes part.

    x = floor(scale * entry) + offset.  The fit runs over distinct x vectors, each weighted by its
    copies, or by one with `weights="one"`; n is the sum of the weights.  `whitened` and `explained`
    have an entry per component, greatest variance first, at most `components`.

    * Null or empty vectors, those with null or non-finite entries, or with entries of 2^52 / scale or
      more: no row.  Null id: a row with a null id.  Repeated rows, also of one id, each count and each give a row.
    * All vectors must have one length; rows of another length than `dimension` (by default the
      commonest, of ties the greatest) give no row.
    * Equal eigenvalues: any basis of their space, the same for all rows.  Directions without
      variance are left out, so fewer than `components` may come; with none (equal vectors only) arrays
      are empty and identity_error is 0.
    * Empty table: no rows.  Only the two named columns are read; others may have any name.
    """
    if weights not in ("copies", "one"):
        raise ValueError("weights: copies or one")
    spark = df.sparkSession
    root = workspace(spark)
    hashed = integer_vectors(df, id_column, vector_column, scale, offset).withColumns(
        {"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), "x")}
    )
    groups = stored(hashed.groupBy("h1", "h2", "x").agg(F.count("*").alias("copies")), "groups", root)
    if dimension is None:
        lengths = groups.groupBy(F.size("x").alias("length")).agg(F.sum("copies").alias("copies"))
        most = lengths.orderBy(F.desc("copies"), F.desc("length")).first()
        dimension = most["length"] if most else 0
    weight = F.col("copies") if weights == "copies" else F.lit(1).cast("bigint")
    groups = groups.where(F.size("x") == dimension).withColumn("weight", weight)

    found = groups.mapInArrow(_sums, "place int, total string").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    n, *sums = [int(row["total"]) for row in sorted(found.collect(), key=lambda row: row["place"])] or [0]
    if not n:
        return spark.createDataFrame([], RESULT)
    values, vectors, explained = components_of(covariance(groups, n, sums), components)
    k = len(values)
    layout = "h1 bigint, h2 bigint, copies bigint, weight bigint, deviation string, whitened array<double>"
    done = stored(groups.mapInArrow(_whitened(n, sums, vectors / np.sqrt(values)), layout), "whitened", root)
    error = identity_error(done, k) if k else 0.0
    total = done.agg(F.sum("copies")).first()[0]
    rows = hashed.where(F.size("x") == dimension).select("id", "h1", "h2")
    return _joined_back(rows, done, total).select(
        "id",
        F.lit(n).cast("bigint").alias("n"),
        F.col("deviation").try_cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.array(*map(F.lit, explained.tolist())).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def by_component(found: DataFrame) -> DataFrame:
    """One row per row and component, numbered from 1; a deviation beyond long is null."""
    return found.select("*", F.posexplode("whitened").alias("at", "value")).select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )
