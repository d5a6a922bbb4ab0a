"""Near-duplicate classes by min-max hashing.

A document is its set of distinct word shingles.  Every permutation of the shingles gives two values, its
minimum and its maximum; each is equal for two sets with probability |intersection| / |union|, so half
the permutations make a signature of the same length, whose share of equal values is unbiased and varies
less.  Values are banded: sets that agree on a whole band are candidates.

Candidates are confirmed on full sets.  The least set of a bucket is its hub; all others are
compared with it, and components of these links settle most groups.  Where a group still spans several
components, it is compared in blocks of bounded size, leaving out what one component joins already.

With the defaults two sets of similarity 0.85 miss each other in all 40 bands of 6 values with probability
6e-9, and more alike ones more rarely, so whole results are expected at any size of corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import mix, stored
from .components import connected_components
from .near_duplicates import fingerprint, overlaps, shingle_sets

WORDS = 5
PERCENT = 85
BANDS = 40
ROWS = 6
TOGETHER = 1 << 17
BITMAP = 1 << 23
BLOCK = 1 << 18

KEY = "struct<fp: bigint, n: int>"


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and terms of `count` permutations x -> factor * x + term of 64-bit words."""
    numbers = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return numbers[:count] | np.uint64(1), numbers[count:]


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """A row per set, none of them empty: the minima of `count` permutations, then their maxima."""
    shingles = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((2 * count, len(sets)), np.uint64)
    with np.errstate(over="ignore"):
        for place, (factor, term) in enumerate(zip(*permutations(count))):
            turned = shingles * factor + term
            out[place] = np.minimum.reduceat(turned, starts)
            out[count + place] = np.maximum.reduceat(turned, starts)
    return out.T


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Estimate of |intersection| / |union| from two signatures."""
    return float((a == b).mean())


def bucket_names(signed: np.ndarray, bands: int) -> np.ndarray:
    """A row per signature: one 64-bit name per band, told apart between bands."""
    cut = signed.reshape(len(signed), bands, -1)
    weights = mix(np.arange(101, 101 + cut.shape[2], dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return mix((cut * weights).sum(axis=2, dtype=np.uint64) + mix(np.arange(1001, 1001 + bands, dtype=np.uint64))).view(np.int64)


def _keys(fps: list[int], sizes: list[int]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(fps, pa.int64()), pa.array(sizes, pa.int32())], names=["fp", "n"])


def _signed(words: int, bands: int, rows: int) -> Callable:
    """Task: (doc_id, key, buckets) of every document; buckets once per distinct set of the task."""

    def named(fresh: list[tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
        if not fresh:
            return {}
        signed = signatures([shingles for _, shingles in fresh], bands * rows // 2)
        return dict(zip((at for at, _ in fresh), bucket_names(signed, bands)))

    def run(batches):
        seen: set = set()
        for batch in batches:
            keys, names = [], {}
            fresh: list = []
            held = 0
            for at, shingles in enumerate(shingle_sets(batch.column(1), words)):
                key = (fingerprint(shingles), len(shingles))
                keys.append(key)
                if not len(shingles) or key in seen:
                    continue
                seen.add(key)
                fresh.append((at, shingles))
                held += len(shingles)
                if held > TOGETHER:
                    names |= named(fresh)
                    fresh, held = [], 0
            names |= named(fresh)
            buckets = pa.array([names.get(at) for at in range(len(keys))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _keys([k[0] for k in keys], [k[1] for k in keys]), buckets], names=["doc_id", "key", "buckets"]
            )

    return run


def _marked(needed: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size with a bit for every needed set, by its hash."""
    words = (
        needed.select(F.col("key.fp").bitwiseAND(F.lit(bits - 1)).alias("bit"))
        .groupBy(F.expr("CAST(bit DIV 32 AS int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 32 AS int)))").alias("bits"))
        .toPandas()
    )
    table = np.zeros(bits // 32, np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return table


def _read_sets(words: int, marked) -> Callable:
    """Task: (key, sh) of the texts whose set may be needed, once per distinct set of the task."""

    def rows(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(shingles) for _, shingles in found]
        lists = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *sizes]).astype(np.int32)), pa.array(np.concatenate([shingles for _, shingles in found]).view(np.int64))
        )
        return pa.RecordBatch.from_arrays([_keys([fp for fp, _ in found], sizes), lists], names=["key", "sh"])

    def run(batches: Iterator[pa.RecordBatch]):
        table, seen = marked.value, set()
        for batch in batches:
            found: list = []
            held = 0
            for shingles in shingle_sets(batch.column(0), words):
                fp = fingerprint(shingles)
                bit = fp & (len(table) * 32 - 1)
                if not len(shingles) or not table[bit >> 5] >> (bit & 31) & 1 or (fp, len(shingles)) in seen:
                    continue
                seen.add((fp, len(shingles)))
                found.append((fp, shingles))
                held += len(shingles)
                if held > TOGETHER:
                    yield rows(found)
                    found, held = [], 0
            if found:
                yield rows(found)

    return run


def _linked(shared, n, m, percent: int):
    return 100 * shared >= percent * (n + m - shared)


class _Block:
    """Some sets of a group, with the components they are in."""

    def __init__(self, rows: pa.Table) -> None:
        lists = rows.column("sh").combine_chunks()
        self.values, self.sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.roots = list(zip(rows.column("root_fp").to_pylist(), rows.column("root_n").to_pylist()))


def _joining(percent: int) -> Callable:
    """Task for a pair of blocks: components that its links join, each linked with the least one that it reaches."""

    def run(rows: pa.Table) -> pa.Table:
        right = rows.column("side").to_numpy() == 1
        a = _Block(rows.filter(pa.array(~right)))
        b = _Block(rows.filter(pa.array(right))) if right.any() else a
        shared = overlaps(a.values, a.sizes, b.values, b.sizes)
        linked = _linked(shared, a.sizes[:, None], b.sizes[None, :], percent)
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
            one, other = sorted((find(a.roots[i]), find(b.roots[j])))
            parent[other] = one
        joined = [(x, find(x)) for x in list(parent) if find(x) != x]
        ends = [pa.array([pair[s][k] for pair in joined], kind) for s in (0, 1) for k, kind in enumerate((pa.int64(), pa.int32()))]
        return pa.table(ends, names=["fp_a", "n_a", "fp_b", "n_b"])

    return run


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """Members of open groups (hub, key, root, main) dealt to the pairs of blocks that they take part in.

    Blocks hold about `block` shingles.  Those of the rest meet each other and those of the hub's
    component, which is joined already and does not meet itself.
    """
    rest = ~F.col("main")
    sizes = members.groupBy("hub").agg(
        F.count(F.when(F.col("key.fp") != F.col("hub"), 1)).alias("others"),
        F.ceil(F.sum(F.when(F.col("main"), F.col("key.n"))) / block).cast("int").alias("mains"),
        F.ceil(F.sum(F.when(rest, F.col("key.n"))) / block).cast("int").alias("rests"),
    )
    # The hub has been compared with all others, so two others are asked for.
    sizes = sizes.where("others >= 2 AND rests > 0").withColumn("mains", F.coalesce("mains", F.lit(0)))
    placed = members.join(sizes, "hub").withColumn(
        "slot", F.pmod(F.xxhash64("key", F.lit(7)), F.when(F.col("main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    )
    among = "transform(sequence(0, rests - 1), j -> struct(least(slot, j) AS i, greatest(slot, j) AS j, IF(slot <= j, 0, 1) AS side))"
    with_main = "IF(mains > 0, transform(sequence(0, mains - 1), j -> struct(slot AS i, -1 - j AS j, 0 AS side)), array())"
    to_rest = "transform(sequence(0, rests - 1), i -> struct(i AS i, -1 - slot AS j, 1 AS side))"
    at = F.explode(F.expr(f"IF(main, {to_rest}, concat({among}, {with_main}))"))
    return placed.withColumn("at", at).select("hub", "at.*", "key.fp", "key.n", F.col("root.fp").alias("root_fp"), F.col("root.n").alias("root_n"), "key")


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    bitmap: int = BITMAP,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Two documents link when 100 * |intersection| >= percent * |union| of their distinct shingles of `words`
    words (a shorter text is one shingle).  component_id is the smallest doc_id reachable; the document
    of that id is kept.  `bands` of `rows` values need bands * rows / 2 permutations; choose them so that
    (1 - (percent / 100) ** rows) ** bands, the chance to miss a link, is next to nothing.

    * Null or wordless text: n_shingles 0, linked with nothing, component_id is its own doc_id, kept.
    * Null doc_id: the row takes part; it never names a component that has another id, and is kept if none has.
    * Repeated rows of one doc_id each give a row, and are kept alike.  Empty table: no rows.
    * Only the two named columns are read; others may have any name.

    Texts are read twice and never shuffled.  The one broadcast is a bitmap of fixed size.  Sets are told
    apart by a 64-bit hash together with their size.
    """
    if bands * rows % 2:
        raise ValueError("bands * rows must be even: every permutation gives two values")
    spark = docs.sparkSession
    root = workspace(spark)
    docs = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    signed = stored(docs.mapInArrow(_signed(words, bands, rows), f"doc_id bigint, key {KEY}, buckets array<bigint>"), "signed", root)
    postings = signed.where("buckets IS NOT NULL").select(F.explode("buckets").alias("bucket"), "key.fp", "key.n")
    shared = postings.groupBy("bucket").agg(F.min("fp").alias("hub"), F.max("fp").alias("most")).where("hub <> most").select("bucket", "hub")
    met = postings.join(shared, "bucket").select("hub", "fp", "n").distinct()
    members = stored(met.select("hub", F.struct("fp", "n").alias("key")), "members", root)
    needed = stored(members.select("key").distinct(), "needed", root)
    table = spark.sparkContext.broadcast(_marked(needed, bitmap))
    read = docs.select("text").mapInArrow(_read_sets(words, table), f"key {KEY}, sh array<bigint>")
    sets = stored(read.join(needed, "key", "left_semi").groupBy("key").agg(F.first("sh").alias("sh")), "sets", root)

    hubs = members.where("key.fp = hub").select("hub", F.col("key").alias("hub_key"))
    n, m = F.col("key.n"), F.col("hub_key.n")
    stars = members.where("key.fp <> hub").join(hubs, "hub").where(F.least(n, m) * 100 >= F.greatest(n, m) * percent).select("key", "hub_key")
    both = stars.join(sets, "key").join(sets.select(F.col("key").alias("hub_key"), F.col("sh").alias("hub_sh")), "hub_key")
    common = F.size(F.array_intersect("sh", "hub_sh"))
    first = both.where(_linked(common, n, m, percent)).select(F.col("key").alias("a"), F.col("hub_key").alias("b"))

    settled = connected_components(first)
    rooted = members.join(settled.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    of_hub = rooted.where("key.fp = hub").groupBy("hub").agg(F.min("root").alias("hub_root"))
    rooted = rooted.join(of_hub, "hub").withColumn("main", F.col("root") == F.col("hub_root")).drop("hub_root")
    second = (
        _dealt(stored(rooted, "rooted", root), block)
        .join(sets, "key")
        .drop("key")
        .groupBy("hub", "i", "j")
        .applyInArrow(_joining(percent), "fp_a bigint, n_a int, fp_b bigint, n_b int")
        .select(F.struct(F.col("fp_a").alias("fp"), F.col("n_a").alias("n")).alias("a"), F.struct(F.col("fp_b").alias("fp"), F.col("n_b").alias("n")).alias("b"))
    )
    # Components found so far stand in for the first links, so few steps are left.
    final = connected_components(settled.select(F.col("node").alias("a"), F.col("root").alias("b")).union(second)).withColumnRenamed("node", "key")

    own = signed.where("key.n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    own = stored(own.join(final, "key", "left").withColumn("root", F.coalesce("root", "key")), "classes", root)
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(own.join(least, "root").select("key", "component_id"), "named", root)
    found = signed.select("doc_id", "key").join(named, "key", "left")
    component = F.when(F.col("key.n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", F.col("key.n").cast("bigint").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
