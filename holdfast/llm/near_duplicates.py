"""Near-duplicate classes by an exact Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word shingles.  All sets are put in one global order, rare
shingles first (by a counting sketch of all documents, then by hash; the order decides cost, never
the result).  If two sets of sizes n and m are similar enough, then for every k their prefixes of
length n - need(n) + k and m - need(m) + k share at least k shingles.  Each document takes the k
that its estimated candidates make cheapest: a longer prefix is dearer to post, but asks for more
shared shingles before two documents are compared.

Steps, each linear in what it reads:

1. count shingles in a sketch of fixed size, and name each distinct set by a hash of its content;
   equal sets are one class from here on;
2. post prefixes by shingle; lists are cut where sizes are too far apart to link, and the first
   document of every piece is its hub.  Whatever two documents that could link share, they meet in
   the group of that shingle's hub;
3. compare each document with its hubs; components of those links settle most groups;
4. where a group still spans several components, compare it in blocks of bounded size, leaving out
   what one component already joins.  Only links that join something new leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import mix, slices, stored, text_bytes, unused, word_hashes
from .components import connected_components

WORDS = 5
PERCENT = 75
SKETCH = 1 << 22
SKETCH_BLOCK = 1 << 14
BITMAP = 1 << 23
EXTRA = (1, 2, 3, 4, 6, 8)
BLOCK = 256
COLUMNS = 8192
VERIFY_COST = 0.02

KEY = "struct<fp: bigint, n: int>"


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For every text, in order, its distinct shingles as sorted 64-bit hashes."""
    data, offsets = text_bytes(column)
    weights = mix(np.arange(11, 11 + words, dtype=np.uint64))
    for first, last in slices(offsets):
        begin, end = offsets[first], offsets[last]
        hashes, places = word_hashes(data[begin:end], offsets[first : last + 1] - begin)
        with np.errstate(over="ignore"):
            if len(hashes) >= words:
                rolled = hashes[: len(hashes) - words + 1] * weights[0]
                for place in range(1, words):
                    rolled = rolled + hashes[place : len(hashes) - words + 1 + place] * weights[place]
                rolled = mix(rolled)
            for low, high in zip(places[:-1].tolist(), places[1:].tolist()):
                count = high - low
                if count >= words:
                    yield np.unique(rolled[low : high - words + 1])
                elif count:
                    yield mix((hashes[low:high] * weights[:count]).sum(keepdims=True) + np.uint64(count))
                else:
                    yield hashes[:0]


def fingerprint(shingles: np.ndarray) -> int:
    """A hash of a set, whatever its order."""
    with np.errstate(over="ignore"):
        return int(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))


def _counted(words: int, sketch: int):
    """Task: (doc_id, fp, n) of every document, then this task's share of the sketch."""

    def run(batches):
        counts, seen = np.zeros(sketch, np.uint32), set()
        for batch in batches:
            fps, sizes = [], []
            for shingles in shingle_sets(batch.column(1), words):
                fp = fingerprint(shingles)
                fps.append(fp)
                sizes.append(len(shingles))
                if len(shingles) and fp not in seen:
                    seen.add(fp)
                    np.add.at(counts, (shingles & np.uint64(sketch - 1)).astype(np.int64), 1)
            n = len(fps)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64()), pa.array(sizes, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names=["doc_id", "fp", "n", "part", "counts"],
            )
        parts = np.flatnonzero(counts.reshape(-1, SKETCH_BLOCK).any(axis=1))
        n = len(parts)
        packed = [_pack(counts[k * SKETCH_BLOCK : (k + 1) * SKETCH_BLOCK]) for k in parts.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(parts.astype(np.int32)), pa.array(packed, pa.binary())],
            names=["doc_id", "fp", "n", "part", "counts"],
        )

    return run


def _pack(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint32)


def _combined(batches):
    """Task: its rows of every part of the sketch as one; all parts together have the size of the sketch."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = _unpack(packed.as_py())
            totals[part] = totals[part] + counts if part in totals else counts
    for part, counts in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_pack(counts)], pa.binary())], names=["part", "counts"])


def _added(rows: pa.Table) -> pa.Table:
    """One part of the sketch as the sum of several tasks' counts."""
    total = np.zeros(SKETCH_BLOCK, np.uint32)
    for packed in rows.column("counts"):
        total += _unpack(packed.as_py())
    return pa.table({"part": rows.column("part")[:1], "counts": pa.array([_pack(total)], pa.binary())})


def _sketch(counted: DataFrame, sketch: int) -> np.ndarray:
    """The sums of all tasks' counts, added up where they are read and then in two steps of about as many rows each; of fixed size."""
    parts = counted.where("part IS NOT NULL").select("part", "counts")
    turns = math.isqrt(max(parts.rdd.getNumPartitions() - 1, 0)) + 1
    parts = parts.mapInArrow(_combined, "part int, counts binary").withColumn("turn", F.pmod(F.xxhash64("counts"), F.lit(turns)))
    parts = parts.groupBy("part", "turn").applyInArrow(_added, "part int, counts binary").groupBy("part").applyInArrow(_added, "part int, counts binary")
    out = np.zeros(sketch, np.uint32)
    for row in parts.collect():
        out[row["part"] * SKETCH_BLOCK : (row["part"] + 1) * SKETCH_BLOCK] = _unpack(bytes(row["counts"]))
    return out


def least_overlap(n: int, percent: int) -> int:
    """The fewest shingles a set of n shares with any set that is similar enough."""
    return -(-n * percent // 100)


def choose_extra(n: int, need: int, frequencies: np.ndarray) -> int:
    """How many shared prefix shingles to ask for: least posting cost plus comparing cost.

    `frequencies`: estimated documents per shingle, in the global order.  A prefix with k
    extra places meets at most (sum of its frequencies) / k candidates.
    """
    others = np.cumsum(np.maximum(frequencies - 1, 0))
    best, best_cost = 1, None
    for k in EXTRA:
        if k > need:
            break
        length = n - need + k
        met = float(others[length - 1])
        cost = length + met + VERIFY_COST * n * met / k
        if best_cost is None or cost < best_cost:
            best, best_cost = k, cost
    return best


def _posted(words: int, percent: int, sketch):
    """Task: one row per distinct set and prefix shingle.

    Most of these rows are shuffled and then met by no other, so they are narrow: `size` is n with the place of extra in EXTRA as its last three bits.
    """

    def run(batches):
        counts = sketch.value
        floor = float(np.median(counts))
        floor += 3 * floor**0.5
        seen = set()
        for batch in batches:
            parts: list[tuple] = []
            docs = batch.column(0)
            for row, shingles in enumerate(shingle_sets(batch.column(1), words)):
                n = len(shingles)
                fp = fingerprint(shingles)
                if not n or fp in seen:
                    continue
                seen.add(fp)
                frequency = counts[(shingles & np.uint64(len(counts) - 1)).astype(np.int64)]
                order = np.lexsort((shingles, frequency))
                need = least_overlap(n, percent)
                extra = choose_extra(n, need, np.maximum(frequency[order] - floor, 1.0))
                taken = shingles[order[: n - need + extra]]
                parts.append((taken.view(np.int64), docs[row].as_py(), fp, n << 3 | EXTRA.index(extra)))
                if sum(len(p[0]) for p in parts[-64:]) > 1 << 20 or len(parts) >= 2000:
                    yield _rows(parts)
                    parts = []
            if parts:
                yield _rows(parts)

    def _rows(parts):
        lengths = [len(p[0]) for p in parts]
        docs = pa.array([p[1] for p in parts], pa.int64()).take(pa.array(np.repeat(np.arange(len(parts)), lengths)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([p[0] for p in parts])),
                docs,
                pa.array(np.repeat(np.array([p[2] for p in parts], np.int64), lengths)),
                pa.array(np.repeat(np.array([p[3] for p in parts], np.int32), lengths)),
            ],
            names=["token", "doc_id", "fp", "size"],
        )

    return run


def _hubs(batches, percent: int = PERCENT):
    """Task over postings sorted by token and doc_id: each document of a shared token, with the token's hub.

    A list that lies in one batch is cut where, by size, the next larger set is too large for the one before to link
    with it; every piece has its first document as hub.  Sets that can link are never cut apart, and a piece of one set gives no rows.
    """
    last_token, last = None, (0, 0, 0)
    for batch in batches:
        if not batch.num_rows:
            continue
        token, fp, size = (batch.column(k).to_numpy() for k in (0, 2, 3))
        n, extra = (size >> 3).astype(np.int64), np.array(EXTRA)[size & 7]
        starts = np.ones(len(token) + 1, bool)
        starts[1:-1] = token[1:] != token[:-1]
        carried = last_token is not None and token[0] == last_token
        at = np.maximum.accumulate(np.where(starts[:-1], np.arange(len(token)), 0))
        shared = ~(starts[:-1] & starts[1:])
        shared[0] |= carried
        rows = np.flatnonzero(shared)
        hub = at[rows]
        whole = (hub != at[-1]) & ~(carried & (hub == 0))
        order = np.lexsort((n[rows], hub))
        cut = np.ones(len(rows), bool)
        cut[1:] = hub[order][1:] != hub[order][:-1]
        cut[1:] |= whole[order][1:] & (n[rows][order][:-1] * 100 < n[rows][order][1:] * percent)
        piece = np.empty(len(rows), np.int64)
        piece[order] = np.cumsum(cut) - 1
        _, first, piece = np.unique(piece, return_index=True, return_inverse=True)
        hub = rows[first][piece]
        hub_fp, hub_n, hub_extra = fp[hub], n[hub], extra[hub]
        if carried:
            hub_fp, hub_n, hub_extra = (np.where(at[rows] == 0, old, new) for old, new in zip(last, (hub_fp, hub_n, hub_extra)))
        last_token = token[-1]
        if not carried or at[-1]:
            last = fp[at[-1]], n[at[-1]], extra[at[-1]]
        member = np.flatnonzero((fp[rows] != hub_fp) | (n[rows] != hub_n))
        if not len(member):
            continue
        first = member[np.unique(piece[member], return_index=True)[1]]
        key = lambda a, b: pa.StructArray.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int32))], names=["fp", "n"])
        own_fp, own_n, own_extra = (np.concatenate((x[rows][member], y[first])) for x, y in ((fp, hub_fp), (n, hub_n), (extra, hub_extra)))
        both = np.concatenate((member, first))
        yield pa.RecordBatch.from_arrays(
            [key(own_fp, own_n), pa.array(own_extra.astype(np.int32)), pa.array(token[rows][both]), key(hub_fp[both], hub_n[both])],
            names=["key", "extra", "token", "hub"],
        )


def _prefix(n: str, extra: str, percent: int):
    return F.col(n) - F.ceil(F.col(n) * percent / F.lit(100)) + F.col(extra)


def _could_link(percent: int, shared, left: str, right: str):
    """Whether two sets with so many shared prefix shingles can be similar enough.

    Shared shingles outside both prefixes lie beyond the end of the prefix that ends first.
    """
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    need = F.ceil((n + m) * percent / F.lit(100 + percent))
    rest = F.greatest(n - F.col(f"{left}_prefix"), m - F.col(f"{right}_prefix"))
    return (
        (F.least(n, m) * 100 >= F.greatest(n, m) * percent)
        & (shared >= F.least(F.col(f"{left}_extra"), F.col(f"{right}_extra")))
        & (shared + rest >= need)
    )


def _could_share(percent: int, most, left: str, right: str):
    """Whether `_could_link` can hold where no more than `most` is shared and only the size of the right set is known.

    Its extra is then taken as the least there is, which makes its rest the longest.
    """
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    need = F.ceil((n + m) * percent / F.lit(100 + percent))
    rest = F.greatest(n - F.col("prefix"), F.ceil(m * percent / F.lit(100)) - EXTRA[0])
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (most + rest >= need)


def overlaps(a: np.ndarray, sizes_a: np.ndarray, b: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of two blocks of sets (laid end to end), by products of 0/1 matrices in column blocks."""
    rows_a, rows_b = np.repeat(np.arange(len(sizes_a)), sizes_a), np.repeat(np.arange(len(sizes_b)), sizes_b)
    common = np.intersect1d(a, b)
    total = np.zeros((len(sizes_a), len(sizes_b)), np.int64)
    if not len(common):
        return total

    def placed(values, rows):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        keep = common[at] == values
        order = np.argsort(at[keep], kind="stable")
        return at[keep][order], rows[keep][order]

    at_a, rows_a = placed(a, rows_a)
    at_b, rows_b = placed(b, rows_b)
    for low in range(0, len(common), COLUMNS):
        width = min(COLUMNS, len(common) - low)
        dense = []
        for at, rows, count in ((at_a, rows_a, len(sizes_a)), (at_b, rows_b, len(sizes_b))):
            i, j = np.searchsorted(at, (low, low + width))
            block = np.zeros((count, width), np.float32)
            block[rows[i:j], at[i:j] - low] = 1
            dense.append(block)
        total += np.rint(dense[0] @ dense[1].T).astype(np.int64)
    return total


class Side:
    """One block of a block pair, as arrays."""

    def __init__(self, rows: pa.Table, sets: str) -> None:
        self.columns = {name: rows.column(name).to_numpy() for name in rows.column_names if not name.startswith("hub") and name != sets}
        lists = rows.column(sets).combine_chunks()
        self.values, self.sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False)
        self.n = self.columns["n"].astype(np.int64)

    def __len__(self) -> int:
        return len(self.n)


def _sides(rows: pa.Table, sets: str) -> tuple[Side, Side, bool]:
    """The two blocks of a block pair; a block that meets itself is given twice."""
    right = rows.column("side").to_numpy() == 1
    if not right.any():
        both = Side(rows, sets)
        return both, both, True
    return Side(rows.filter(pa.array(~right)), sets), Side(rows.filter(pa.array(right)), sets), False


def _flag(percent: int):
    """Task for a block pair of a group: the members that could link to another one, of another component where roots are given."""

    def run(rows: pa.Table) -> pa.Table:
        left, right, same = _sides(rows, "tokens")
        n, m = left.n[:, None], right.n[None, :]
        could = np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
        if "root_fp" in left.columns:
            could &= (left.columns["root_fp"][:, None] != right.columns["root_fp"]) | (left.columns["root_n"][:, None] != right.columns["root_n"])
        if same:
            np.fill_diagonal(could, False)
        if could.any():
            shared = overlaps(left.values, left.sizes, right.values, right.sizes)
            rest = np.maximum(n - left.columns["prefix"][:, None], m - right.columns["prefix"][None, :])
            asked = np.minimum(left.columns["extra"][:, None], right.columns["extra"][None, :])
            could &= (shared >= asked) & (shared + rest >= -(-(n + m) * percent // (100 + percent)))
        fp, size = (np.concatenate((left.columns[x][could.any(axis=1)], right.columns[x][could.any(axis=0)])) for x in ("fp", "n"))
        hub = [pa.repeat(rows.column(name)[0], len(fp)) for name in ("hub_fp", "hub_n")]
        return pa.table([*hub, pa.array(fp), pa.array(size)], names=["hub_fp", "hub_n", "fp", "n"])

    return run


def _join_blocks(percent: int):
    """Task for a block pair of a group: links that join what nothing joined before, as a forest."""

    def run(rows: pa.Table) -> pa.Table:
        left, right, _ = _sides(rows, "sh")
        shared = overlaps(left.values, left.sizes, right.values, right.sizes)
        linked = 100 * shared >= percent * (left.n[:, None] + right.n[None, :] - shared)
        linked &= (left.columns["root_fp"][:, None] != right.columns["root_fp"]) | (left.columns["root_n"][:, None] != right.columns["root_n"])
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        roots = [list(zip(x.columns["root_fp"].tolist(), x.columns["root_n"].tolist())) for x in (left, right)]
        at: tuple[list[int], list[int]] = ([], [])
        for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
            a, b = find(roots[0][i]), find(roots[1][j])
            if a != b:
                parent[a] = b
                at[0].append(i)
                at[1].append(j)
        columns = [pa.array(x.columns[name][np.array(k, np.int64)]) for x, k in ((left, at[0]), (right, at[1])) for name in ("fp", "n")]
        return pa.table(columns, names=["fp_a", "n_a", "fp_b", "n_b"])

    return run


def _key(fp: str, n: str):
    return F.struct(F.col(fp).alias("fp"), F.col(n).alias("n"))


def _block_pairs(members: DataFrame, mains: str, rests: str) -> DataFrame:
    """Deal members (with `main` and `slot`) to the pairs of blocks they take part in.

    Blocks of the rest meet each other and those of the main component; blocks of the main
    component, which are joined already, never meet each other.
    """
    rest = F.expr(
        f"transform(sequence(0, {rests} - 1), j -> struct(least(slot, j) AS i, greatest(slot, j) AS j, CAST(IF(slot <= j, 0, 1) AS int) AS side))"
    )
    rest_main = F.expr(f"IF({mains} > 0, transform(sequence(0, {mains} - 1), j -> struct(slot AS i, -1 - j AS j, CAST(0 AS int) AS side)), array())")
    main = F.expr(f"IF({rests} > 0, transform(sequence(0, {rests} - 1), i -> struct(i AS i, -1 - slot AS j, CAST(1 AS int) AS side)), array())")
    return members.withColumn("at", F.explode(F.when(F.col("main"), main).otherwise(F.concat(rest, rest_main)))).select("*", "at.*").drop("at")


def _needed_sets(docs: DataFrame, needed: DataFrame, words: int, bitmap: int, root: str) -> DataFrame:
    """(key, sh, and the other columns of `needed`): the shingles of each needed set, read from the texts again.

    A bitmap of fixed size, set by the needed sets, keeps the others inside their task.
    """
    bits = (
        needed.select((F.col("key.fp").bitwiseAND(F.lit(bitmap - 1))).alias("bit"))
        .groupBy(F.expr("CAST(bit DIV 32 AS int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 32 AS int)))").alias("bits"))
        .toPandas()
    )
    table = np.zeros(bitmap // 32, np.int64)
    table[bits["word"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        seen = set()
        table = shared.value
        for batch in batches:
            fps, found = [], []
            for shingles in shingle_sets(batch.column(0), words):
                fp = fingerprint(shingles)
                bit = fp & (bitmap - 1)
                if len(shingles) and table[bit >> 5] >> (bit & 31) & 1 and fp not in seen:
                    seen.add(fp)
                    fps.append(fp)
                    found.append(shingles.view(np.int64))
                    if sum(map(len, found[-32:])) > 1 << 19 or len(found) >= 1000:
                        yield rows(fps, found)
                        fps, found = [], []
            if found:
                yield rows(fps, found)

    def rows(fps, found):
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        key = pa.StructArray.from_arrays([pa.array(fps, pa.int64()), pa.array(sizes)], names=["fp", "n"])
        return pa.RecordBatch.from_arrays(
            [key, pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(np.concatenate(found)))], names=["key", "sh"]
        )

    texts = docs.select("text").mapInArrow(run, f"key {KEY}, sh array<bigint>")
    return stored(texts.join(needed, "key").groupBy("key").agg(*(F.first(c).alias(c) for c in ("sh", *needed.columns) if c != "key")), "sets", root)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    block: int = BLOCK,
    sketch: int = SKETCH,
    bitmap: int = BITMAP,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`.

    Two documents link when 100 * |intersection| >= percent * |union| of their distinct shingles of
    `words` words (a shorter text is one shingle).  component_id is the smallest doc_id reachable.

    * Null or wordless text: n_shingles 0, linked with nothing, component_id is its own doc_id.
    * Null doc_id: the row takes part; it never names a component that has another id.
    * Repeated rows, also of one doc_id, each give a row.  Empty table: no rows.
    * Only the two named columns are read; others may have any name.

    Texts are read three times and never shuffled.  What is broadcast has the fixed sizes `sketch`
    (counters, a multiple of 2^14) and `bitmap` (bits).  Sets are told apart by a 64-bit hash together with their size.
    """
    found = classes(docs, id_column, text_column, words, percent, block, sketch, bitmap)
    return found.select(
        "doc_id",
        F.col("key.n").cast("bigint").alias("n_shingles"),
        F.when(F.col("key.n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, one of each class of near duplicates: that of the smallest id, null ids last.

    Rows without words are alike to nothing and all stay.  Columns are as they were.
    """
    found = classes(docs, id_column, text_column, words, percent)
    first = found.where("key.n > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first"))
    first_id, first_key, own_key = (unused(name, docs.columns) for name in ("first_id", "first_key", "own_key"))
    first = stored(first.select(F.col("first.doc_id").alias(first_id), F.col("first.key").alias(first_key)), "first-of-class")
    text_at = docs.columns.index(text_column)

    def keyed(batches):
        for batch in batches:
            sets = [(fingerprint(x), len(x)) for x in shingle_sets(batch.column(text_at), words)]
            key = pa.StructArray.from_arrays([pa.array([x[0] for x in sets], pa.int64()), pa.array([x[1] for x in sets], pa.int32())], names=["fp", "n"])
            yield pa.RecordBatch.from_arrays([*batch.columns, key], names=[*batch.schema.names, own_key])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    rows = docs.mapInArrow(keyed, f"{schema}, `{own_key}` {KEY}")
    own = F.col(f"`{id_column}`").cast("bigint")
    kept = rows.where(f"`{own_key}`.n > 0").join(first, own.eqNullSafe(F.col(first_id)) & (F.col(own_key) == F.col(first_key)), "left_semi")
    return kept.dropDuplicates([id_column, own_key]).unionByName(rows.where(f"`{own_key}`.n = 0")).drop(own_key)


def classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    block: int = BLOCK,
    sketch: int = SKETCH,
    bitmap: int = BITMAP,
) -> DataFrame:
    """(doc_id, key, root, component_id) for every row: its set, and the class and smallest id of what it links to."""
    spark = docs.sparkSession
    root = workspace(spark)
    docs = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    counted = stored(docs.mapInArrow(_counted(words, sketch), "doc_id bigint, fp bigint, n int, part int, counts binary"), "counted", root)
    rows = counted.where("part IS NULL").select("doc_id", F.struct("fp", "n").alias("key"))
    counts = _sketch(counted, sketch)

    posted = docs.mapInArrow(_posted(words, percent, spark.sparkContext.broadcast(counts)), "token bigint, doc_id bigint, fp bigint, size int")
    met = (
        posted.repartition("token")
        .sortWithinPartitions("token", F.col("doc_id").asc_nulls_last(), "fp")
        .mapInArrow(lambda batches: _hubs(batches, percent), f"key {KEY}, extra int, token bigint, hub {KEY}")
    )
    sets = stored(
        met.groupBy("key").agg(F.max("extra").alias("extra"), F.collect_set("token").alias("tokens"), F.collect_set("hub").alias("hubs")),
        "members",
        root,
    ).withColumn("prefix", _prefix("key.n", "extra", percent).cast("int"))

    joined = sets.withColumn("hub", F.explode("hubs")).drop("hubs")
    hubs = sets.where(F.array_contains("hubs", F.col("key"))).select(
        F.col("key").alias("hub"), F.col("extra").alias("hub_extra"), F.col("prefix").alias("hub_prefix"), F.col("tokens").alias("hub_tokens")
    )
    stars = stored(
        joined.where("key != hub")
        .where(_could_share(percent, F.size("tokens"), "key", "hub"))
        .withColumnsRenamed({"extra": "key_extra", "prefix": "key_prefix"})
        .join(hubs, "hub")
        .withColumn("shared", F.size(F.array_intersect("tokens", "hub_tokens")))
        .where(_could_link(percent, F.col("shared"), "key", "hub"))
        .select("key", "hub"),
        "stars",
        root,
    )

    def in_groups(members: DataFrame, name: str) -> DataFrame:
        """Members dealt to block pairs, of groups that are not all of the main component.

        The stars have compared the hub with every member, so two others are asked for, whether the hub is among `members` or not.
        """
        size = members.groupBy("hub").agg(
            F.count("*").alias("members"), F.count(F.when(F.col("main"), 1)).alias("of_main"), F.count(F.when(F.col("key") != F.col("hub"), 1)).alias("others")
        )
        size = stored(
            size.where("others >= 2 AND members > of_main").select(
                "hub", F.ceil(F.col("of_main") / block).cast("int").alias("mains"), F.ceil((F.col("members") - F.col("of_main")) / block).cast("int").alias("rests")
            ),
            name,
            root,
        )
        dealt = members.join(size, "hub").withColumn("slot", F.pmod(F.xxhash64("key", F.lit(7)), F.when(F.col("main"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
        keys = ["hub.fp AS hub_fp", "hub.n AS hub_n", "i", "j", "side", "key.fp", "key.n"]
        others = [c for c in members.columns if c not in ("hub", "key", "main", "root")]
        return _block_pairs(dealt, "mains", "rests").selectExpr(*keys, *others, *(["root.fp AS root_fp", "root.n AS root_n"] if "root" in members.columns else []))

    def flags(members: DataFrame, name: str) -> DataFrame:
        found = in_groups(members, f"{name}-groups").groupBy("hub_fp", "hub_n", "i", "j").applyInArrow(_flag(percent), "hub_fp bigint, hub_n int, fp bigint, n int")
        return found.select(_key("hub_fp", "hub_n").alias("hub"), _key("fp", "n").alias("key"))

    flagged = stored(flags(joined.withColumn("main", F.lit(False)), "all").select("key").distinct(), "flagged", root)
    # Each set takes its hubs along, so that it is dealt to them as it is and not joined with the stars again.
    needed = flagged.select("key", F.lit(False).alias("is_hub"), F.lit(None).cast(KEY).alias("hub")).union(stars.select("key", F.lit(False), "hub"))
    needed = needed.union(stars.select("hub", F.lit(True), F.lit(None).cast(KEY)))
    needed = needed.groupBy("key").agg(F.max("is_hub").alias("is_hub"), F.collect_list("hub").alias("hubs"))
    marked = _needed_sets(docs, stored(needed, "needed", root), words, bitmap, root)
    shingles = marked.select("key", "sh")

    shared = F.size(F.array_intersect("sh", "hub_sh"))
    first = (
        marked.select("key", "sh", F.explode("hubs").alias("hub"))
        .join(marked.where("is_hub").select(F.col("key").alias("hub"), F.col("sh").alias("hub_sh")), "hub")
        .withColumn("shared", shared)
        .where(F.col("shared") * 100 >= (F.col("key.n") + F.col("hub.n") - F.col("shared")) * percent)
        .select(F.col("key").alias("a"), F.col("hub").alias("b"))
    )
    first = stored(first, "first", root)
    settled = stored(connected_components(first), "settled", root)

    roots = stored(
        flagged.join(settled.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("root")), "roots", root
    )
    members = joined.select("key", "hub").join(roots, "key")
    of_hub = members.where("key = hub").select("hub", F.col("root").alias("hub_root"))
    members = members.join(of_hub, "hub", "left").withColumn("main", F.coalesce(F.col("root") == F.col("hub_root"), F.lit(False)))
    open_groups = stored(
        members.groupBy("hub").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least != most").select("hub"), "open", root
    )
    members = stored(members.join(open_groups, "hub", "left_semi"), "open-members", root)
    live = flags(members.select("hub", "key", "root", "main").join(sets.select("key", "tokens", "extra", "prefix"), "key"), "open").distinct()
    live = stored(members.select("hub", "key", "root", "main").join(live, ["hub", "key"], "left_semi"), "live", root)
    second = (
        in_groups(live.join(shingles, "key"), "live-groups")
        .groupBy("hub_fp", "hub_n", "i", "j")
        .applyInArrow(_join_blocks(percent), "fp_a bigint, n_a int, fp_b bigint, n_b int")
        .select(_key("fp_a", "n_a").alias("a"), _key("fp_b", "n_b").alias("b"))
    )
    links = stored(first.union(second), "links", root)
    final = connected_components(links)

    members = rows.where("key.n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    members = members.join(final.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    members = stored(members, "classes", root)
    names = stored(members.groupBy("root").agg(F.min("least").alias("component_id")), "names", root)
    named = stored(members.join(names, "root").select("key", "root", "component_id"), "named", root)
    return rows.join(named, "key", "left").select("doc_id", "key", "root", "component_id")
