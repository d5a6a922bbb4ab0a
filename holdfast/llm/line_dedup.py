"""Removal of lines that many documents share, by probing a sharded minimal perfect hash.

1. Every document gives the distinct 128-bit hashes of its long lines; they are counted per hash.
2. Lines found in enough documents are dealt to shards.  Each shard becomes a minimal perfect hash
   (levels of bit arrays; a key's slot is the rank of its bit) with arrays by slot: a 64-bit
   fingerprint, the document count, and the largest document that holds the line.
3. Documents probe these arrays.  While all shards together are within `broadcast_bytes`, measured
   before, every worker holds them and texts are read, probed and given back without a shuffle.
   Beyond it, line hashes (never lines) go to the shards, hot shards dealt to several tasks, and the
   places to drop return to the documents by their id.  Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import BASE, mix, stored, unused

MIN_DOCUMENTS = 5
MIN_CHARS = 40
SHARD_KEYS = 1 << 16
PROBES_PER_TASK = 1 << 19
BROADCAST_BYTES = 32 << 20
BYTES_PER_KEY = 26
BLANKS = "\t\n\x0b\x0c\r "


def line_hashes(text: str | None, min_chars: int) -> tuple[list[str], list[tuple[int, int] | None]]:
    """The lines of a text, and for each the hash of its key, or None if the key is short."""
    lines = (text or "").split("\n")
    out: list[tuple[int, int] | None] = []
    for line in lines:
        key = line.strip(BLANKS)
        if len(key) < min_chars:
            out.append(None)
        else:
            value = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass").lower())
            out.append(((value >> 64) - (1 << 63), (value & 0xFFFFFFFFFFFFFFFF) - (1 << 63)))
    return lines, out


def _spread(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h1.view(np.uint64) ^ mix(h2.view(np.uint64) + np.uint64(level + 1) * BASE))


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimal perfect hash of distinct 128-bit keys: (bits by word, ranks by word, level ends).

    At each level every remaining key points to one of two places per key; keys alone at their
    place settle there, the others try the next level.
    """
    words, ends, level = [], [], 0
    left = np.arange(len(h1))
    while len(left):
        size = -(-2 * len(left) // 64) * 64
        at = (_spread(h1[left], h2[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        ends.append(size + (ends[-1] if ends else 0))
        left = left[~alone[at]]
        level += 1
    bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
    counts = np.bitwise_count(bits).astype(np.int64)
    return bits, np.cumsum(counts) - counts, np.array(ends, np.int64)


def slots(h1: np.ndarray, h2: np.ndarray, bits: np.ndarray, ranks: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Slot of every key; a key that was not built in gets any slot, or -1."""
    out = np.full(len(h1), -1, np.int64)
    left = np.arange(len(h1))
    begin = 0
    for level, end in enumerate(ends.tolist()):
        if not len(left):
            break
        at = (_spread(h1[left], h2[left], level) % np.uint64(end - begin)).astype(np.int64) + begin
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        found = (bits[word] >> bit & np.uint64(1)).astype(bool)
        below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
        out[left[found]] = (ranks[word] + np.bitwise_count(below).astype(np.int64))[found]
        left, begin = left[~found], end
    return out


SHARD = "shard int, bits binary, ranks binary, ends binary, prints binary, counts binary, keepers binary"


def _build(key, frame):
    import pandas as pd

    h1, h2 = frame["h1"].to_numpy(np.int64), frame["h2"].to_numpy(np.int64)
    bits, ranks, ends = build_hash(h1, h2)
    order = np.argsort(slots(h1, h2, bits, ranks, ends))
    arrays = [bits, ranks, ends, h2[order], frame["n_docs"].to_numpy(np.int64)[order], frame["keeper"].to_numpy(np.int64)[order]]
    return pd.DataFrame([[int(key[0]), *(x.tobytes() for x in arrays)]], columns=["shard", "bits", "ranks", "ends", "prints", "counts", "keepers"])


class Shard:
    """The arrays of one shard."""

    def __init__(self, row) -> None:
        self.bits = np.frombuffer(row["bits"], np.uint64)
        self.ranks, self.ends, self.prints, self.counts, self.keepers = (
            np.frombuffer(row[name], np.int64) for name in ("ranks", "ends", "prints", "counts", "keepers")
        )

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document count, keeper) of every line hash; count 0 if the line is not held."""
        at = slots(h1, h2, self.bits, self.ranks, self.ends)
        known = (at >= 0) & (self.prints[at] == h2)
        return np.where(known, self.counts[at], 0), np.where(known, self.keepers[at], 0)


def _shard_of(shards: int):
    return F.pmod(F.shiftright("h1", 32), F.lit(shards)).cast("int")


def _columns(docs: DataFrame, text_column: str, count_names: tuple[str, str]) -> tuple[list[str], str]:
    fields = [f for f in docs.schema.fields if f.name not in count_names]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + "".join(f", `{name}` bigint" for name in count_names)
    return [f.name for f in fields], schema


def _rewritten(
    batches, id_at: int, text_at: int, drop_at: int | None, min_chars: int, dropped_of: Callable[[object, np.ndarray, np.ndarray], np.ndarray] | None
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(id_at).to_pylist()
        texts, lines, dropped = [], [], []
        drops = batch.column(drop_at).to_pylist() if drop_at is not None else None
        for row, text in enumerate(batch.column(text_at)):
            parts, hashes = line_hashes(text.as_py(), min_chars)
            long = [k for k, value in enumerate(hashes) if value]
            gone: set = set()
            if drops is not None:
                lost = {(d["h1"], d["h2"]) for d in drops[row] or ()}
                gone = {k for k in long if hashes[k] in lost}
            elif long:
                h = np.array([hashes[k] for k in long], np.int64)
                gone = {long[k] for k in np.flatnonzero(dropped_of(ids[row], h[:, 0].copy(), h[:, 1].copy()))}
            texts.append("\n".join(p for k, p in enumerate(parts) if k not in gone) if gone else "\n".join(parts))
            lines.append(len(parts))
            dropped.append(len(gone))
        kept = [batch.column(k) for k in range(batch.num_columns) if k != drop_at]
        kept[text_at] = pa.array(texts, batch.schema.field(text_at).type)
        names = [name for k, name in enumerate(batch.schema.names) if k != drop_at]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, "n_lines", "n_dropped"])


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
    shard_keys: int = SHARD_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`docs` with every text less its shared lines, and `n_lines` (before) and `n_dropped`.

    Lines end at \\n.  A line's key is the line without blanks (space, 0x09-0x0D) at both ends and
    with A-Z lower-cased.  Keys of at least `min_chars` code points found in at least
    `min_documents` different ids lose all their lines but those in the largest id that holds them.

    * Null or empty text: one empty line; the result is an empty text.
    * Null id: the row names no document, so it adds nothing to a count and never keeps a shared line.
    * Rows that repeat an id are one document for counting; each is rewritten by itself.
    * Empty table: no rows.  Other columns pass through; columns named n_lines or n_dropped are replaced.
    """
    spark = docs.sparkSession
    root = workspace(spark)

    tag = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.lit(0))
    source = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text")).withColumn("tag", tag)

    def listed(batches):
        for batch in batches:
            rows = []
            for key, text, mark in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                rows += [(key, mark, *pair) for pair in {x for x in line_hashes(text.as_py(), min_chars)[1] if x}]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "tag", "h1", "h2"])

    lines = source.mapInArrow(listed, "id bigint, tag bigint, h1 bigint, h2 bigint")
    shared = lines.where("id IS NOT NULL").groupBy("h1", "h2").agg(F.countDistinct("id").alias("n_docs"), F.max("id").alias("keeper")).where(F.col("n_docs") >= min_documents)
    shared = stored(shared, "shared", root)
    keys = shared.count()
    shards = max(1, -(-keys // shard_keys))
    index = stored(shared.withColumn("shard", _shard_of(shards)).groupBy("shard").applyInPandas(_build, SHARD), "index", root)

    names, schema = _columns(docs, text_column, ("n_lines", "n_dropped"))
    docs = docs.select(*(F.col(f"`{name}`") for name in names))
    id_at, text_at = names.index(id_column), names.index(text_column)

    if keys * BYTES_PER_KEY <= broadcast_bytes:
        held = spark.sparkContext.broadcast({row["shard"]: row.asDict() for row in index.collect()})

        def rewritten(batches):
            tables = {number: Shard(row) for number, row in held.value.items()}

            def dropped_of(key, h1, h2):
                out = np.zeros(len(h1), bool)
                home = (h1 >> 32) % shards
                for number in np.unique(home).tolist():
                    if number in tables:
                        at = home == number
                        counts, keepers = tables[number].probe(h1[at], h2[at])
                        out[at] = (counts >= min_documents) & (keepers != key if key is not None else True)
                return out

            yield from _rewritten(batches, id_at, text_at, None, min_chars, dropped_of)

        return docs.mapInArrow(rewritten, schema)

    probes = stored(lines.distinct().withColumn("shard", _shard_of(shards)), "probes", root)
    parts = stored(probes.groupBy("shard").agg(F.ceil(F.count("*") / PROBES_PER_TASK).cast("int").alias("parts")), "parts", root)
    dealt = probes.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("id", "tag"), "parts").cast("int"))
    copies = index.join(parts, "shard").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))

    def probed(key, left, right):
        import pandas as pd

        if not len(right) or not len(left):
            return pd.DataFrame({"id": [], "tag": [], "h1": [], "h2": []}, dtype="Int64")
        h1, h2 = left["h1"].to_numpy(np.int64), left["h2"].to_numpy(np.int64)
        counts, keepers = Shard(right.iloc[0]).probe(h1, h2)
        left["id"] = left["id"].astype("Int64")
        keeps = (left["id"] == pd.Series(keepers, index=left.index)).fillna(False).to_numpy(bool)
        return left.loc[(counts >= min_documents) & ~keeps, ["id", "tag", "h1", "h2"]]

    drops = dealt.select("shard", "part", "id", "tag", "h1", "h2").groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInPandas(
        probed, "id bigint, tag bigint, h1 bigint, h2 bigint"
    )
    drops = drops.groupBy("id", "tag").agg(F.collect_list(F.struct("h1", "h2")).alias("drops"))
    own_id = F.col(f"d.`{id_column}`").cast("bigint")
    own_tag = F.when(own_id.isNull(), F.xxhash64(F.col(f"d.`{text_column}`"))).otherwise(F.lit(0))
    known = docs.alias("d").join(drops.alias("e"), own_id.eqNullSafe(F.col("e.id")) & (own_tag == F.col("e.tag")), "left")
    return known.select("d.*", F.col("e.drops").alias(unused("drops", names))).mapInArrow(
        lambda batches: _rewritten(batches, id_at, text_at, len(names), min_chars, None), schema
    )
