"""Incremental tables on plain Parquet folders.

Every micro-batch writes a folder of its own, named by the batch id, and never
touches another one.  A replayed batch overwrites its folder with the same rows, and
a lost executor only costs the tasks it ran.  Now and then a copy of what the batches add up to is
written; reads open the newest copy and the folders after it, found by their names.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import folder_names, is_written, shuffles_dropped
from ..sources.files import FEW, FEW_BLOCK, open_files

NOW = 2**62


def nothing(spark: SparkSession, layout: T.StructType) -> DataFrame:
    """No rows, which the planner knows: unions and joins with them go."""
    return spark.createDataFrame([], layout).limit(0)


@dataclass(frozen=True)
class BatchFolders:
    """Folders `source=S/batch_id=N` below one path, read as one table.

    Batch ids count per query, so each query that writes names itself as a source.  With
    `partition_by`, a batch has a folder for each value of these columns, which are part of the layout.
    Where these are `few`, every task writes its own rows of each, and no row is shuffled for it.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    few: bool = False

    def folder(self, source: str, batch_id: int) -> str:
        return f"{self.path}/source={source}/batch_id={batch_id}"

    def write(self, df: DataFrame, batch_id: int, source: str = "feed") -> None:
        if self.partition_by and not self.few:
            df = df.hint("rebalance", *self.partition_by)
        writer = df.write.mode("overwrite").option("compression", "zstd").partitionBy(*self.partition_by)
        with shuffles_dropped(df.sparkSession):
            if self.few:
                with open_files(df.sparkSession):
                    writer.option("parquet.block.size", FEW_BLOCK).parquet(self.folder(source, batch_id))
            else:
                writer.parquet(self.folder(source, batch_id))

    def sources(self) -> list[str]:
        return [name.removeprefix("source=") for name in folder_names(self.spark, self.path)]

    def batches(self, source: str = "feed") -> list[int]:
        """Ids of the batches written in full, ascending; reads names only."""
        names = (name for name in folder_names(self.spark, f"{self.path}/source={source}"))
        ids = (int(name.removeprefix("batch_id=")) for name in names)
        return sorted(n for n in ids if is_written(self.spark, self.folder(source, n)))

    def read(self, picked: Iterable[tuple[str, int]] | None = None) -> DataFrame:
        """All batches, or those given as (source, batch id); no other folder is opened."""
        if picked is None:
            picked = [(source, batch_id) for source in self.sources() for batch_id in self.batches(source)]
        return self.read_folders([self.folder(source, batch_id) for source, batch_id in picked])

    def read_folders(self, paths: list[str]) -> DataFrame:
        layout = T.StructType(
            [
                *self.schema.fields,
                T.StructField("source", T.StringType()),
                T.StructField("batch_id", T.LongType()),
            ]
        )
        if not paths:
            return nothing(self.spark, layout)
        return self.spark.read.schema(layout).option("basePath", self.path).parquet(*paths)


@dataclass(frozen=True)
class BatchLog:
    """Rows of all batches.  Subclasses say what several batches add up to.

    `compact` writes what one source's batches add up to, up to a batch, as a copy; older batches
    of that source are no longer read.
    """

    spark: SparkSession
    path: str
    schema: T.StructType

    def folded(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.fieldNames())

    def _folders(self) -> BatchFolders:
        return BatchFolders(self.spark, f"{self.path}/batches", self.schema)

    def _copies(self) -> BatchFolders:
        return BatchFolders(self.spark, f"{self.path}/copies", self.schema)

    def add(self, rows: DataFrame, batch_id: int, source: str = "feed") -> None:
        self._folders().write(rows.select(*self.schema.fieldNames()), batch_id, source)

    def added(self, batch_id: int, source: str = "feed") -> DataFrame:
        """The rows that one batch added."""
        return self._folders().read([(source, batch_id)]).select(*self.schema.fieldNames())

    def versions(self) -> dict[str, int]:
        """The last batch of each source."""
        folders = self._folders()
        found = {source: folders.batches(source) for source in folders.sources()}
        return {source: batches[-1] for source, batches in found.items() if batches}

    def _rows(self, upto: dict[str, int], after: dict[str, int] | None = None) -> DataFrame:
        """Rows of batches up to those given: the newest copies and the batches since.  With `after`, only batches after those."""
        folders, copies = self._folders(), self._copies()
        batches, bases = [], []
        for source, last in upto.items():
            if after is None:
                base = max((n for n in copies.batches(source) if n <= last), default=-1)
                bases += [(source, base)] if base >= 0 else []
            else:
                base = after.get(source, -1)
            batches += [(source, n) for n in folders.batches(source) if base < n <= last]
        return folders.read(batches).unionByName(copies.read(bases))

    def read(self, upto: dict[str, int] | None = None) -> DataFrame:
        """The table now, or as it was after the given batches."""
        return self.folded(self._rows(self.versions() if upto is None else upto))

    def compact(self, batch_id: int, source: str = "feed") -> None:
        """Write what one source adds up to, up to and with `batch_id`, as a copy."""
        # A copy of this id from an earlier try is not read, so a replay writes the same rows.
        rows = self._rows({source: batch_id - 1}).unionByName(self._folders().read([(source, batch_id)]))
        self._copies().write(self.folded(rows).select(*self.schema.fieldNames()), batch_id, source)


@dataclass(frozen=True)
class BatchSums(BatchLog):
    """A sum per key, refreshed by adding each batch's own partial sums."""

    keys: tuple[str, ...]
    value: str

    def folded(self, rows: DataFrame) -> DataFrame:
        kind = self.schema[self.value].dataType
        return rows.groupBy(*self.keys).agg(F.sum(self.value).cast(kind).alias(self.value))

    def changes(self, after: dict[str, int], upto: dict[str, int] | None = None) -> DataFrame:
        """Sums that batches after those of `after` made or changed, as rows of `change_rows`.

        Only the batches since are scanned for keys; older sums are read for these keys alone.
        """
        upto = self.versions() if upto is None else upto
        delta = self.folded(self._rows(upto, after))
        before = self.folded(self._rows(after).join(delta.select(*self.keys), list(self.keys), "left_semi"))
        before = before.select(*self.keys, F.struct(self.value).alias("before"))
        total = F.coalesce(F.col(f"before.{self.value}"), F.lit(0)) + F.coalesce(self.value, F.lit(0))
        both = delta.join(before, list(self.keys), "left").select(
            *self.keys, "before", F.struct(total.cast(self.schema[self.value].dataType).alias(self.value)).alias("after")
        )
        return change_rows(both, self.keys, (self.value,))


@dataclass(frozen=True)
class NewestPerKey(BatchLog):
    """Of every key all rows of the greatest version; a later batch replaces what an earlier one said of a key."""

    keys: tuple[str, ...]
    version: str = "version"

    def folded(self, rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*self.keys).agg(F.max(self.version).alias(self.version))
        return rows.select(*self.schema.fieldNames()).join(last, [*self.keys, self.version], "left_semi")


def change_rows(both: DataFrame, keys: tuple[str, ...], others: tuple[str, ...]) -> DataFrame:
    """Rows of change from (keys, before, after), where before or after may be NULL.

    metadata_action is INSERT or DELETE for a row that came or went, and UPDATE for both images
    of a row that changed; metadata_image says which one it is.  Rows that stayed the same give none.
    """
    action = F.when(F.col("before").isNull(), "INSERT").when(F.col("after").isNull(), "DELETE").otherwise("UPDATE")
    images = F.filter(
        F.array(*(F.struct(F.lit(name).alias("image"), F.col(name).alias("row")) for name in ("before", "after"))),
        lambda image: image["row"].isNotNull(),
    )
    return (
        both.where(~F.col("before").eqNullSafe(F.col("after")))
        .select(*keys, action.alias("metadata_action"), F.explode(images).alias("change"))
        .select(*keys, *(F.col(f"change.row.{name}").alias(name) for name in others), "metadata_action", F.col("change.image").alias("metadata_image"))
    )


@dataclass(frozen=True)
class ChangeTable:
    """A keyed table, kept as copies now and then plus the changes since.

    A batch writes the keys it changed, with a flag for deletions.  Reading takes the newest row of
    each key.  Rows lie in a fixed number of buckets, by a hash of their key, each a folder; a batch reads
    the buckets of its own keys, and `compact` writes those buckets anew that changed since the last copy.
    The number of buckets belongs to the table: choose it so that one bucket is a few files.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _folders(self, name: str) -> BatchFolders:
        layout = [*self.schema.fields, T.StructField("deleted", T.BooleanType()), T.StructField("bucket", T.IntegerType())]
        return BatchFolders(self.spark, f"{self.path}/{name}", T.StructType(layout), ("bucket",), self.buckets <= FEW)

    def _changes(self) -> BatchFolders:
        return self._folders("changes")

    def _copies(self) -> BatchFolders:
        return self._folders("copies")

    def _base(self, limit: int) -> tuple[int, list[str]]:
        """The newest copy below a batch, and for every bucket the folder of the newest copy that has it."""
        copies, found = self._copies(), {}
        ids = [n for n in copies.batches() if n < limit]
        for n in reversed(ids):
            for name in folder_names(self.spark, copies.folder("feed", n)):
                found.setdefault(name, f"{copies.folder('feed', n)}/{name}")
        return (ids[-1] if ids else -1), sorted(found.values())

    def _rows(self, limit: int, base_limit: int, buckets: list[int] | None) -> DataFrame:
        """Copies below `base_limit` and the changes after them and below `limit`, of some or all buckets."""
        base, folders = self._base(base_limit)
        rows = self._changes().read([("feed", n) for n in self._changes().batches() if base < n < limit])
        rows = rows.unionByName(self._copies().read_folders(folders))
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def _told_once(self, limit: int, base_limit: int) -> bool:
        """Whether `_rows` reads one batch or copies alone, which have a row per key."""
        base, folders = self._base(base_limit)
        return sum(base < n < limit for n in self._changes().batches()) + bool(folders) <= 1

    def _newest(self, rows: DataFrame, told_once: bool = False) -> DataFrame:
        """(keys, newest, batch_id): the last word on every key, deletions included.

        Every column is picked by itself, as a struct would have to be sorted and not hashed.
        """
        others = [*(name for name in self.schema.fieldNames() if name not in self.keys), "deleted"]
        if told_once:
            return rows.select(*self.keys, F.struct(*others).alias("newest"), "batch_id")
        newest = F.struct(*(F.max_by(name, "batch_id").alias(name) for name in others)).alias("newest")
        return rows.groupBy(*self.keys).agg(newest, F.max("batch_id").alias("batch_id"))

    def _columns(self) -> list[Column]:
        return [F.col(name) if name in self.keys else F.col(f"newest.{name}").alias(name) for name in self.schema.fieldNames()]

    def _state(self, rows: DataFrame, told_once: bool) -> DataFrame:
        return self._newest(rows, told_once).where(~F.col("newest.deleted")).select(*self._columns())

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that rows with these keys lie in: at most as many numbers as there are buckets."""
        return sorted(row["bucket"] for row in rows.select(self.bucket().alias("bucket")).distinct().collect())

    def read(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The table as it was before a batch, or now.

        Batches at or after `before` are left out, so a replay starts from the same
        state as the first try.  `only` names the keys wanted: other buckets are not opened, and
        other rows of these are dropped.
        """
        limit = NOW if before is None else before
        if not any(n < limit for n in self._changes().batches()):
            return nothing(self.spark, self.schema)
        if only is None:
            return self._state(self._rows(limit, limit, None), self._told_once(limit, limit))
        rows = self._rows(limit, limit, self.buckets_of(only))
        return self._state(rows.join(only.select(*self.keys).distinct(), list(self.keys), "left_semi"), self._told_once(limit, limit))

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Write what a batch changes, with one row per key."""
        rows = changes.select(*self.schema.fieldNames(), "deleted", self.bucket().alias("bucket"))
        self._changes().write(rows, batch_id)

    def changed(self, batch_id: int) -> DataFrame:
        """The keys that a batch wrote."""
        return self._changes().read([("feed", batch_id)]).select(*self.keys)

    def compact(self, batch_id: int) -> None:
        """Write the state after `batch_id` of the buckets that changed since the last copy.

        Keys deleted since then stay in it as deleted, so that a bucket left empty hides its older copy.
        """
        # A copy of this id from an earlier try is not read, so a replay writes the same rows.
        changes = self._changes()
        base, _ = self._base(batch_id)
        names = {name for n in changes.batches() if base < n <= batch_id for name in folder_names(self.spark, changes.folder("feed", n))}
        touched = sorted(int(name.removeprefix("bucket=")) for name in names)
        state = self._newest(self._rows(batch_id + 1, batch_id, touched)).where(~F.col("newest.deleted") | (F.col("batch_id") > base))
        self._copies().write(state.select(*self._columns(), "newest.deleted", self.bucket().alias("bucket")), batch_id)

    def changes(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """What the batches after `after` did to the table, as rows of `change_rows`, one step per key.

        Only the batches since are scanned for keys; older rows are read for these keys alone.
        """
        limit = NOW if upto is None else upto + 1
        folders = self._changes()
        since = [("feed", n) for n in folders.batches() if after < n < limit]
        last = self._newest(folders.read(since), len(since) <= 1)
        others = tuple(name for name in self.schema.fieldNames() if name not in self.keys)
        before = self.read(before=after + 1, only=last).select(*self.keys, F.struct(*others).alias("before"))
        now = F.when(~F.col("newest.deleted"), F.struct(*(F.col(f"newest.{name}").alias(name) for name in others)))
        both = last.join(before, list(self.keys), "left").select(*self.keys, "before", now.alias("after"))
        return change_rows(both, self.keys, others)
