"""Feeds over folders of files.

A feed's first run sees every row already there, later runs only new files.  Each
consumer has its own checkpoint, so consumers never take rows from one another.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from ..session import copy_folder, workspace
from ..sources.files import CSV_OPTIONS
from .tables import ChangeTable


def _limited(spark: SparkSession, files_per_batch: int | None) -> DataStreamReader:
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def change_feed(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Rows appended to a Parquet table, initial rows included.

    A run takes all that waits as one batch, unless the caller limits the files per batch.  Where
    results depend on how rows are cut into batches, as a cost basis does, leave it unlimited.
    """
    return _limited(spark, files_per_batch).schema(schema).parquet(path)


def csv_feed(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of CSV files as they land, also in sub-folders per day; batches as in `change_feed`."""
    reader = _limited(spark, files_per_batch).schema(schema).options(**CSV_OPTIONS)
    return reader.option("recursiveFileLookup", True).csv(path)


def tagged_union(**feeds: DataFrame) -> DataFrame:
    """Several feeds as one, so that a batch takes what waits in all of them at once.

    `feed` names the feed a row came from, and a column of each feed's name holds its row, NULL in
    the others' rows.  `part` takes a batch apart again.
    """
    def row(name: str, own: str) -> Column:
        found = F.struct(*feeds[name].columns)
        return (found if name == own else F.lit(None).cast(feeds[name].schema)).alias(name)

    tagged = [feed.select(F.lit(own).alias("feed"), *(row(name, own) for name in feeds)) for own, feed in feeds.items()]
    return reduce(DataFrame.unionAll, tagged)


def has_data(feed: DataFrame, checkpoint: str) -> bool:
    """Whether a consumer with this checkpoint has rows to take; it takes none.

    A run on a copy of the checkpoint looks for a first row in each batch that it would get.
    """
    probe = f"{workspace(feed.sparkSession)}/probe"
    copy_folder(feed.sparkSession, checkpoint, probe)
    found: list[bool] = []
    consume(feed, probe, lambda batch, batch_id: found.append(not batch.isEmpty())).awaitTermination()
    return any(found)


def with_change_metadata(feed: DataFrame, columns: list[str]) -> DataFrame:
    """The kind of change and a stable row id.

    The id hashes the file and the row's place in it (for CSV, which has no place,
    the fields), so it survives a replay.  The feed must be a file scan.
    """
    place = "_metadata.row_index" if "row_index" in _metadata_fields(feed) else None
    parts = [F.col("_metadata.file_path")]
    parts.append(F.col(place) if place else F.to_json(F.struct(*columns)))
    return feed.select(
        *columns,
        F.lit("INSERT").alias("metadata_action"),
        F.md5(F.concat_ws("|", *(part.cast("string") for part in parts))).alias("metadata_row_id"),
    )


def _metadata_fields(feed: DataFrame) -> list[str]:
    return feed.select("_metadata").schema["_metadata"].dataType.fieldNames()


def auto_ingest(feed: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append each landed file to a Parquet table exactly once, then stop."""
    return (
        feed.writeStream.format("parquet")
        .option("compression", "zstd")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def consume(
    feed: DataFrame,
    checkpoint: str,
    step: Callable[[DataFrame, int], None],
    every: str | None = None,
) -> StreamingQuery:
    """Call `step(batch, batch_id)` for each micro-batch.

    Without new files there is no batch, so a step never runs on nothing new.
    `every` keeps the query running at that interval; by default it takes what is
    there and stops.  A batch may be replayed after a failure, with the same id
    and rows; steps must write so that a second run replaces the first.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        feed.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stateful_sums(
    rows: DataFrame, keys: tuple[str, ...], value: str, target: ChangeTable, checkpoint: str
) -> StreamingQuery:
    """Keep a table of sums per key by a streaming aggregate, whose state lives in Spark's state store.

    A batch gives the new totals of the keys it touched, and writes them as changes of `target`,
    under the name of the one column that is not a key.  Sums need no read of the table; the
    state grows with the keys and is split over as many stores as there were shuffle partitions at the first start.
    A replay finds the state of its batch and writes the same rows.
    """
    (total,) = [field for field in target.schema.fields if field.name not in keys]
    sums = rows.groupBy(*keys).agg(F.sum(value).cast(total.dataType).alias(total.name))

    def write(changed: DataFrame, batch_id: int) -> None:
        target.apply(changed.withColumn("deleted", F.lit(False)), batch_id)

    return (
        sums.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
