"""Scans and plain writes."""

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types as layouts
from ..session import shuffles_dropped

# Comma separated, optionally quoted by ", a quote inside a field is
# doubled, \N stands for NULL.
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": r"\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Readers take any ISO form, a bare day included; writers keep the microseconds.
CSV_WRITE_OPTIONS = {
    **CSV_OPTIONS,
    "quoteAll": "true",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}

# Files that a task holds open at a time, and the bytes that each gathers before they go out.
FEW = 16
FEW_BLOCK = 16 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def typed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Pick and cast columns; a cast that fails gives NULL, as the input is external."""
    return df.select(*(F.col(name).try_cast(kind).alias(name) for name, kind in columns.items()))


def scan_parquet(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Query staged Parquet files in place; only the picked columns are read."""
    return typed(spark.read.parquet(path), columns)


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Quoted CSV by position.  `multiline` allows line breaks inside quotes, at the
    price that Spark can no longer split one file over several tasks."""
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("header", header)
        .option("enforceSchema", True)
        .option("multiLine", multiline)
        .schema(schema)
        .csv(path)
    )


def parse_payload(df: DataFrame) -> DataFrame:
    """Turn the payload text into a variant; malformed text becomes NULL."""
    return df.withColumn("transaction_payload", F.try_parse_json("transaction_payload"))


def scan_json_payload_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV of day, id and JSON text, with the third field parsed."""
    return parse_payload(scan_csv(spark, path, layouts.SECURITY_TRADES_CSV))


def file_inventory(spark: SparkSession, path: str, prefixes: Mapping[str, str]) -> DataFrame:
    """Files, folders and bytes per group, where a group is a LIKE pattern on the path.

    The file listing is a Spark scan that never opens the files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    group = F.lit(None).cast("string")
    for name, pattern in reversed(list(prefixes.items())):
        group = F.when(F.col("path").like(pattern), name).otherwise(group)
    return (
        files.groupBy(group.alias("schema_type"))
        .agg(
            F.sum("length").alias("total_bytes"),
            F.count("path").alias("num_of_files"),
            F.countDistinct(F.regexp_replace("path", "/[^/]*$", "")).alias("num_of_folders"),
        )
    )


def write_table(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = (), few: bool = False
) -> DataFrame:
    """Create-table-as or append, then a fresh scan of what was written.

    Partitioned writes ask for a rebalance: small partitions are merged, and a
    partition with too much data is split over several tasks.  Where the caller says that the
    partitions are `few`, every task writes its own rows of each, and no row is shuffled or sorted.
    Shuffles go with the end of the write.
    """
    if partition_by and not few:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    with shuffles_dropped(df.sparkSession):
        if few:
            with open_files(df.sparkSession):
                writer.option("parquet.block.size", FEW_BLOCK).parquet(path)
        else:
            writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Let a task keep a file open per partition; beyond `FEW` of them Spark sorts the rest of its rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, FEW)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def create_from_schema(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """An empty table with a given, usually inferred, layout."""
    return write_table(spark.createDataFrame([], schema), path)


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """New columns, NULL in every existing row."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})
