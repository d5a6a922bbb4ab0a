"""What a folder of files, each of its files, or a JSON column looks like."""

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT = "source string, column_name string, type string, nullable boolean, order_id int"


def inferred_schema(spark: SparkSession, path: str) -> T.StructType:
    """Layout of all Parquet files below a path; the footers are merged by a Spark job."""
    return spark.read.option("mergeSchema", True).parquet(path).schema


def schema_report(spark: SparkSession, source: str, path: str) -> DataFrame:
    """One row per inferred column."""
    rows = [
        (source, field.name, field.dataType.simpleString(), field.nullable, place)
        for place, field in enumerate(inferred_schema(spark, path).fields)
    ]
    return spark.createDataFrame(rows, REPORT)


def schema_by_file(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below a path and column of it; `source` is the file.

    Files are listed by a scan that opens none of them, and footers are read where the list is
    processed, so many files are many tasks and no file is read whole.
    """
    # Inside, so that it is sent to the workers whole and they need no module of this package.
    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet
        from pyspark.errors import PySparkException
        from pyspark.sql.pandas.types import from_arrow_type

        names = ["source", "column_name", "type", "nullable", "order_id"]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                # Listings write local files with one slash.
                system, place = fs.FileSystem.from_uri(f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path)
                found = parquet.read_schema(place, filesystem=system)
                written = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                if written:
                    fields = [(f.name, f.dataType.simpleString(), f.nullable) for f in T.StructType.fromJson(json.loads(written)).fields]
                else:
                    fields = []
                    for f in found:
                        try:
                            kind = from_arrow_type(f.type, prefer_timestamp_ntz=True).simpleString()
                        except PySparkException:
                            # A type that Spark has no name for keeps its own.
                            kind = str(f.type)
                        fields.append((f.name, kind, f.nullable))
                columns = [pa.array([path] * len(fields), pa.string()), *(pa.array([f[k] for f in fields], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.bool_())))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(range(len(fields)), pa.int32())], names=names)

    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path")
    )
    return files.mapInArrow(footers, REPORT)


def merged_report(by_file: DataFrame, source: str) -> DataFrame:
    """A report of what the files have together: each column once, with all its types where files differ."""
    types = F.array_join(F.array_sort(F.collect_set("type")), " | ")
    return by_file.groupBy(F.lower("column_name").alias("column_name")).agg(
        types.alias("type"), F.max("nullable").alias("nullable"), F.min("order_id").alias("order_id")
    ).select(F.lit(source).alias("source"), "column_name", "type", "nullable", "order_id")


def payload_shape(df: DataFrame, column: str, source: str) -> DataFrame:
    """The merged shape of a variant column over all rows, as one row."""
    return df.agg(F.schema_of_variant_agg(column).alias("type")).select(
        F.lit(source).alias("source"), F.lit(column).alias("column_name"), "type"
    )


def diff_reports(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns of two reports side by side, matched by name ignoring case."""
    def side(report: DataFrame, name: str) -> DataFrame:
        return report.select(
            F.lower("column_name").alias("column_name"), F.col("type").alias(f"{name}_type")
        )

    status = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") == F.col("new_type"), "same")
        .otherwise("changed")
    )
    return side(old, "old").join(side(new, "new"), "column_name", "full").withColumn("status", status)
