"""Shared by the query modules."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import workspace
from ..sources.files import write_table


def plain(df: DataFrame, nullable_numbers: tuple[str, ...] = (), times: tuple[str, ...] = ()) -> DataFrame:
    """Output types that read the same everywhere: bigint, double, text.

    Dates become ISO text, and so do timestamps, which are days unless they are among `times`.
    Whole numbers that may be NULL become doubles.
    """
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif field.name in times:
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.TimestampNTZType):
            value = value.cast("date").cast("string")
        elif isinstance(field.dataType, T.DecimalType) or field.name in nullable_numbers:
            value = value.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("bigint")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def stored(spark: SparkSession, df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write a table that several parts of a query read, and go on from the files."""
    return write_table(df, f"{root or workspace(spark)}/{name}")
