"""Numeric casts and arithmetic with warehouse rounding, and time stamps given by the caller."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_int(value: Column, kind: str = "int") -> Column:
    """Integer cast that rounds half away from zero; a plain Spark cast would truncate."""
    return F.round(value.cast("decimal(38,10)"), 0).cast(kind)


def fits(value: Column, kind: str) -> Column:
    """Cast that yields NULL on bad input; only for data arriving from outside."""
    return value.try_cast(kind)


def divide(top: Column, bottom: Column, scale: int) -> Column:
    """Decimal quotient kept to `scale` digits; NULL when the divisor is zero.

    Warehouse division keeps six digits more than the numerator has, at most
    twelve, and the extra digits reach stored cost bases, so the scale is fixed
    here and not left to Spark's own rule.
    """
    return F.round(F.try_divide(top, bottom), scale)


def stamped(df: DataFrame, name: str, at: dt.datetime) -> DataFrame:
    """`df` with a column that says when it was processed or refreshed; the caller gives the time.

    A fixed time, not the clock, so that a step that runs again writes the same rows.
    """
    return df.withColumn(name, F.lit(at).cast("timestamp_ntz"))
