"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The partial mask for social security numbers.
SOCIAL_PREFIX = r"^.{3}-.{2}"
SOCIAL_MASK = "***-**"


def mask_social(value: Column) -> Column:
    """Hide all but the last four digits; text of another shape passes unchanged."""
    return F.regexp_replace(value, SOCIAL_PREFIX, SOCIAL_MASK)


def transaction_key(date: Column, customer: Column) -> Column:
    """Hash of day and customer.  Not unique: one day may hold several accounts."""
    return F.md5(F.concat(date.cast("string"), customer.cast("string")))
