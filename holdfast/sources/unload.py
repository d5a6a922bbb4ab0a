"""Daily unloads and the ledger that says which days are done.

The ledger is a table (transaction_date, unload_status, unload_time) with one row
per unloaded day.  It is small: days, not rows.
"""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import CSV_WRITE_OPTIONS

# The day the cursor starts at, and the maximum of an empty feed.
FIRST_DAY = dt.date(2019, 1, 2)
EMPTY_FEED = dt.date(1900, 1, 1)


def unload_by_date(df: DataFrame, path: str, date: str = "transaction_date", batch_id: int | None = None) -> None:
    """Quoted CSV, one folder per day; only the days present are overwritten.

    The day is kept inside the file too.  The rebalance gives a day one file as
    long as it fits one task, and splits a larger day.  With a batch id, the days lie in a folder of
    the batch, which is overwritten as a whole; a day that comes in several batches lies in several.
    """
    writer = df.withColumn("unload_date", F.col(date).cast("date")).hint("rebalance", "unload_date").write.mode("overwrite")
    writer = writer.partitionBy("unload_date").options(**CSV_WRITE_OPTIONS)
    if batch_id is None:
        writer.option("partitionOverwriteMode", "dynamic").csv(path)
    else:
        writer.option("partitionOverwriteMode", "static").csv(f"{path}/batch_id={batch_id}")


def unloaded_days(df: DataFrame, at: dt.datetime, date: str = "transaction_date") -> DataFrame:
    """Ledger rows of what is unloaded together: days, how many rows, and when."""
    return _days(df, date).select(
        "transaction_date", "records", F.lit("SUCCESS").alias("unload_status"), F.lit(at).cast("timestamp_ntz").alias("unload_time")
    )


def _days(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.col(date).cast("date").alias("transaction_date")).agg(
        F.count("*").alias("records")
    )


def pending_days(df: DataFrame, ledger: DataFrame, date: str = "transaction_date") -> DataFrame:
    """Days with rows that the ledger does not list, with their row counts."""
    done = ledger.where(F.col("unload_time").isNotNull()).select("transaction_date")
    return _days(df, date).join(done, "transaction_date", "left_anti")


def next_day(df: DataFrame, ledger: DataFrame, date: str = "transaction_date") -> DataFrame:
    """The earliest pending day, as one row; NULL when all is unloaded."""
    return pending_days(df, ledger, date).agg(F.min("transaction_date").alias("transaction_date"))


def load_calendar(
    feeds: dict[str, DataFrame],
    ledgers: dict[str, DataFrame],
    start: dt.date = FIRST_DAY,
) -> DataFrame:
    """All days the cursor visits, with the row count of each feed.

    The cursor begins at `start` and steps one day while the next day is not after
    the greatest pending day of any feed, so `start` itself is always visited.
    """
    spark = next(iter(feeds.values())).sparkSession
    counts = {name: _days(df, "transaction_date") for name, df in feeds.items()}

    # One row per feed: the last pending day.
    last = None
    for name, days in counts.items():
        done = ledgers[name].where(F.col("unload_time").isNotNull()).select("transaction_date")
        top = days.join(done, "transaction_date", "left_anti").agg(
            F.coalesce(F.max("transaction_date"), F.lit(EMPTY_FEED)).alias("day")
        )
        last = top if last is None else last.unionAll(top)
    end = last.agg(F.max("day").alias("day")).scalar()

    calendar = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start), F.greatest(F.lit(start), end), F.expr("interval 1 day"))
        ).alias("transaction_date")
    )
    for name, days in counts.items():
        calendar = calendar.join(
            days.withColumnRenamed("records", f"{name}_records"), "transaction_date", "left"
        )
    return calendar.select(
        "transaction_date",
        *(F.coalesce(f"{name}_records", F.lit(0)).cast("bigint").alias(f"{name}_records")
          for name in feeds),
    )


def unload_status(calendar: DataFrame, feed: str) -> DataFrame:
    """PROCESSED for a day with rows, SKIPPED for a day without."""
    records = F.col(f"{feed}_records")
    return calendar.select(
        "transaction_date",
        records.alias("records"),
        F.when(records > 0, "PROCESSED").otherwise("SKIPPED").alias("status"),
    )


def mark_done(ledger: DataFrame, days: DataFrame, at: dt.datetime) -> DataFrame:
    """The ledger with the given days set to SUCCESS; a second mark replaces the first."""
    marked = days.select("transaction_date").distinct()
    return ledger.join(marked, "transaction_date", "left_anti").unionByName(
        marked.select(
            "transaction_date",
            F.lit("SUCCESS").alias("unload_status"),
            F.lit(at).cast("timestamp_ntz").alias("unload_time"),
        )
    )


def reset_days(ledger: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Forget all marks, or those from a day on, so that the days unload again."""
    if since is None:
        return ledger.limit(0)
    return ledger.where(F.col("transaction_date") < F.lit(since))
