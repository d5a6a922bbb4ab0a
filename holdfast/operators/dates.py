"""Expansion over dates."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Yearly share of salary paid in while active and paid out once retired.
CONTRIBUTION_RATE = "0.02"
WITHDRAWAL_RATE = "0.04"
WEEKS_PER_YEAR = 52


def each_date(df: DataFrame, dates: DataFrame, name: str = "snapshot_date") -> DataFrame:
    """Every row of `df` once per date.

    `dates` is any frame with the date column; it is cast to DATE and made distinct.
    The dates reach the tasks as the value of a scalar subquery, an array with at most
    one entry per calendar day, so there is no join.
    """
    days = dates.agg(F.array_sort(F.collect_set(F.col(name).cast("date")))).scalar()
    return df.withColumn(name, F.explode(days))


def weekly_schedule(customers: DataFrame, until: dt.date) -> DataFrame:
    """Weekly cash flow of each customer from account opening to `until`.

    Active customers pay in 2% of the salary per year, retired ones take out 4%.
    `customers` has customer_id, start_date, retirement_date and salary.
    """
    weekly = F.round(F.col("salary") * F.lit(CONTRIBUTION_RATE).cast("decimal(4,2)") / WEEKS_PER_YEAR, 2)
    taken = F.round(F.col("salary") * F.lit(WITHDRAWAL_RATE).cast("decimal(4,2)") / WEEKS_PER_YEAR, 2)
    retired = F.col("transaction_date") >= F.col("retirement_date")
    return (
        customers.where(F.col("start_date") <= F.lit(until))
        .select(
            "customer_id",
            "salary",
            "retirement_date",
            F.explode(
                F.sequence("start_date", F.lit(until), F.expr("interval 7 days"))
            ).alias("transaction_date"),
        )
        .select(
            "customer_id",
            "transaction_date",
            F.when(retired, -taken).otherwise(weekly).alias("amount"),
            F.when(retired, "Withdrawal").otherwise("Deposit").alias("transaction_category"),
        )
    )
