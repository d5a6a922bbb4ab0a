"""Cash movements and daily net cash."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import types

DAILY_KEY = ("customer_id", "transaction_date", "ticker", "account_type")

# How cash from trades is labelled.
CASH = "CASH"
TRADE_CATEGORY = "Security Purchase"


def deposit_cash(deposits: DataFrame) -> DataFrame:
    """Deposits in the layout of the cash table."""
    return deposits.select(
        "customer_id",
        "transaction_date",
        F.col("deposit_id").alias("cash_deposit_id"),
        F.lit(None).cast("string").alias("security_purchase_transaction_id"),
        "ticker",
        F.col("deposit_amount").cast(types.CASH).alias("amount"),
        F.col("account_type_name").alias("account_type"),
        "transaction_category",
    )


def trade_movements(trades: DataFrame) -> DataFrame:
    """The cash effect of each single trade, with the key of daily cash; for sums that need no detail."""
    return trades.select(
        "customer_id",
        F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
        F.lit(CASH).alias("ticker"),
        "account_type",
        F.col("cash_flow_impact").cast(types.CASH).alias("amount"),
    )


def trade_cash(trades: DataFrame) -> DataFrame:
    """Cash effect of trades, one row per customer, day, transaction and account."""
    return (
        trades.groupBy("customer_id", "transaction_date", "transaction_id", "account_type")
        .agg(F.sum("cash_flow_impact").cast(types.CASH).alias("amount"))
        .select(
            "customer_id",
            F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
            F.lit(None).cast("string").alias("cash_deposit_id"),
            F.col("transaction_id").alias("security_purchase_transaction_id"),
            F.lit(CASH).alias("ticker"),
            "amount",
            "account_type",
            F.lit(TRADE_CATEGORY).alias("transaction_category"),
        )
    )


def cash_detail(deposits: DataFrame, trades: DataFrame) -> DataFrame:
    """All cash movements."""
    return deposit_cash(deposits).unionByName(trade_cash(trades))


def daily_cash(detail: DataFrame) -> DataFrame:
    """Net cash flow per customer, day, ticker and account: a flow, not a balance."""
    return detail.groupBy(*DAILY_KEY).agg(F.sum("amount").cast(types.CASH).alias("daily_net_cash"))


def snapshot_dates(trades: DataFrame, cash: DataFrame) -> DataFrame:
    """Distinct days of both feeds; a DATE and a TIMESTAMP meet as TIMESTAMP."""
    return (
        trades.select(F.col("transaction_date").cast("timestamp_ntz").alias("snapshot_date"))
        .union(cash.select(F.col("transaction_date").cast("timestamp_ntz")))
        .distinct()
    )
