"""Trades: enrichment, position summaries, activity reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.payload import flatten_trades
from ..types import PRICE, TRADES_FLAT


def enrich_trades(flat: DataFrame) -> DataFrame:
    """Signed shares and cash.  Everything that is not a 'Buy' counts as a sale here."""
    # Fixed value: the word for a purchase.
    buy = F.col("trade_action") == "Buy"
    return flat.withColumns(
        {
            "share_change": F.when(buy, F.col("shares")).otherwise(-F.col("shares")),
            "cash_flow_impact": F.when(buy, -F.col("total_trade_value"))
            .otherwise(F.col("total_trade_value"))
            .cast(PRICE),
        }
    )


def flattened(raw: DataFrame) -> DataFrame:
    """Raw payloads to the conformed trade table."""
    return enrich_trades(flatten_trades(raw)).select(*TRADES_FLAT.fieldNames())


def position_summary(trades: DataFrame) -> DataFrame:
    """Net shares and values per customer, ticker and account; open positions only."""
    action, value = F.col("trade_action"), F.col("total_trade_value")
    return (
        trades.groupBy("customer_id", "ticker", "account_type")
        .agg(
            F.sum("share_change").alias("net_shares"),
            F.sum(F.when(action == "Buy", value).otherwise(0)).alias("total_bought_value"),
            F.sum(F.when(action == "Sell", value).otherwise(0)).alias("total_sold_value"),
            F.sum("cash_flow_impact").alias("net_cash_impact"),
        )
        .where(F.col("net_shares") > 0)
    )


def top_traders(trades: DataFrame, count: int = 5) -> DataFrame:
    """The customers with the most trades; ties go to the smaller id."""
    return (
        trades.groupBy("customer_id")
        .agg(F.count("*").alias("trades"))
        .orderBy(F.desc("trades"), "customer_id")
        .limit(count)
    )


def trade_distribution(trades: DataFrame) -> DataFrame:
    """Shares and value per action."""
    return trades.groupBy("trade_action").agg(
        F.sum("shares").alias("total_shares"), F.sum("total_trade_value").alias("total_value")
    )
