"""Current positions, kept by merging batches of trades into them."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import divide
from ..types import COST, POSITION_KEY, POSITIONS, SHARE, UNIT_COST


def trade_summary(trades: DataFrame) -> DataFrame:
    """What one batch does to each position; one row per key."""
    action = F.col("trade_action")
    return trades.groupBy(*POSITION_KEY).agg(
        F.sum("share_change").alias("net_share_change"),
        F.sum(F.when(action == "Buy", F.col("total_trade_value")).otherwise(0)).alias("buy_value"),
        F.sum(F.when(action == "Sell", F.abs("share_change")).otherwise(0)).alias("shares_sold"),
        F.max("transaction_date").alias("latest_trade_date"),
        F.min("transaction_date").alias("earliest_trade_date"),
    )


def _new_shares() -> Column:
    return F.coalesce("s.current_shares", F.lit(0)) + F.col("b.net_share_change")


def _new_basis() -> Column:
    """Cost basis after the batch: the rule depends only on the batch's net change.

    It is not worked out for a position that ends, where an oversold share could be
    too large for any decimal.
    """
    old, held = F.col("s.total_cost_basis"), F.col("s.current_shares")
    net, bought = F.col("b.net_share_change"), F.col("b.buy_value")
    sold = divide(F.col("b.shares_sold").cast("decimal(20,0)"), held, 6)
    left = 1 - sold.try_cast("decimal(18,6)")
    basis = (
        F.when(old.isNull(), bought)
        .when(net > 0, old + bought)
        .when((net < 0) & (held > 0), old * left)
        .otherwise(old)
    )
    return F.when(_new_shares() > 0, basis).cast("decimal(30,8)")


def _merged(state: DataFrame, trades: DataFrame, as_of: dt.datetime, how: str) -> DataFrame:
    """Batch and state side by side, reduced to the values each key ends with.

    Both sides have one row per key, so no key can be hot in this join.
    """
    batch, old = trade_summary(trades).alias("b"), state.alias("s")
    on = [F.col(f"b.{name}") == F.col(f"s.{name}") for name in POSITION_KEY]
    # A batch without any share count for a key says nothing about it.
    touched = F.col("b.net_share_change").isNotNull()
    joined = batch.join(old, on, how).select(
        *(F.coalesce(f"b.{name}", f"s.{name}").alias(name) for name in POSITION_KEY),
        F.col("s.current_shares").isNotNull().alias("known"),
        touched.alias("touched"),
        F.coalesce("s.current_shares", F.lit(0)).alias("old_shares"),
        _new_shares().alias("new_shares"),
        F.col("s.total_cost_basis").alias("old_basis"),
        F.col("s.average_cost_per_share").alias("old_average"),
        _new_basis().alias("new_basis"),
        F.coalesce("s.first_trade_date", "b.earliest_trade_date").alias("first_trade_date"),
        F.col("s.last_trade_date").alias("old_last"),
        F.col("b.latest_trade_date").alias("new_last"),
        F.col("s.last_updated").alias("old_updated"),
    )

    def pick(new: Column | str, old_value: str) -> Column:
        return F.when(F.col("touched"), new).otherwise(F.col(old_value))

    return joined.select(
        *POSITION_KEY,
        pick(F.col("new_shares"), "old_shares").cast(SHARE).alias("current_shares"),
        pick(F.col("new_basis"), "old_basis").cast(COST).alias("total_cost_basis"),
        pick(divide(F.col("new_basis"), F.col("new_shares").cast("decimal(18,4)"), 12), "old_average")
        .cast(UNIT_COST)
        .alias("average_cost_per_share"),
        "first_trade_date",
        pick(F.col("new_last"), "old_last").alias("last_trade_date"),
        pick(F.lit(as_of).cast("timestamp_ntz"), "old_updated").alias("last_updated"),
        "known",
        "touched",
    )


def merge_positions(state: DataFrame, trades: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The whole table after the batch: keys update, sold-out keys go, new ones come."""
    merged = _merged(state, trades, as_of, "full")
    stays = F.when(F.col("touched"), F.col("current_shares") > 0).otherwise(F.col("known"))
    return merged.where(stays).select(*POSITIONS.fieldNames())


def changed_positions(state: DataFrame, trades: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Only the keys of the batch, with `deleted` set where the position ends.

    A key that was not held and ends without shares is left out.
    """
    merged = _merged(state, trades, as_of, "left")
    return (
        merged.withColumn("deleted", F.col("current_shares") <= 0)
        .where(F.col("touched") & (F.col("known") | ~F.col("deleted")))
        .select(*POSITIONS.fieldNames(), "deleted")
    )
