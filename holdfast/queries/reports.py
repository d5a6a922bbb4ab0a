"""The composite business queries."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as O
from ..functions import stamped
from ..plans import adapters as A
from ..plans import cash as C
from ..plans import customers as K
from ..plans import holdings as H
from ..plans import trades as P
from ..session import workspace
from ..types import PAYLOAD
from .common import plain, stored

SCHEDULE_END = dt.date(2024, 12, 31)


def build_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Keys, element count and sums of each payload."""
    payload = F.try_variant_get("transaction_payload", "$", PAYLOAD)
    trades = F.col("payload.trades")

    def total(name: str):
        return F.aggregate(
            trades, F.lit(0).cast("decimal(38,2)"), lambda a, t: (a + t[name]).cast("decimal(38,2)")
        )

    raw = A.trades_raw(spark, folder).withColumn("payload", payload)
    return plain(
        raw.select(
            "transaction_date",
            "transaction_id",
            "payload.customer_id",
            "payload.account_type",
            F.size(trades).alias("trades"),
            total("shares").alias("shares"),
            total("total_trade_value").alias("value"),
        )
    )


def payload_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads per customer and account, by three paths of the stored, shredded payloads."""
    raw = stored(spark, A.trades_raw(spark, folder), "payloads")
    paths = {"customer_id": ("$.customer_id", "bigint"), "account_type": ("$.account_type", "string"), "ticker": ("$.trades[0].ticker", "string")}
    return plain(
        O.payload_paths(raw, paths)
        .groupBy("customer_id", "account_type")
        .agg(
            F.count("*").alias("payloads"),
            F.max("transaction_date").alias("last_day"),
            F.min("ticker").alias("least_first"),
            F.max("ticker").alias("greatest_first"),
        )
    )


def flatten_trades(spark: SparkSession, folder: str) -> DataFrame:
    return plain(P.flattened(A.trades_raw(spark, folder)))


def position_summary(spark: SparkSession, folder: str) -> DataFrame:
    return plain(P.position_summary(P.flattened(A.trades_raw(spark, folder))))


def top_traders(spark: SparkSession, folder: str) -> DataFrame:
    return P.top_traders(A.trades_flat(spark, folder))


def trade_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return plain(P.trade_distribution(A.trades_flat(spark, folder)))


def trade_cash(spark: SparkSession, folder: str) -> DataFrame:
    return plain(C.trade_cash(P.enrich_trades(A.trades_flat(spark, folder))))


def cash_detail(spark: SparkSession, folder: str) -> DataFrame:
    return plain(A.detail(spark, folder))


def daily_cash(spark: SparkSession, folder: str) -> DataFrame:
    return plain(A.daily(spark, folder))


def merge_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches, cut at a fixed day; the state between them is a stored table."""
    trades = A.brand_trades(spark, folder)
    early = F.col("transaction_date") < F.lit(A.BATCH_CUT)
    as_of = A.AS_OF
    state = O.merge_positions(A.no_positions(spark), trades.where(early), as_of)
    state = stored(spark, state, "positions")
    return plain(O.merge_positions(state, trades.where(~early), as_of).drop("last_updated"))


def _snapshot_inputs(spark: SparkSession, folder: str, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Positions, cash and the year ends, of trades that are joined once."""
    trades = stored(spark, A.brand_trades(spark, folder).drop("shares", "trade_price"), "trades", root)
    deposits = A.cash_deposits(spark, folder)
    positions = stored(spark, O.merge_positions(A.no_positions(spark), trades, A.AS_OF), "positions", root)
    cash = stored(spark, C.daily_cash(C.cash_detail(deposits, trades)), "cash", root)
    return positions, cash, A.year_ends(A.feed_days(trades, deposits))


def _feed_days(spark: SparkSession, folder: str) -> DataFrame:
    return A.feed_days(A.brand_trades(spark, folder), A.cash_deposits(spark, folder))


def snapshot_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Value, cost and gain on every day of both feeds, per account type and ticker."""
    dates, prices = _feed_days(spark, folder), A.brand_prices(spark, folder)
    return plain(H.snapshot_totals(dates, A.positions(spark, folder), prices))


def portfolio_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Year-end statements of all accounts; `snapshot_totals` has all days."""
    positions, cash, dates = _snapshot_inputs(spark, folder, workspace(spark))
    return plain(
        H.portfolio_snapshot(dates, positions, A.brand_prices(spark, folder), cash)
    )


def current_holdings(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings after the year-end snapshots have been stored."""
    root = workspace(spark)
    positions, cash, dates = _snapshot_inputs(spark, folder, root)
    snapshot = H.portfolio_snapshot(dates, positions, A.brand_prices(spark, folder), cash)
    history = H.write_snapshot(snapshot, f"{root}/history", A.AS_OF, few_days=True)
    return plain(H.current_holdings(history, cash, A.AS_OF), times=("last_refreshed",))


def processed_times(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of trades, cash, positions, history and current holdings, by the time that is stored with them.

    Each table is made from stored ones and stamped as it is stored.
    """
    root, at = workspace(spark), "processed_timestamp"
    trades = stored(spark, stamped(A.brand_trades(spark, folder), at, A.AS_OF), "trades", root)
    detail = C.cash_detail(A.cash_deposits(spark, folder), trades)
    detail = stored(spark, stamped(detail, at, A.AS_OF), "detail", root)
    positions = stored(spark, O.merge_positions(A.no_positions(spark), trades, A.AS_OF), "positions", root)
    cash = stored(spark, C.daily_cash(detail), "cash", root)
    dates = A.year_ends(A.feed_days(trades, detail))
    snapshot = H.portfolio_snapshot(dates, positions, A.brand_prices(spark, folder), cash)
    history = H.write_snapshot(snapshot, f"{root}/history", A.AS_OF, few_days=True)
    current = stored(spark, H.current_holdings(history, cash, A.AS_OF), "current", root)
    made = {
        "trades": (trades, at),
        "cash": (detail, at),
        "positions": (positions, "last_updated"),
        "history": (history, at),
        "current": (current, "last_refreshed"),
    }
    counts = [
        frame.groupBy(F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias("processed_at"))
        .agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("table_name"), "processed_at", "rows")
        for name, (frame, column) in made.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def customer_overview(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        K.customer_overview(
            A.customers(spark, folder),
            A.customer_portfolio(spark, folder),
            A.portfolios(spark),
            A.retirement_plans(spark, folder),
        )
    )


def composition_unnest(spark: SparkSession, folder: str) -> DataFrame:
    parts = K.composition_unnest(A.compositions(spark, folder), A.asset_classes(spark, folder))
    return parts.select(
        "portfolio_id",
        "portfolio_description",
        "asset_class_hash",
        "asset_class_description",
        F.round("amount", 6).alias("amount"),
    )


def weekly_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return plain(O.weekly_schedule(A.customers(spark, folder), SCHEDULE_END))


QUERIES = {
    "build_payload": build_payload,
    "payload_paths": payload_paths,
    "flatten_trades": flatten_trades,
    "position_summary": position_summary,
    "top_traders": top_traders,
    "trade_distribution": trade_distribution,
    "trade_cash": trade_cash,
    "cash_detail": cash_detail,
    "daily_cash": daily_cash,
    "merge_positions": merge_positions,
    "snapshot_totals": snapshot_totals,
    "processed_times": processed_times,
    "portfolio_snapshot": portfolio_snapshot,
    "current_holdings": current_holdings,
    "customer_overview": customer_overview,
    "composition_unnest": composition_unnest,
    "weekly_schedule": weekly_schedule,
}
