"""Portfolio snapshots and current holdings."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import types
from ..functions import divide, stamped
from ..operators.asof import asof_prices
from ..operators.dates import each_date
from ..operators.latest import latest_per_key, newest
from ..session import workspace
from ..sources.files import write_table


def price_curves(tickers: DataFrame, dates: DataFrame, prices: DataFrame) -> DataFrame:
    """(ticker, curve): the prices in force on all dates, in the order of the dates.

    There are few tickers; a curve has one entry per day asked for.
    """
    dated = asof_prices(each_date(tickers, dates).withColumnRenamed("snapshot_date", "as_of"), prices)
    points = F.array_sort(F.collect_list(F.struct("as_of", "latest_price")))
    return dated.groupBy("ticker").agg(points.alias("points")).select("ticker", F.col("points.latest_price").alias("curve"))


def dated_positions(positions: DataFrame, dates: DataFrame, curves: DataFrame, flows: DataFrame) -> DataFrame:
    """Every position on every date, with the price then in force and the account's cash of that day.

    `flows` has customer_id, account_type, snapshot_date, daily_net_cash and cash_date.  Each account
    gets an array with a slot per date (two where it has two cash rows on a day), each ticker its
    curve; positions are joined to both and expanded last, so no row of dates x positions is shuffled.
    With `curves` read from a table, the join by ticker is one of two plain shuffles, and adaptive
    execution splits a hot ticker.
    """
    days = dates.agg(F.array_sort(F.collect_set("snapshot_date")).alias("days"))
    all_days = days.scalar()
    numbered = days.select(F.posexplode("days").alias("day", "snapshot_date"))
    slot = F.struct("day", "daily_net_cash", "cash_date")
    per_account = (
        flows.join(numbered, "snapshot_date")
        .groupBy("customer_id", "account_type")
        .agg(F.collect_list(slot).alias("cash"))
    )
    amount = flows.schema["daily_net_cash"].dataType
    places = F.when(F.size("days") > 0, F.sequence(F.lit(0), F.size("days") - 1))
    blank = F.transform(
        F.array_except(places, F.coalesce(F.col("cash.day"), F.array().cast("array<int>"))),
        lambda day: F.struct(
            day.alias("day"), F.lit(None).cast(amount).alias("daily_net_cash"), F.lit(None).cast("timestamp_ntz").alias("cash_date")
        ),
    )
    slots = F.when(F.col("cash").isNull(), blank).otherwise(F.concat("cash", blank))
    return (
        positions.join(per_account, ["customer_id", "account_type"], "left")
        .withColumn("days", all_days)
        .withColumn("slots", slots)
        .drop("cash")
        .join(curves, "ticker")
        .withColumn("slot", F.explode("slots"))
        .select(
            *positions.columns,
            F.get("days", F.col("slot.day")).alias("snapshot_date"),
            F.get("curve", F.col("slot.day")).alias("latest_price"),
            "slot.daily_net_cash",
            "slot.cash_date",
        )
    )


def snapshot_columns() -> list[Column]:
    """Snapshot columns over a row of position (may be NULL), price and cash."""
    held = F.col("held_ticker").isNotNull()
    shares, basis = F.col("current_shares"), F.col("total_cost_basis")
    value = shares * F.coalesce("latest_price", F.lit(0).cast(types.PRICE))
    gain = value - basis
    # Narrow enough that multiplying by 100 keeps all twelve digits.
    share = divide(gain, basis, 12).cast("decimal(26,12)")
    return [
        "snapshot_date",
        "customer_id",
        "account_type",
        F.when(held, "SECURITY").otherwise("CASH").alias("holding_type"),
        F.coalesce("held_ticker", F.lit("CASH")).alias("ticker"),
        F.when(held, F.round(shares, 0)).otherwise(F.col("daily_net_cash")).cast(types.SHARE).alias(
            "quantity"
        ),
        F.coalesce(basis, "daily_net_cash").cast(types.COST).alias("cost_basis"),
        F.round("average_cost_per_share", 2).cast(types.UNIT_COST).alias("average_cost_per_share"),
        F.coalesce("latest_price", F.lit(1).cast(types.PRICE)).cast(types.PRICE).alias("market_price"),
        F.round(F.when(held, value).otherwise(F.col("daily_net_cash")), 2)
        .cast(types.COST)
        .alias("market_value"),
        F.round(F.when(held & (shares > 0), gain).otherwise(0), 2)
        .cast(types.COST)
        .alias("unrealized_gain_loss"),
        F.round(F.when(held & (basis > 0), share * 100).otherwise(0), 2)
        .cast(types.PERCENT)
        .alias("unrealized_gain_loss_pct"),
        F.coalesce("last_trade_date", F.col("cash_date").cast("date")).alias("last_transaction_date"),
    ]


def portfolio_snapshot(
    dates: DataFrame,
    positions: DataFrame,
    prices: DataFrame,
    cash: DataFrame,
    date_cash: bool = False,
) -> DataFrame:
    """Holdings per date: all current positions priced as of it, and the daily cash.

    In the outer join that defines this, a cash row without a position has no
    snapshot date; `date_cash` gives it the cash date.  A cash row that meets a
    position leaves no row of its own; but two cash tickers on one day double the
    position's rows.

    The outer join is taken apart.  Positions carry their price curve and the cash of
    their account as arrays and are expanded over the dates last.  A cash row is left
    over unless its date is asked for and its account holds anything, so that side is
    matched against accounts.  Price curves are stored on the way.
    """
    days = dates.select(F.col("snapshot_date").cast("date").alias("snapshot_date")).distinct()
    flows = cash.select(
        "customer_id",
        "account_type",
        "daily_net_cash",
        F.col("transaction_date").alias("cash_date"),
        F.col("transaction_date").cast("date").alias("snapshot_date"),
    )

    spark = positions.sparkSession
    curves = write_table(
        price_curves(positions.select("ticker").distinct(), days, prices), f"{workspace(spark)}/curves"
    )
    securities = (
        dated_positions(positions, days, curves, flows)
        .withColumnRenamed("ticker", "held_ticker")
        .where(F.coalesce("current_shares", "daily_net_cash", F.lit(0)) > 0)
        .select(*snapshot_columns())
    )

    accounts = positions.select("customer_id", "account_type").distinct().alias("a")
    dated = flows.join(days.withColumn("asked", F.lit(True)), "snapshot_date", "left").alias("f")
    left_over = dated.join(
        accounts,
        (F.col("f.customer_id") == F.col("a.customer_id"))
        & (F.col("f.account_type") == F.col("a.account_type"))
        & F.col("f.asked"),
        "left_anti",
    )
    own_date = F.col("snapshot_date") if date_cash else F.lit(None).cast("date")
    cash_rows = (
        left_over.where(F.col("daily_net_cash") > 0)
        .withColumn("snapshot_date", own_date)
        .withColumns(
            {
                "held_ticker": F.lit(None).cast("string"),
                "current_shares": F.lit(None).cast(types.SHARE),
                "total_cost_basis": F.lit(None).cast(types.COST),
                "average_cost_per_share": F.lit(None).cast(types.UNIT_COST),
                "last_trade_date": F.lit(None).cast("date"),
                "latest_price": F.lit(None).cast(types.PRICE),
            }
        )
        .select(*snapshot_columns())
    )
    return securities.unionByName(cash_rows)


def snapshot_totals(dates: DataFrame, positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Value, cost and gain per date, account and ticker, of all positions.

    Shares and cost are summed before the dates come in, so what is made has a row per date,
    account type and ticker, however many customers there are.  Sums are exact: a total is the sum
    of whole shares times a price with two digits.
    """
    days = dates.select(F.col("snapshot_date").cast("date").alias("snapshot_date")).distinct()
    held = (
        positions.where(F.col("current_shares") > 0)
        .groupBy("account_type", "ticker")
        .agg(
            F.count("*").alias("positions"),
            F.sum("current_shares").cast(types.SHARE).alias("shares"),
            F.sum("total_cost_basis").cast(types.COST).alias("cost_basis"),
        )
    )
    asked = each_date(held.select("ticker").distinct(), days).withColumnRenamed("snapshot_date", "as_of")
    dated = asof_prices(asked, prices).withColumnRenamed("as_of", "snapshot_date")
    value = F.round(F.col("shares") * F.coalesce("latest_price", F.lit(0).cast(types.PRICE)), 2).cast(types.COST)
    return held.join(dated, "ticker").select(
        "snapshot_date",
        "account_type",
        "ticker",
        "positions",
        "shares",
        "cost_basis",
        value.alias("market_value"),
        (value - F.col("cost_basis")).cast(types.COST).alias("unrealized_gain_loss"),
    )


def write_snapshot(snapshot: DataFrame, path: str, at: dt.datetime, few_days: bool = False) -> DataFrame:
    """Store snapshots by date, with the time they were made; a date that is made again replaces its old rows.

    With `few_days`, such as year ends, rows are written by the tasks that make them and are not shuffled again.
    """
    return write_table(stamped(snapshot, "processed_timestamp", at), path, "overwrite", ("snapshot_date",), few_days)


def latest_cash(cash: DataFrame) -> DataFrame:
    """The newest day's net cash of each customer and account."""
    return latest_per_key(
        cash,
        ["customer_id", "account_type"],
        [F.desc("transaction_date"), F.asc("ticker"), F.desc("daily_net_cash")],
    )


def missing_cash(cash: DataFrame, history: DataFrame) -> DataFrame:
    """Newest cash of accounts that have no cash row in the given slice of history."""
    shown = history.where(F.col("holding_type") == "CASH").select("customer_id", "account_type")
    return cash.join(shown, ["customer_id", "account_type"], "left_anti")


def holdings_with_cash(history: DataFrame, cash: DataFrame) -> DataFrame:
    """History rows, with the newest cash beside the rows that are cash."""
    h, c = history.alias("h"), cash.alias("c")
    return h.join(
        c,
        (F.col("h.customer_id") == F.col("c.customer_id"))
        & (F.col("h.account_type") == F.col("c.account_type"))
        & (F.col("h.holding_type") == "CASH"),
        "left",
    )


def current_holdings(history: DataFrame, cash: DataFrame, at: dt.datetime) -> DataFrame:
    """Holdings of the newest snapshot, with newer cash where there is some, refreshed at a given time."""
    top = history.agg(F.max("snapshot_date")).scalar()
    shown = newest(history, "snapshot_date")
    flows = latest_cash(cash)

    is_cash = F.col("h.holding_type") == "CASH"
    newer = is_cash & (F.col("c.transaction_date") > F.col("h.snapshot_date"))

    def fresh(name: str) -> Column:
        value = F.when(newer, F.col("c.daily_net_cash")).otherwise(F.col(f"h.{name}"))
        return value.cast(history.schema[name].dataType).alias(name)

    def zero_for_cash(name: str) -> Column:
        value = F.when(is_cash, 0).otherwise(F.col(f"h.{name}"))
        return value.cast(history.schema[name].dataType).alias(name)

    from_history = (
        holdings_with_cash(shown, flows)
        .where(F.col("h.quantity") > 0)
        .select(
            "h.snapshot_date",
            "h.customer_id",
            "h.account_type",
            F.coalesce("h.holding_type", F.lit("CASH")).alias("holding_type"),
            F.coalesce("h.ticker", F.lit("CASH")).alias("ticker"),
            fresh("quantity"),
            fresh("cost_basis"),
            "h.average_cost_per_share",
            "h.market_price",
            fresh("market_value"),
            zero_for_cash("unrealized_gain_loss"),
            zero_for_cash("unrealized_gain_loss_pct"),
            F.coalesce(
                "h.last_transaction_date", F.col("c.transaction_date").cast("date")
            ).alias("last_transaction_date"),
        )
    )
    amount = F.col("daily_net_cash")
    from_cash = (
        missing_cash(flows, shown)
        .where(amount > 0)
        .select(
            top.alias("snapshot_date"),
            "customer_id",
            "account_type",
            F.lit("CASH").alias("holding_type"),
            F.lit("CASH").alias("ticker"),
            amount.cast(types.SHARE).alias("quantity"),
            amount.alias("cost_basis"),
            F.lit(None).cast(types.UNIT_COST).alias("average_cost_per_share"),
            F.lit(1).cast(types.PRICE).alias("market_price"),
            amount.alias("market_value"),
            F.lit(0).cast(types.COST).alias("unrealized_gain_loss"),
            F.lit(0).cast(types.PERCENT).alias("unrealized_gain_loss_pct"),
            F.col("transaction_date").cast("date").alias("last_transaction_date"),
        )
    )
    return stamped(from_history.unionByName(from_cash), "last_refreshed", at)
