"""Queries that show one relational operator each."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as O
from ..functions import divide, fits, mask_social, to_int
from ..plans import adapters as A
from ..plans import cash as C
from ..plans import holdings as H
from ..plans import trades as P
from ..plans.customers import customer_overview as overview
from ..sources.files import table
from .common import plain, stored


def limit_preview(spark: SparkSession, folder: str) -> DataFrame:
    return plain(A.customers(spark, folder).orderBy("customer_id").limit(100)).select(
        "customer_id", "first_name", "last_name", "phone_number", "zip_code", "state"
    )


def filter_eq(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("transaction_date") == F.lit(dt.date(1998, 6, 25))
    return plain(A.brand_trades(spark, folder).where(day))


def filter_like(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").where(F.col("p_name").like("%ring%")).select(
        "p_partkey", "p_name", "p_type"
    )


def filter_in(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").where(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    ).select("c_custkey", "c_mktsegment")


def filter_null(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with and without an SSN."""
    people = A.customers(spark, folder)
    with_ssn = people.where(F.col("ssn").isNotNull()).withColumn("has_ssn", F.lit("yes"))
    without = people.where(F.col("ssn").isNull()).withColumn("has_ssn", F.lit("no"))
    return with_ssn.unionByName(without).select("customer_id", "has_ssn")


def case_stage(spark: SparkSession, folder: str) -> DataFrame:
    people = overview(
        A.customers(spark, folder),
        A.customer_portfolio(spark, folder),
        A.portfolios(spark),
        A.retirement_plans(spark, folder),
    )
    return people.groupBy("retirement_stage").agg(F.count("*").alias("customers"))


def enrich_trades(spark: SparkSession, folder: str) -> DataFrame:
    return plain(P.enrich_trades(A.trades_flat(spark, folder)))


def join_inner(spark: SparkSession, folder: str) -> DataFrame:
    return A.customer_advisor(spark, folder).join(A.advisor_users(spark, folder), "advisor_id")


def left_join_filtered(spark: SparkSession, folder: str) -> DataFrame:
    active = A.customer_portfolio(spark, folder).where("active")
    return (
        A.customers(spark, folder)
        .select("customer_id", "customer_type")
        .join(active.select("customer_id", "portfolio_id"), "customer_id", "left")
        .select("customer_id", "customer_type", F.col("portfolio_id").cast("double"))
    )


def left_join_left_pred(spark: SparkSession, folder: str) -> DataFrame:
    """Cash movements as history; only deposits are matched with the newest cash."""
    rows = A.detail(spark, folder).withColumn(
        "holding_type", F.when(F.col("cash_deposit_id").isNotNull(), "CASH").otherwise("SECURITY")
    )
    flows = H.latest_cash(A.daily(spark, folder))
    return plain(
        H.holdings_with_cash(rows, flows)
        .groupBy("h.account_type", "h.holding_type")
        .agg(
            F.count("*").alias("rows"),
            F.count("c.customer_id").alias("matched"),
            F.sum("h.amount").alias("amount"),
            F.coalesce(F.sum("c.daily_net_cash"), F.lit(0).cast("decimal(18,2)")).alias("newest_cash"),
        )
    )


def cross_dates(spark: SparkSession, folder: str) -> DataFrame:
    trades = A.brand_trades(spark, folder)
    dates = A.feed_days(trades, A.cash_deposits(spark, folder))
    return plain(O.each_date(table(spark, folder, "part").select("p_brand").distinct(), dates))


def asof_price(spark: SparkSession, folder: str) -> DataFrame:
    asked = A.trades_flat(spark, folder).select("ticker", F.col("transaction_date").alias("as_of"))
    return plain(O.asof_prices(asked, A.part_prices(spark, folder)))


def asof_instant(spark: SparkSession, folder: str) -> DataFrame:
    """For every other event, to the microsecond, the last purchase value of the same key; hours are the ranges."""
    events = table(spark, folder, "events").withColumn("ticker", F.get_json_object("props", "$.k"))
    bought = F.col("event_type") == "purchase"
    prices = events.where(bought).select(
        "ticker", F.col("ts").alias("price_time"), F.col("value").cast("decimal(10,2)").alias("close_price")
    )
    found = O.asof_instants(events.where(~bought).select("ticker", F.col("ts").alias("as_of")), prices, width=3600)
    return plain(found.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def full_outer_cash(spark: SparkSession, folder: str) -> DataFrame:
    """Cash from trades beside cash from deposits, per customer and account."""
    def totals(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("customer_id", "account_type").agg(F.sum("amount").alias(name))

    traded = totals(C.trade_cash(A.brand_trades(spark, folder)), "traded").alias("t")
    paid = totals(C.deposit_cash(A.cash_deposits(spark, folder)), "paid").alias("p")
    return plain(
        traded.join(
            paid,
            (F.col("t.customer_id") == F.col("p.customer_id"))
            & (F.col("t.account_type") == F.col("p.account_type")),
            "full",
        ).select(
            F.coalesce("t.customer_id", "p.customer_id").alias("customer_id"),
            F.coalesce("t.account_type", "p.account_type").alias("account_type"),
            "traded",
            "paid",
        )
    )


def anti_missing_cash(spark: SparkSession, folder: str) -> DataFrame:
    """Newest cash of the accounts that never had a deposit."""
    shown = A.cash_deposits(spark, folder).select(
        "customer_id",
        F.col("account_type_name").alias("account_type"),
        F.col("ticker").alias("holding_type"),
    )
    return plain(H.missing_cash(H.latest_cash(A.daily(spark, folder)), shown))


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Trades of the newest day; the day comes from two columns, so that the filter goes to the orders before any join."""
    on_day = F.col("transaction_date") == A.newest_trade_day(spark, folder).scalar()
    return plain(A.brand_trades(spark, folder).where(on_day))


def rows_per_day(spark: SparkSession, folder: str) -> DataFrame:
    days = [
        rows.groupBy(F.col("transaction_date").cast("date").alias("transaction_date"))
        .agg(F.count("*").alias("rows"))
        .withColumn("feed", F.lit(name))
        for name, rows in (
            ("trades", A.trades_flat(spark, folder)),
            ("deposits", A.cash_deposits(spark, folder)),
        )
    ]
    return plain(days[0].unionByName(days[1]))


def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        A.cash_deposits(spark, folder).agg(
            F.count("*").alias("rows"),
            F.min("transaction_date").alias("first_day"),
            F.max("transaction_date").alias("last_day"),
        )
    )


def trade_summary(spark: SparkSession, folder: str) -> DataFrame:
    return plain(O.trade_summary(A.brand_trades(spark, folder)))


def snapshot_dates(spark: SparkSession, folder: str) -> DataFrame:
    return plain(C.snapshot_dates(A.trades_flat(spark, folder), A.cash_deposits(spark, folder)))


def first_value_price(spark: SparkSession, folder: str) -> DataFrame:
    """Newest close per part, as an aggregate that combines before the shuffle."""
    return plain(
        A.part_prices(spark, folder)
        .groupBy("ticker")
        .agg(
            F.max_by("close_price", "price_date").alias("latest_price"),
            F.max("price_date").alias("price_date"),
        )
    )


def latest_cash(spark: SparkSession, folder: str) -> DataFrame:
    return plain(H.latest_cash(A.daily(spark, folder)))


def sort_multi(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        A.customers(spark, folder)
        .select("customer_id", "state", "salary")
        .orderBy("state", F.desc("salary"), "customer_id")
    )


def scalars_math(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    value = F.col("l_extendedprice").cast("decimal(10,2)")
    tax = F.col("l_tax").cast("decimal(10,2)")
    off = F.col("l_discount").cast("decimal(10,2)")
    shares = F.col("l_quantity").cast("decimal(10,2)")
    return plain(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.coalesce(F.when(tax > off, tax), off, F.lit(0)).cast("decimal(10,2)").alias("rate"),
            F.abs(tax - off).alias("gap"),
            F.round(value * (1 + tax) * (1 - off), 2).alias("charge"),
            F.greatest(tax, off).alias("greatest_rate"),
            divide(value, tax * 100, 2).alias("guarded"),
            to_int(shares / 4, "bigint").alias("quarter"),
            F.round(off / (tax + 1) * 100, 2).alias("pct"),
        ),
        ("guarded",),
    )


def scalars_text(spark: SparkSession, folder: str) -> DataFrame:
    people = A.customers(spark, folder)
    return people.select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.concat_ws("_", "state", "country", "ssn").alias("joined"),
        F.replace("phone_number", F.lit("-"), F.lit("_")).alias("phone"),
        F.md5(F.concat("street_address", F.col("birthdate").cast("string"))).alias("hash"),
        mask_social(F.col("ssn")).alias("masked"),
    )


def scalars_date(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    return plain(
        orders.select(
            "o_orderkey",
            F.date_add(day, 1).alias("next_day"),
            F.date_format(F.expr("timestampadd(HOUR, -1, o_orderdate)"), "yyyy-MM-dd HH:mm:ss").alias("hour_before"),
            F.coalesce(
                fits(F.regexp_extract("o_orderpriority", r"^\d", 0), "bigint"), F.lit(-1)
            ).alias("priority"),
            fits(F.col("o_orderpriority"), "date").cast("string").alias("no_date"),
        )
    )


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Objects to JSON text, to variants, and back by path, over events and their props."""
    events = table(spark, folder, "events")
    text = F.to_json(
        F.struct(
            "event_id",
            F.col("value").cast("decimal(10,2)").alias("value"),
            F.array(F.struct("event_type", "user_id")).alias("parts"),
            F.col("props"),
        )
    )
    parsed = events.select(F.try_parse_json(text).alias("v"))
    return plain(
        parsed.select(
            F.try_variant_get("v", "$.event_id", "bigint").alias("event_id"),
            F.try_variant_get("v", "$.value", "decimal(10,2)").alias("value"),
            F.try_variant_get("v", "$.parts[0].event_type", "string").alias("event_type"),
            F.try_variant_get(
                F.try_parse_json(F.try_variant_get("v", "$.props", "string")), "$.k", "bigint"
            ).alias("k"),
            F.coalesce(
                F.try_variant_get("v", "$.missing", "bigint"), F.lit(-1)
            ).alias("missing"),
        )
    )


QUERIES = {
    "limit_preview": limit_preview,
    "filter_eq": filter_eq,
    "filter_like": filter_like,
    "filter_in": filter_in,
    "filter_null": filter_null,
    "case_stage": case_stage,
    "enrich_trades": enrich_trades,
    "join_inner": join_inner,
    "left_join_filtered": left_join_filtered,
    "left_join_left_pred": left_join_left_pred,
    "cross_dates": cross_dates,
    "asof_price": asof_price,
    "asof_instant": asof_instant,
    "full_outer_cash": full_outer_cash,
    "anti_missing_cash": anti_missing_cash,
    "latest_snapshot": latest_snapshot,
    "rows_per_day": rows_per_day,
    "table_profile": table_profile,
    "trade_summary": trade_summary,
    "snapshot_dates": snapshot_dates,
    "first_value_price": first_value_price,
    "latest_cash": latest_cash,
    "sort_multi": sort_multi,
    "scalars_math": scalars_math,
    "scalars_text": scalars_text,
    "scalars_date": scalars_date,
    "json_roundtrip": json_roundtrip,
}
