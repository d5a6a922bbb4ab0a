"""Domain tables derived from the order, customer and event tables.

Money is cast to decimals before any sum.  Everything is an expression over whole
tables; nothing here is sampled or made up row by row.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_positions
from ..operators.payload import build_payload
from ..sources.files import table
from ..types import POSITIONS
from .cash import cash_detail, daily_cash, snapshot_dates
from .trades import enrich_trades

# Where the order history is cut into two batches.
BATCH_CUT = dt.date(1998, 7, 1)
AS_OF = dt.datetime(2024, 2, 1)


def _priced(lines: DataFrame) -> DataFrame:
    """Order lines with whole shares, a decimal value and a price per share."""
    value = F.col("l_extendedprice").cast("decimal(10,2)")
    shares = F.col("l_quantity").cast("int")
    return lines.withColumns(
        {
            "shares": shares,
            "total_trade_value": value,
            "trade_price": F.round(value / shares, 2).cast("decimal(10,2)"),
        }
    )


def _trades(lines: DataFrame, account: str, ticker: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return _priced(lines).select(
        day.alias("transaction_date"),
        F.md5(F.concat(day.cast("string"), F.col("o_custkey").cast("string"))).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col(account).alias("account_type"),
        F.when(F.col("l_returnflag") == "R", "Sell").otherwise("Buy").alias("trade_action"),
        F.col(ticker).cast("string").alias("ticker"),
        "shares",
        "trade_price",
        "total_trade_value",
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )


def _order_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def trades_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Trades with parts as tickers and order priorities as accounts."""
    return _trades(_order_lines(_lines(spark, folder), _orders(spark, folder)), "o_orderpriority", "l_partkey")


def brand_trades(spark: SparkSession, folder: str, all_days: bool = False) -> DataFrame:
    """Trades with brands as tickers and market segments as accounts, enriched.

    Orders, not their many lines, are shuffled to meet the customers.  Where the caller wants `all_days`, lines meet
    their parts first, while they are narrow, and their orders last, so the trades of an order stay together
    in what follows; else they meet the orders first, whose filters leave few of them.
    """
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    orders = _orders(spark, folder).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    of_part, lines = F.col("l_partkey") == F.col("p_partkey"), _lines(spark, folder)
    lines = _order_lines(lines.join(parts, of_part), orders) if all_days else _order_lines(lines, orders).join(parts, of_part)
    return enrich_trades(_trades(lines, "c_mktsegment", "p_brand"))


def newest_trade_day(spark: SparkSession, folder: str) -> DataFrame:
    """The last day on which an order has lines, as one row."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.join(lines, "o_orderkey", "left_semi").agg(F.max("day").alias("day"))


def payload_input(trades: DataFrame) -> DataFrame:
    """Trades in the layout that payloads are built from."""
    return trades.select(
        "customer_id",
        "transaction_date",
        "account_type",
        F.lit("Securities Trade").alias("transaction_category"),
        "ticker",
        F.col("shares").cast("decimal(38,2)").alias("shares"),
        F.col("trade_price").cast("decimal(38,2)").alias("trade_price"),
        F.col("total_trade_value").cast("decimal(38,2)").alias("total_trade_value"),
        F.col("trade_action").alias("action"),
    )


def trades_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Trades as landed: day, id and JSON payload."""
    return build_payload(payload_input(trades_flat(spark, folder)))


def cash_deposits(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases in the event stream, as deposits into the customer's segment account."""
    events = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return events.join(customers, F.col("user_id") == F.col("c_custkey")).select(
        F.col("event_id").cast("string").alias("deposit_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("transaction_date"),
        F.lit("CASH").alias("ticker"),
        F.col("value").cast("decimal(38,2)").alias("deposit_amount"),
        F.col("c_mktsegment").alias("account_type_name"),
        F.lit("Cash Deposit").alias("transaction_category"),
    )


def detail(spark: SparkSession, folder: str) -> DataFrame:
    return cash_detail(cash_deposits(spark, folder), brand_trades(spark, folder))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return daily_cash(detail(spark, folder))


def part_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Closing price per part and shipping day: the greatest price seen."""
    return (
        _priced(table(spark, folder, "lineitem"))
        .groupBy(
            F.col("l_partkey").cast("string").alias("ticker"),
            F.col("l_shipdate").cast("date").alias("price_date"),
        )
        .agg(F.max("trade_price").alias("close_price"))
    )


def brand_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Closing price per brand and shipping day."""
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return (
        _priced(table(spark, folder, "lineitem"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.col("p_brand").alias("ticker"), F.col("l_shipdate").cast("date").alias("price_date")
        )
        .agg(F.max("trade_price").alias("close_price"))
    )


def no_positions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], POSITIONS)


def positions(spark: SparkSession, folder: str) -> DataFrame:
    """Positions after one batch with all trades."""
    return merge_positions(no_positions(spark), brand_trades(spark, folder), AS_OF)


def feed_days(trades: DataFrame, cash: DataFrame) -> DataFrame:
    """Every day on which anything was traded or paid in."""
    return snapshot_dates(trades, cash).select(F.col("snapshot_date").cast("date")).distinct()


def year_ends(days: DataFrame) -> DataFrame:
    """The last of the given days in each calendar year, for yearly statements."""
    return (
        days.groupBy(F.year("snapshot_date").alias("year"))
        .agg(F.max("snapshot_date").alias("snapshot_date"))
        .select("snapshot_date")
    )


def contributions(spark: SparkSession, folder: str) -> DataFrame:
    """Retirement contributions: order lines by shipping day, with a schedule."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        _priced(lines)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_shipdate").alias("transaction_date"),
            F.col("shares").cast("decimal(38,2)").alias("share_amount"),
            F.col("trade_price").cast("decimal(38,2)").alias("trade_price"),
            F.col("l_linestatus").alias("account_type_name"),
            F.col("total_trade_value").cast("decimal(38,2)").alias("total_trade_amount"),
            F.col("l_partkey").cast("string").alias("ticker"),
            F.lit("Retirement Contribution").alias("transaction_category"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("l_returnflag") == "A", "Weekly").otherwise("Monthly").alias(
                "contribution_schedule"
            ),
        )
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with personal data computed from their key."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    k = "cast(c_custkey as int)"
    month_day = f"1 + {k} % 12, 1 + {k} % 28"
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "c_custkey as customer_id",
            "split_part(c_name, '#', 1) as first_name",
            "c_mktsegment as last_name",
            f"make_date(2024 - (20 + {k} % 60), {month_day}) as birthdate",
            "20 + c_custkey % 60 as age",
            "concat(c_custkey, ' Market Street') as street_address",
            "n_name as state",
            "10000 + c_custkey % 90000 as zip_code",
            "r_name as country",
            "concat('(', 200 + c_custkey % 800, ') ', lpad(c_custkey % 1000, 3, '0'), '-', "
            "lpad(c_custkey % 10000, 4, '0')) as phone_number",
            "case c_custkey % 50 when 7 then null when 11 then lpad(c_custkey % 1000, 9, '0') "
            "else concat(lpad(c_custkey % 1000, 3, '0'), '-', lpad(c_custkey % 100, 2, '0'), '-', "
            "lpad(c_custkey % 10000, 4, '0')) end as ssn",
            f"date_add(date'2010-01-01', {k} % 3650) as hire_date",
            f"date_add(date'2023-01-01', {k} % 365) as start_date",
            "cast(65 as bigint) as retirement_age",
            f"make_date(2024 - (20 + {k} % 60) + 65, {month_day}) as retirement_date",
            "20 + c_custkey % 60 >= 65 as retired",
            "c_custkey % 10 as reported_risk_level",
            "concat('Risk ', c_custkey % 10) as risk_level_description",
            "cast(30000 + abs(cast(c_acctbal as decimal(12,2))) * 10 as decimal(38,2)) as salary",
            "concat(c_mktsegment, ' Manager') as job_title",
            "c_mktsegment as department",
            "case when c_acctbal < 0 then 'Credit' else 'Standard' end as customer_type",
        )
    )


def advisors(spark: SparkSession, folder: str) -> DataFrame:
    """Advisors with personal data computed from their key."""
    return (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "s_suppkey as advisor_id",
            "split_part(s_name, '#', 1) as first_name",
            "25 + s_suppkey % 40 as age",
            "concat(s_suppkey, ' Broad Street') as street_address",
            "n_name as state",
            "concat('(', 200 + s_suppkey % 800, ') 555-', lpad(s_suppkey % 10000, 4, '0')) "
            "as phone_number",
            "date_add(date'2000-01-01', cast(s_suppkey % 5000 as int)) as advisor_start_date",
        )
    )


def customer_advisor(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer's advisor: the first supplier of the customer's nation."""
    first = (
        table(spark, folder, "supplier")
        .groupBy("s_nationkey")
        .agg(F.min("s_suppkey").alias("advisor_id"))
    )
    return (
        table(spark, folder, "customer")
        .join(first, F.col("c_nationkey") == F.col("s_nationkey"))
        .select(F.col("c_custkey").alias("customer_id"), "advisor_id")
    )


def advisor_users(spark: SparkSession, folder: str) -> DataFrame:
    """Login of each advisor."""
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("ADV"), F.col("s_suppkey").cast("string")).alias("username"),
        F.col("s_suppkey").alias("advisor_id"),
    )


SEGMENTS = {
    0: "AUTOMOBILE",
    1: "BUILDING",
    2: "FURNITURE",
    3: "HOUSEHOLD",
    4: "MACHINERY",
}


def customer_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    """The portfolio of each customer's segment; inactive when the account is overdrawn."""
    number = F.lit(None).cast("bigint")
    for portfolio, segment in SEGMENTS.items():
        number = F.when(F.col("c_mktsegment") == segment, portfolio).otherwise(number)
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        number.alias("portfolio_id"),
        F.lit(dt.date(2023, 1, 1)).alias("start_date"),
        F.lit(None).cast("string").alias("end_date"),
        (F.col("c_acctbal") >= 0).alias("active"),
    )


def portfolios(spark: SparkSession) -> DataFrame:
    """The five segment portfolios."""
    return spark.createDataFrame(
        [(number, f"{segment} Portfolio") for number, segment in SEGMENTS.items()],
        "portfolio_id bigint, portfolio_description string",
    )


def retirement_plans(spark: SparkSession, folder: str) -> DataFrame:
    """Target-year plan of each customer, in steps of five years."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey as customer_id",
        "2024 + 65 - (20 + c_custkey % 60) as retirement_year",
        "65 - (20 + c_custkey % 60) as years_to_fund_target",
        "concat('Target ', 5 * ((2024 + 65 - (20 + c_custkey % 60)) div 5)) as assigned_fund_name",
    )


def compositions(spark: SparkSession, folder: str) -> DataFrame:
    """Portfolio per brand: the share of each part type in its retail value, as JSON text."""
    weights = (
        table(spark, folder, "part")
        .groupBy("p_brand", "p_type")
        .agg(F.sum(F.col("p_retailprice").cast("decimal(12,2)")).alias("value"))
    )
    total = F.sum("value").cast("double")
    return (
        weights.groupBy("p_brand")
        .agg(
            total.alias("total"),
            F.array_sort(
                F.collect_list(F.struct(F.md5("p_type").alias("asset_class_hash"), "value"))
            ).alias("parts"),
        )
        .select(
            F.regexp_replace("p_brand", "^Brand#", "").cast("bigint").alias("portfolio_id"),
            F.col("p_brand").alias("portfolio_description"),
            F.to_json(
                F.struct(
                    F.transform(
                        "parts",
                        lambda part: F.struct(
                            (part["value"].cast("double") / F.col("total")).alias("amount"),
                            part["asset_class_hash"].alias("asset_class_hash"),
                        ),
                    ).alias("composition")
                )
            ).alias("asset_class_composition"),
        )
    )


def asset_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One class per part type."""
    return (
        table(spark, folder, "part")
        .groupBy("p_type")
        .agg(F.count("*").alias("number_of_securities"))
        .select(
            F.md5("p_type").alias("asset_class_hash"),
            F.col("p_type").alias("asset_class_description"),
            "number_of_securities",
        )
    )
