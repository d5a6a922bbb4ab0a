"""Table layouts, as Spark schemas."""

from pyspark.sql import types as T

TEXT = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
DATE = T.DateType()
TIMESTAMP = T.TimestampNTZType()

SHARE = T.DecimalType(18, 4)
COST = T.DecimalType(18, 2)
UNIT_COST = T.DecimalType(18, 4)
PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(38, 2)
# Conformed cash.  Up to 18 digits Spark computes on plain longs.
CASH = T.DecimalType(18, 2)
PERCENT = T.DecimalType(18, 4)


def schema(**columns: T.DataType) -> T.StructType:
    """Layout from column names and types, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CASH_DEPOSITS = schema(
    deposit_id=TEXT,
    customer_id=LONG,
    transaction_date=TIMESTAMP,
    ticker=TEXT,
    deposit_amount=AMOUNT,
    account_type_name=TEXT,
    transaction_category=TEXT,
)

# The CSV files carry the payload as JSON text; the table holds it as a variant.
SECURITY_TRADES_CSV = schema(transaction_date=DATE, transaction_id=TEXT, transaction_payload=TEXT)

# What a payload is read as.  Shares keep their fraction until `to_int` rounds them.
PAYLOAD = (
    "struct<customer_id: bigint, account_type: string, trades: array<struct<"
    "action: string, ticker: string, shares: decimal(38,10), "
    "trade_price: decimal(10,2), total_trade_value: decimal(10,2)>>>"
)

TRADES_FLAT = schema(
    transaction_date=DATE,
    transaction_id=TEXT,
    customer_id=LONG,
    account_type=TEXT,
    trade_action=TEXT,
    ticker=TEXT,
    shares=INT,
    trade_price=PRICE,
    total_trade_value=PRICE,
    share_change=INT,
    cash_flow_impact=PRICE,
)

DAILY_CASH = schema(
    customer_id=LONG,
    transaction_date=TIMESTAMP,
    ticker=TEXT,
    account_type=TEXT,
    daily_net_cash=CASH,
)

POSITION_KEY = ("customer_id", "account_type", "ticker")

POSITIONS = schema(
    customer_id=LONG,
    account_type=TEXT,
    ticker=TEXT,
    current_shares=SHARE,
    total_cost_basis=COST,
    average_cost_per_share=UNIT_COST,
    first_trade_date=DATE,
    last_trade_date=DATE,
    last_updated=TIMESTAMP,
)

SNAPSHOT_TOTALS = schema(
    snapshot_date=DATE,
    account_type=TEXT,
    ticker=TEXT,
    positions=LONG,
    shares=SHARE,
    cost_basis=COST,
    market_value=COST,
    unrealized_gain_loss=COST,
)

RETIREMENT_CONTRIBUTIONS = schema(
    transaction_date=TIMESTAMP,
    share_amount=AMOUNT,
    trade_price=AMOUNT,
    account_type_name=TEXT,
    total_trade_amount=AMOUNT,
    ticker=TEXT,
    transaction_category=TEXT,
    customer_id=LONG,
)

LEDGER = schema(transaction_date=DATE, unload_status=TEXT, unload_time=TIMESTAMP)

COMPOSITION = "struct<composition: array<struct<amount: double, asset_class_hash: string>>>"

DIM_PORTFOLIO = schema(
    portfolio_id=LONG,
    portfolio_description=TEXT,
    risk_level=LONG,
    risk_level_description=TEXT,
    asset_class_composition=TEXT,
)

DIM_SECURITIES = schema(
    ticker=TEXT,
    name=TEXT,
    exchange=TEXT,
    sector=TEXT,
    marketcap=TEXT,
    geo=TEXT,
    asset_class_hash=TEXT,
)

DIM_ASSET_CLASS = schema(
    asset_class_hash=TEXT,
    asset_class_description=TEXT,
    number_of_securities=LONG,
    sector=TEXT,
    marketcap=TEXT,
    geo=TEXT,
    security_type=TEXT,
)

DIM_RETIREMENT_FUNDS = schema(
    ticker=TEXT,
    fund_name=TEXT,
    target_year=LONG,
    years_to_retirement=LONG,
    bond_pct=AMOUNT,
    us_high_cap_pct=AMOUNT,
    international_pct=AMOUNT,
    us_mid_cap_pct=AMOUNT,
    emerging_markets_pct=AMOUNT,
    total_equity_pct=T.DecimalType(38, 17),
    total_bond_pct=AMOUNT,
)
