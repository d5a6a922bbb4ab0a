"""The same questions asked in Spark SQL over registered views."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from holdfast.plans import cash as C
from holdfast.plans import holdings as H
from holdfast.plans import trades as P
from holdfast.plans.views import register_views
from holdfast.types import DAILY_CASH, SECURITY_TRADES_CSV

PAYLOAD = (
    '{"customer_id":7,"account_type":"IRA","trades":['
    '{"ticker":"A","shares":3,"trade_price":2.50,"total_trade_value":7.50,"action":"Buy"},'
    '{"ticker":"B","shares":1,"trade_price":4.00,"total_trade_value":4.00,"action":"Sell"}]}'
)


def raw(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "t1", PAYLOAD)], SECURITY_TRADES_CSV)
    return df.withColumn("transaction_payload", F.try_parse_json("transaction_payload"))


def test_paths_and_unnesting(spark, rows):
    register_views({"security_trades": raw(spark)})
    got = spark.sql("""
        SELECT transaction_date, transaction_id,
               transaction_payload:customer_id::BIGINT AS customer_id,
               transaction_payload:account_type::STRING AS account_type,
               t.value:action::STRING AS trade_action, t.value:ticker::STRING AS ticker,
               t.value:shares::INT AS shares, t.value:trade_price::DECIMAL(10,2) AS trade_price,
               t.value:total_trade_value::DECIMAL(10,2) AS total_trade_value
        FROM security_trades, LATERAL variant_explode(transaction_payload:trades) t
        WHERE transaction_id = 't1'""")
    assert rows(got) == rows(P.flattened(raw(spark)), *got.columns)


def test_group_by_all(spark, rows):
    register_views({"security_trades_flattened": P.flattened(raw(spark))})
    got = spark.sql("""
        SELECT customer_id, CAST(transaction_date AS TIMESTAMP_NTZ) AS transaction_date, transaction_id,
               'CASH' AS ticker, sum(cash_flow_impact) AS amount, account_type
        FROM security_trades_flattened GROUP BY ALL""")
    columns = ("customer_id", "transaction_date", "transaction_id", "ticker", "amount")
    ours = C.trade_cash(P.flattened(raw(spark))).withColumnRenamed(
        "security_purchase_transaction_id", "transaction_id"
    )
    assert rows(got, *columns) == rows(ours, *columns)
    assert got.first().amount == Decimal("-3.50")


def test_latest_row_per_key(spark, rows):
    flows = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, day), "CASH", "IRA", Decimal(day)) for day in (1, 2, 3)], DAILY_CASH
    )
    register_views({"daily_cash_position_summary": flows})
    got = spark.sql("""
        SELECT customer_id, daily_net_cash FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id, account_type
                                         ORDER BY transaction_date DESC) AS place
            FROM daily_cash_position_summary) WHERE place = 1""")
    assert rows(got) == rows(H.latest_cash(flows), "customer_id", "daily_net_cash")
