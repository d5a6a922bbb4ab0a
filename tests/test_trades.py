"""Payloads: casts, odd input, large groups."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from holdfast.operators import build_payload, flatten_trades
from holdfast.plans import trades as P
from holdfast.types import SECURITY_TRADES_CSV


def payloads(spark, *texts):
    rows = [(None, f"t{place}", text) for place, text in enumerate(texts)]
    df = spark.createDataFrame(rows, SECURITY_TRADES_CSV)
    return df.withColumn("transaction_payload", F.try_parse_json("transaction_payload"))


def one(action, shares="10", price="2.00", value="20.00"):
    name = "null" if action is None else f'"{action}"'
    return (
        f'{{"ticker":"A","shares":{shares},"trade_price":{price},'
        f'"total_trade_value":{value},"action":{name}}}'
    )


def doc(*trades):
    return f'{{"customer_id":7,"account_type":"IRA","trades":[{",".join(trades)}]}}'


def test_everything_but_buy_is_a_sale(spark, rows):
    raw = payloads(spark, doc(one("Buy"), one("Sell"), one("Transfer"), one(None)))
    got = rows(P.flattened(raw), "trade_action", "share_change", "cash_flow_impact")
    assert got == sorted(
        [
            ("Buy", 10, Decimal("-20.00")),
            ("Sell", -10, Decimal("20.00")),
            ("Transfer", -10, Decimal("20.00")),
            (None, -10, Decimal("20.00")),
        ],
        key=repr,
    )


def test_only_the_word_sell_counts_as_sold(spark):
    raw = payloads(spark, doc(one("Buy", "50"), one("Sell"), one("Transfer"), one(None)))
    row = P.position_summary(P.flattened(raw)).first()
    assert (row.net_shares, row.total_bought_value, row.total_sold_value) == (20, 20, 20)


@pytest.mark.parametrize(
    ("shares", "expected"),
    [("1.50", 2), ("-1.50", -2), ("2.49", 2), ("7", 7), ('"abc"', None), ('"8"', 8)],
)
def test_shares_round_half_away_from_zero(spark, shares, expected):
    assert flatten_trades(payloads(spark, doc(one("Buy", shares)))).first().shares == expected


def test_price_rounds_to_cents(spark):
    row = flatten_trades(payloads(spark, doc(one("Buy", price="2.345", value="1e1")))).first()
    assert (row.trade_price, row.total_trade_value) == (Decimal("2.35"), Decimal("10.00"))


def test_payloads_without_trades_give_no_rows(spark):
    odd = ['{"trades":[]}', '{"trades":null}', "{}", "{bad", '{"trades":{"ticker":"A"}}', None]
    assert flatten_trades(payloads(spark, *odd)).count() == 0


def trade_rows(spark, groups):
    """`groups`: (customer, number of distinct trades, copies of each)."""
    frames = [
        spark.range(count)
        .select(
            F.lit(customer).cast("bigint").alias("customer_id"),
            F.lit("2024-01-02").cast("date").alias("transaction_date"),
            F.lit("IRA").alias("account_type"),
            F.lit("Securities Trade").alias("transaction_category"),
            F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticker"),
            (F.col("id") + 1).cast("decimal(38,2)").alias("shares"),
            F.lit(1).cast("decimal(38,2)").alias("trade_price"),
            (F.col("id") + 1).cast("decimal(38,2)").alias("total_trade_value"),
            F.lit("Buy").alias("action"),
        )
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        .drop("_copy")
        for customer, count, copies in groups
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def test_one_payload_per_group_of_any_size(spark, rows):
    trades = trade_rows(spark, [(1, 3, 1), (2, 30_000, 1), (3, 1, 400), (None, 60, 2)])
    whole = build_payload(trades)
    assert whole.count() == 4
    columns = ("customer_id", "ticker", "shares")
    expected = trades.withColumn("shares", F.col("shares").cast("int"))
    assert rows(flatten_trades(whole), *columns) == rows(expected, *columns)


def test_payloads_take_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "trades")
    trade_rows(spark, [(1, 3, 1)]).write.parquet(path)
    text = build_payload(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Join" not in text


def test_payload_keeps_group_columns(spark):
    row = build_payload(trade_rows(spark, [(5, 2, 1)])).select(
        "transaction_date",
        "transaction_id",
        F.to_json("transaction_payload").alias("text"),
        (F.md5(F.lit("2024-01-025")) == F.col("transaction_id")).alias("key_ok"),
    ).first()
    assert row.key_ok
    assert '"transaction_category":"Securities Trade"' in row.text
    assert '"transaction_date":"2024-01-02"' in row.text


def test_top_traders_ties_go_to_smaller_ids(spark, rows):
    flat = spark.createDataFrame([(3,), (3,), (2,), (2,), (1,)], "customer_id bigint")
    assert [tuple(row) for row in P.top_traders(flat, 2).collect()] == [(2, 2), (3, 2)]
