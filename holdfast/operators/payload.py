"""Nesting trades into JSON payloads, and unnesting them again."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import to_int, transaction_key
from ..types import PAYLOAD

GROUP = ("customer_id", "transaction_date", "account_type", "transaction_category")
TRADE = ("ticker", "shares", "trade_price", "total_trade_value", "action")


def flatten_trades(raw: DataFrame) -> DataFrame:
    """One row per element of the payload's trades array.

    The payload is read once as a typed struct, so a bad field is NULL and does not
    stop the job.  Empty, missing and non-array trades give no rows.
    """
    return (
        raw.select(
            "transaction_date",
            "transaction_id",
            F.try_variant_get("transaction_payload", "$", PAYLOAD).alias("payload"),
        )
        .select(
            "transaction_date",
            "transaction_id",
            "payload.customer_id",
            "payload.account_type",
            F.explode("payload.trades").alias("trade"),
        )
        .select(
            "transaction_date",
            "transaction_id",
            "customer_id",
            "account_type",
            F.col("trade.action").alias("trade_action"),
            F.col("trade.ticker").alias("ticker"),
            to_int(F.col("trade.shares")).alias("shares"),
            F.col("trade.trade_price").alias("trade_price"),
            F.col("trade.total_trade_value").alias("total_trade_value"),
        )
    )


def payload_paths(raw: DataFrame, paths: Mapping[str, tuple[str, str]], payload: str = "transaction_payload") -> DataFrame:
    """Columns read from single paths of a payload: name -> (path, type), beside the other columns.

    A missing path, or a value of another shape, is NULL.  Stored payloads are shredded: Parquet files hold
    the fields that most values have as columns of their own, and a query that takes a payload apart only here reads
    no more of them than it names.
    """
    fields = [F.try_variant_get(payload, path, kind).alias(name) for name, (path, kind) in paths.items()]
    return raw.select(*(name for name in raw.columns if name != payload), *fields)


def build_payload(trades: DataFrame) -> DataFrame:
    """One payload per customer, day, account and category, holding all its trades.

    A payload is one JSON value by definition, so the trades of a group meet in one row.
    """
    return (
        trades.groupBy(*GROUP)
        .agg(F.array_sort(F.collect_list(F.struct(*TRADE))).alias("trades"))
        .select(
            "transaction_date",
            transaction_key(F.col("transaction_date"), F.col("customer_id")).alias("transaction_id"),
            F.to_variant_object(F.struct(*GROUP, "trades")).alias("transaction_payload"),
        )
    )
