"""Positions: the cost basis rules, against a plain replay."""

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from holdfast.operators import changed_positions, merge_positions
from holdfast.plans.trades import enrich_trades
from holdfast.types import POSITION_KEY, POSITIONS

TRADE = (
    "customer_id bigint, account_type string, ticker string, trade_action string, shares int, "
    "total_trade_value decimal(10,2), transaction_date date"
)
NOW = dt.datetime(2024, 1, 1)
D1, D2, D3 = (dt.date(2024, 1, day) for day in (1, 2, 3))


def batch(spark, *trades):
    return enrich_trades(
        spark.createDataFrame(
            [(1, "IRA", ticker, action, shares, Decimal(value), day)
             for ticker, action, shares, value, day in trades],
            TRADE,
        )
    )


def after(spark, *batches):
    state = spark.createDataFrame([], POSITIONS)
    for trades in batches:
        state = merge_positions(state, batch(spark, *trades), NOW)
    return {
        row.ticker: (int(row.current_shares), str(row.total_cost_basis), str(row.average_cost_per_share))
        for row in state.collect()
    }


BUY10 = ("A", "Buy", 10, "100", D1)


@pytest.mark.parametrize(
    ("second", "expected"),
    [
        ([("A", "Buy", 5, "80", D2)], {"A": (15, "180.00", "12.0000")}),
        # A sale in the same batch does not lower the basis while the net is positive.
        ([("A", "Buy", 5, "80", D2), ("A", "Sell", 3, "40", D2)], {"A": (12, "180.00", "15.0000")}),
        ([("A", "Sell", 4, "50", D2)], {"A": (6, "60.00", "10.0000")}),
        # With a negative net the purchases are not added.
        ([("A", "Sell", 4, "50", D2), ("A", "Buy", 1, "9", D2)], {"A": (7, "60.00", "8.5714")}),
        ([("A", "Sell", 10, "50", D2)], {}),
        ([("A", "Sell", 11, "50", D2)], {}),
        ([("A", "Sell", 2, "50", D2), ("A", "Buy", 2, "9", D2)], {"A": (10, "100.00", "10.0000")}),
        ([("B", "Sell", 2, "50", D2)], {"A": (10, "100.00", "10.0000")}),
        ([("B", "Buy", 3, "10", D2), ("B", "Sell", 1, "9", D2)],
         {"A": (10, "100.00", "10.0000"), "B": (2, "10.00", "5.0000")}),
        # An action that is neither counts as a sale of shares, but not as shares sold.
        ([("A", "Transfer", 4, "50", D2)], {"A": (6, "100.00", "16.6667")}),
    ],
)
def test_second_batch(spark, second, expected):
    assert after(spark, [BUY10], second) == expected


def test_ratio_keeps_six_digits(spark):
    got = after(spark, [("A", "Buy", 3, "9000000", D1)], [("A", "Sell", 1, "1", D2)])
    assert got == {"A": (2, "6000003.00", "3000001.5000")}


def test_dates_and_stamps(spark):
    state = merge_positions(spark.createDataFrame([], POSITIONS), batch(spark, BUY10), NOW)
    later = dt.datetime(2025, 1, 1)
    row = merge_positions(state, batch(spark, ("A", "Buy", 1, "1", D3)), later).first()
    assert (row.first_trade_date, row.last_trade_date) == (D1, D3)
    assert row.last_updated == dt.datetime(2025, 1, 1)
    untouched = merge_positions(state, batch(spark, ("B", "Buy", 1, "1", D3)), later)
    assert untouched.where("ticker = 'A'").first().last_updated == dt.datetime(2024, 1, 1)


def test_hugely_oversold_position_is_dropped(spark):
    second = [("A", "Sell", 2_000_000_000, "1", D2)] * 3
    assert after(spark, [("A", "Buy", 1, "99999999", D1)], second) == {}


def test_changed_positions_name_deletions(spark, rows):
    state = merge_positions(
        spark.createDataFrame([], POSITIONS), batch(spark, BUY10, ("C", "Buy", 1, "5", D1)), NOW
    )
    second = batch(spark, ("A", "Sell", 10, "1", D2), ("B", "Buy", 2, "8", D2), ("X", "Sell", 1, "1", D2))
    got = rows(changed_positions(state, second, NOW), "ticker", "current_shares", "deleted")
    assert got == [("A", Decimal("0.0000"), True), ("B", Decimal("2.0000"), False)]


def replay(batches):
    """The rules, one key at a time."""
    def to(value, digits):
        return value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)

    state = {}
    for trades in batches:
        per_key = defaultdict(list)
        for trade in trades:
            per_key[trade[:3]].append(trade[3:])
        for key, done in per_key.items():
            net = sum(n if action == "Buy" else -n for action, n, _, _ in done)
            bought = sum((value for action, _, value, _ in done if action == "Buy"), Decimal(0))
            sold = sum(n for action, n, _, _ in done if action == "Sell")
            held, basis = state.get(key, (0, None))
            if basis is None:
                new = bought
            elif net > 0:
                new = basis + bought
            elif net < 0 and held > 0:
                new = basis * (1 - to(Decimal(sold) / held, 6))
            else:
                new = basis
            if held + net > 0:
                state[key] = (held + net, to(new, 2))
            else:
                state.pop(key, None)
    return state


@pytest.mark.parametrize("seed", range(3))
def test_random_batches_match_a_replay(spark, seed):
    rng = random.Random(seed)
    batches = [
        [
            (rng.randrange(4), rng.choice(["IRA", "401k"]), rng.choice("AB"),
             rng.choice(["Buy", "Buy", "Sell"]), rng.randrange(1, 30),
             Decimal(rng.randrange(100, 99999)) / 100, D1)
            for _ in range(25)
        ]
        for _ in range(3)
    ]
    state = spark.createDataFrame([], POSITIONS)
    for trades in batches:
        state = merge_positions(state, enrich_trades(spark.createDataFrame(trades, TRADE)), NOW)
    got = {
        tuple(row[name] for name in POSITION_KEY): (int(row.current_shares), row.total_cost_basis)
        for row in state.collect()
    }
    assert got == replay(batches)
