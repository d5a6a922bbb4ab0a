"""Micro-batches against batch results, restarts and replays."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest

from holdfast.operators import merge_positions
from holdfast.plans import cash as C
from holdfast.plans import holdings as H
from holdfast.plans.trades import enrich_trades
from holdfast.streaming import (
    BatchFolders,
    BatchSums,
    ChangeTable,
    auto_ingest,
    change_feed,
    consume,
    csv_feed,
    daily_cash_step,
    has_data,
    newest_totals,
    positions_step,
    run_steps,
    snapshot_step,
    totals_step,
    totals_table,
    with_change_metadata,
)
from holdfast.types import CASH_DEPOSITS, DAILY_CASH, POSITION_KEY, POSITIONS, TRADES_FLAT

NOW = dt.datetime(2024, 1, 1)


def deposits(spark, *found):
    return spark.createDataFrame(
        [(f"d{n}", customer, dt.datetime(2024, 1, day), "CASH", Decimal(amount), "IRA", "Cash Deposit")
         for n, (customer, day, amount) in enumerate(found)],
        CASH_DEPOSITS,
    )


def trades(spark, *found):
    flat = spark.createDataFrame(
        [(dt.date(2024, 1, day), "t", customer, "IRA", action, ticker, shares, Decimal(1), Decimal(value))
         for customer, ticker, action, shares, value, day in found],
        "transaction_date date, transaction_id string, customer_id bigint, account_type string, "
        "trade_action string, ticker string, shares int, trade_price decimal(10,2), "
        "total_trade_value decimal(10,2)",
    )
    return enrich_trades(flat).select(*TRADES_FLAT.fieldNames())


def drop(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_daily_cash_in_batches_equals_batch(spark, tmp_path, rows):
    rng = random.Random(1)
    root = str(tmp_path)
    target = BatchSums(spark, f"{root}/daily", DAILY_CASH, C.DAILY_KEY, "daily_net_cash")
    everything, batches = [], []

    def run():
        feed = change_feed(spark, f"{root}/deposits", CASH_DEPOSITS, files_per_batch=1)
        steps = run_steps(
            daily_cash_step(target, "deposits", C.deposit_cash),
            lambda batch, batch_id: batches.append(batch_id),
        )
        consume(feed, f"{root}/cp", steps).awaitTermination()

    for _ in range(4):
        found = [(rng.randrange(3), rng.randrange(1, 4), rng.randrange(-50, 50)) for _ in range(10)]
        everything += found
        drop(deposits(spark, *found), f"{root}/deposits")
        if rng.random() < 0.6:
            run()
    run()
    columns = DAILY_CASH.fieldNames()
    expected = rows(C.daily_cash(C.deposit_cash(deposits(spark, *everything))), *columns)
    assert rows(target.read(), *columns) == expected

    # A restart with nothing new starts no batch and changes nothing.
    assert batches == [0, 1, 2, 3]
    run()
    assert batches == [0, 1, 2, 3]
    assert rows(target.read(), *columns) == expected


def test_replayed_batch_replaces_itself(spark, tmp_path):
    target = BatchSums(spark, str(tmp_path / "daily"), DAILY_CASH, C.DAILY_KEY, "daily_net_cash")
    step = daily_cash_step(target, "deposits", C.deposit_cash)
    for _ in range(2):
        step(deposits(spark, (1, 1, 5)), 0)
    step(deposits(spark, (1, 1, 7)), 1)
    assert [row.daily_net_cash for row in target.read().collect()] == [Decimal("12.00")]


BATCHES = [
    [(1, "A", "Buy", 10, 100, 1), (1, "B", "Buy", 5, 50, 1), (2, "A", "Buy", 1, 9, 1)],
    [(1, "A", "Sell", 4, 1, 2), (1, "B", "Sell", 5, 1, 2), (3, "C", "Sell", 5, 1, 2)],
    [(1, "B", "Buy", 2, 30, 3), (2, "A", "Sell", 1, 1, 3)],
]


@pytest.mark.parametrize("compact_every", [1, 2, 50])
def test_position_changes_equal_whole_merges(spark, tmp_path, rows, compact_every):
    target = ChangeTable(spark, str(tmp_path / "positions"), POSITIONS, POSITION_KEY, 4)
    step = positions_step(target, NOW, compact_every)
    state = spark.createDataFrame([], POSITIONS)
    for batch_id, found in enumerate(BATCHES):
        step(trades(spark, *found), batch_id)
        step(trades(spark, *found), batch_id)
        state = merge_positions(state, trades(spark, *found), NOW)
        assert rows(target.read()) == rows(state)
    assert rows(target.read(before=0)) == []


def test_consumers_do_not_take_rows_from_each_other(spark, tmp_path):
    root, seen = str(tmp_path), {"a": 0, "b": 0}

    def run(name):
        def step(batch, batch_id):
            seen[name] += batch.count()

        consume(
            change_feed(spark, f"{root}/deposits", CASH_DEPOSITS), f"{root}/cp_{name}", step
        ).awaitTermination()

    drop(deposits(spark, (1, 1, 1)), f"{root}/deposits")
    run("a")
    drop(deposits(spark, (1, 1, 1), (2, 1, 1)), f"{root}/deposits")
    run("a")
    run("b")
    assert seen == {"a": 3, "b": 3}


def test_files_are_ingested_once(spark, tmp_path):
    landing, sink = tmp_path / "landing", str(tmp_path / "sink")
    for day in (1, 2):
        folder = landing / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text(f'"d{day}","1","2024-01-0{day}","CASH","5.25","IRA","Cash"\n')
        for _ in range(2):
            auto_ingest(
                csv_feed(spark, str(landing), CASH_DEPOSITS), sink, str(tmp_path / "cp")
            ).awaitTermination()
    got = [(row.deposit_id, row.transaction_date.day, row.deposit_amount)
           for row in spark.read.parquet(sink).orderBy("deposit_id").collect()]
    assert got == [("d1", 1, Decimal("5.25")), ("d2", 2, Decimal("5.25"))]


def test_row_ids_tell_equal_rows_apart_and_survive_a_replay(spark, tmp_path):
    root = str(tmp_path)
    drop(deposits(spark, (1, 1, 1)).union(deposits(spark, (1, 1, 1))), f"{root}/deposits")

    def ids(attempt):
        feed = with_change_metadata(
            change_feed(spark, f"{root}/deposits", CASH_DEPOSITS), ["deposit_id"]
        )
        auto_ingest(feed, f"{root}/out{attempt}", f"{root}/cp{attempt}").awaitTermination()
        return {row.metadata_row_id for row in spark.read.parquet(f"{root}/out{attempt}").collect()}

    assert len(ids(1)) == 2
    assert ids(1) == ids(2)


def test_snapshots_follow_positions(spark, tmp_path, rows):
    root = str(tmp_path)
    positions = ChangeTable(spark, f"{root}/positions", POSITIONS, POSITION_KEY)
    daily = BatchSums(spark, f"{root}/daily", DAILY_CASH, C.DAILY_KEY, "daily_net_cash")
    prices = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), Decimal(3)), ("A", dt.date(2024, 1, 2), Decimal(4))],
        "ticker string, price_date date, close_price decimal(10,2)",
    )
    steps = run_steps(
        daily_cash_step(daily, "trades", C.trade_cash),
        positions_step(positions, NOW),
        snapshot_step(f"{root}/history", positions, daily, prices, NOW),
    )
    for found in ([(1, "A", "Buy", 10, 100, 1)], [(1, "A", "Buy", 2, 30, 2), (9, "Z", "Sell", 1, 7, 2)]):
        drop(trades(spark, *found), f"{root}/trades")
        consume(
            change_feed(spark, f"{root}/trades", TRADES_FLAT), f"{root}/cp", steps
        ).awaitTermination()
    history = spark.read.parquet(f"{root}/history")
    got = rows(history, "snapshot_date", "customer_id", "ticker", "quantity", "market_value")
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert got == sorted(
        [
            (first, 1, "A", Decimal("10.0000"), Decimal("30.00")),
            (second, 1, "A", Decimal("12.0000"), Decimal("48.00")),
            (second, 9, "CASH", Decimal("7.0000"), Decimal("7.00")),
        ],
        key=repr,
    )
    current = H.current_holdings(history, daily.read(), NOW)
    assert rows(current, "customer_id", "ticker", "quantity") == [
        (1, "A", Decimal("12.0000")), (9, "CASH", Decimal("7.0000")),
    ]


def folders_read(df):
    """Batch folders, whatever lies below them."""
    return {re.search(r"^(.*batch_id=\d+)", path)[1] for path in df.inputFiles()}


def test_tables_do_not_age(spark, tmp_path):
    sums = BatchSums(spark, str(tmp_path / "daily"), DAILY_CASH, C.DAILY_KEY, "daily_net_cash")
    held = ChangeTable(spark, str(tmp_path / "positions"), POSITIONS, POSITION_KEY, 4)
    cash_step = daily_cash_step(sums, "deposits", C.deposit_cash, compact_every=4)
    trade_step = positions_step(held, NOW, compact_every=4)
    for batch_id in range(20):
        for _ in range(2 if batch_id % 7 == 3 else 1):  # some batches are replayed, with their copies
            cash_step(deposits(spark, (1, 1, 5), (2, 1, 1)), batch_id)
            trade_step(trades(spark, (1, "A", "Buy", 1, 10, 1)), batch_id)
        assert len(folders_read(sums.read())) <= 4
        assert len(folders_read(held.read())) <= 4
        assert sums.read().where("customer_id = 1").first().daily_net_cash == 5 * (batch_id + 1)
        assert held.read().first().current_shares == batch_id + 1


def test_unfinished_batches_are_not_read(spark, tmp_path):
    folders = BatchFolders(spark, str(tmp_path / "t"), DAILY_CASH)
    assert folders.read().count() == 0
    folders.write(C.daily_cash(C.deposit_cash(deposits(spark, (1, 1, 5)))), 0)
    (tmp_path / "t" / "source=feed" / "batch_id=1").mkdir()
    assert folders.batches() == [0] and folders.read().count() == 1


def test_gate_takes_nothing(spark, tmp_path):
    root, seen = str(tmp_path), []
    drop(deposits(spark, (1, 1, 1)), f"{root}/deposits")
    feed = change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)

    def run():
        consume(feed, f"{root}/cp", lambda batch, batch_id: seen.append(batch.count())).awaitTermination()

    assert has_data(feed, f"{root}/cp") and has_data(feed, f"{root}/cp")
    run()
    assert not has_data(feed, f"{root}/cp")
    drop(deposits(spark, (1, 1, 1), (2, 1, 1)), f"{root}/deposits")
    assert has_data(feed, f"{root}/cp")
    run()
    assert seen == [1, 2]


def test_all_waiting_files_are_one_batch(spark, tmp_path):
    root, seen = str(tmp_path), []
    for _ in range(12):
        drop(deposits(spark, (1, 1, 1)), f"{root}/deposits")
    for name, limit in (("all", None), ("few", 5)):
        feed = change_feed(spark, f"{root}/deposits", CASH_DEPOSITS, limit)
        consume(feed, f"{root}/{name}", lambda batch, batch_id: seen.append(batch.count())).awaitTermination()
    assert seen == [12, 5, 5, 2]


def test_totals_of_touched_days_follow_positions(spark, tmp_path, rows):
    root = str(tmp_path)
    held = ChangeTable(spark, f"{root}/positions", POSITIONS, POSITION_KEY)
    history = totals_table(spark, f"{root}/totals")
    prices = spark.createDataFrame([("A", dt.date(2024, 1, 1), Decimal(3))], "ticker string, price_date date, close_price decimal(10,2)")
    steps = run_steps(positions_step(held, NOW), totals_step(history, held, prices))
    steps(trades(spark, (1, "A", "Buy", 10, 100, 1), (2, "A", "Buy", 1, 9, 2)), 0)
    for _ in range(2):
        steps(trades(spark, (1, "A", "Buy", 5, 50, 2), (1, "B", "Buy", 1, 4, 2)), 1)
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert rows(newest_totals(history), "snapshot_date", "ticker", "positions", "shares", "market_value", "unrealized_gain_loss") == [
        (first, "A", 2, Decimal("11.0000"), Decimal("33.00"), Decimal("-76.00")),
        (second, "A", 2, Decimal("16.0000"), Decimal("48.00"), Decimal("-111.00")),
        (second, "B", 1, Decimal("1.0000"), Decimal("0.00"), Decimal("-4.00")),
    ]
