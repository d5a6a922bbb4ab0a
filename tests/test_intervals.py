"""Histories over two feeds: intervals against whole snapshots, replays, change feeds, buckets, state store."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from holdfast.operators import merge_positions
from holdfast.plans import cash as C
from holdfast.plans import holdings as H
from holdfast.plans import intervals as I
from holdfast.session import move_files, shuffles_dropped
from holdfast.sources.files import write_table
from holdfast.streaming import (
    BatchSums,
    ChangeTable,
    change_feed,
    consume,
    history_step,
    holdings_history,
    part,
    positions_step,
    run_steps,
    stateful_sums,
    tagged_union,
    totals_table,
)
from holdfast.types import CASH_DEPOSITS, DAILY_CASH, POSITION_KEY, POSITIONS, TRADES_FLAT
from tests.test_streaming import NOW, deposits, drop, folders_read, trades

COLUMNS = [
    "snapshot_date", "customer_id", "account_type", "holding_type", "ticker", "quantity", "cost_basis", "average_cost_per_share",
    "market_price", "market_value", "unrealized_gain_loss", "unrealized_gain_loss_pct", "last_transaction_date",
]


def some_prices(spark):
    dice = random.Random(8)
    rows = [(ticker, dt.date(2024, 1, day), Decimal(dice.randrange(1, 900)) / 100) for ticker in "ABC" for day in range(2, 28) if dice.random() < 0.6]
    return spark.createDataFrame(rows, "ticker string, price_date date, close_price decimal(10,2)")


def some_batches(spark, count, seed=6):
    """(trades, deposits) per batch; days come late and again, and either feed may be silent."""
    dice = random.Random(seed)
    for n in range(count):
        traded = [
            (dice.randrange(4), dice.choice("ABCD"), dice.choice(["Buy", "Buy", "Sell"]), dice.randrange(1, 9), dice.randrange(1, 200), dice.randrange(1, 28))
            for _ in range(0 if n == 2 else 9)
        ]
        paid = [(dice.randrange(6), dice.randrange(1, 28), dice.randrange(-60, 90)) for _ in range(0 if n == 1 else 5)]
        yield trades(spark, *traded), deposits(spark, *paid)


def new_history(spark, root, buckets=4):
    cash = BatchSums(spark, f"{root}/daily", DAILY_CASH, C.DAILY_KEY, "daily_net_cash")
    return holdings_history(spark, f"{root}/holdings", cash, buckets)


def both_feeds(spark, root):
    return tagged_union(
        trades=change_feed(spark, f"{root}/trades", TRADES_FLAT), deposits=change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)
    )


def the_step(history, compact_every=50):
    return history_step(
        history,
        lambda batch: part(batch, "trades"),
        lambda batch: C.cash_detail(part(batch, "deposits"), part(batch, "trades")),
        NOW,
        compact_every,
    )


def read(history, prices, days=None):
    days = history.all_days() if days is None else days
    return I.holdings_on_days(days, history.intervals(), prices, history.cash.read())


def test_intervals_give_the_snapshots_that_each_batch_would_have_made(spark, tmp_path, rows):
    """Against the positions of each batch, crossed with its days, priced and stored whole."""
    root, prices = str(tmp_path), some_prices(spark)
    history, seen = new_history(spark, root), []
    state, versions, cash = spark.createDataFrame([], POSITIONS), {}, None
    for n, (traded, paid) in enumerate(some_batches(spark, 4)):
        drop(traded, f"{root}/trades")
        drop(paid, f"{root}/deposits")
        steps = run_steps(the_step(history, 2), lambda batch, batch_id: seen.append(batch_id))
        consume(both_feeds(spark, root), f"{root}/cp", steps).awaitTermination()
        detail = C.cash_detail(paid, traded)
        cash = detail if cash is None else cash.unionByName(detail)
        state = spark.createDataFrame(merge_positions(state, traded, NOW).collect(), POSITIONS)
        for (day,) in detail.select(F.col("transaction_date").cast("date")).distinct().collect():
            versions[day] = (n, state)
    assert seen == [0, 1, 2, 3]
    expected = []
    daily = C.daily_cash(cash)
    for version in range(4):
        days = [day for day, (last, _) in versions.items() if last == version]
        held = next(state for last, state in versions.values() if last == version)
        flows = daily.where(F.col("transaction_date").cast("date").isin(days))
        asked = spark.createDataFrame([(day,) for day in days], "snapshot_date date")
        expected += H.portfolio_snapshot(asked, held, prices, flows, date_cash=True).select(*COLUMNS).collect()
    found = read(history, prices).select(*COLUMNS)
    assert rows(found) == sorted(map(tuple, expected), key=repr)
    assert {row.holding_type for row in expected} == {"CASH", "SECURITY"}

    # Some days only, also the newest alone, and none.
    asked = history.all_days().where("day(snapshot_date) % 3 = 0")
    assert rows(read(history, prices, asked).select(*COLUMNS)) == sorted((tuple(r) for r in expected if r.snapshot_date.day % 3 == 0), key=repr)
    newest = max(versions)
    assert rows(read(history, prices, I.newest_day(history.all_days())).select(*COLUMNS)) == sorted(
        (tuple(r) for r in expected if r.snapshot_date == newest), key=repr
    )
    assert read(history, prices, asked.limit(0)).collect() == []


def test_stored_rows_grow_with_changes_not_with_days(spark, tmp_path):
    history = new_history(spark, str(tmp_path))
    step = the_step(history)
    kept = []
    for n in range(6):
        # One position trades in each batch; 20 others only in the first.
        found = [(1, "A", "Buy", 1, 10, 1 + n)] + [(c, "B", "Buy", 1, 10, 1) for c in range(20) if n == 0]
        tagged = tagged_union(trades=trades(spark, *found), deposits=deposits(spark, *((c, 1 + n, 5) for c in range(9))))
        step(tagged, n)
        kept.append(history.intervals().count())
    assert kept == [21, 22, 23, 24, 25, 26]
    one = history.intervals().where("ticker = 'A'").orderBy("valid_from").collect()
    assert [(r.valid_from, r.valid_to, int(r.current_shares)) for r in one] == [(n, n + 1 if n < 5 else None, n + 1) for n in range(6)]


def test_a_replayed_batch_leaves_the_history_as_it_is(spark, tmp_path, rows):
    root = str(tmp_path)
    once, again = new_history(spark, f"{root}/once"), new_history(spark, f"{root}/again")
    for n, (traded, paid) in enumerate(some_batches(spark, 4)):
        batch = tagged_union(trades=traded, deposits=paid)
        the_step(once, 2)(batch, n)
        for _ in range(2):
            the_step(again, 2)(batch, n)
    for table in (lambda h: h.intervals(), lambda h: h.all_days(), lambda h: h.cash.read()):
        assert rows(table(again)) == rows(table(once))


def test_a_union_takes_what_waits_in_all_feeds_as_one_batch(spark, tmp_path):
    root, seen = str(tmp_path), []
    (first, paid), (second, _) = list(some_batches(spark, 2))
    drop(first, f"{root}/trades")
    drop(paid, f"{root}/deposits")

    def step(batch, batch_id):
        seen.append((part(batch, "trades").count(), part(batch, "deposits").count()))
        assert part(batch, "deposits").columns == CASH_DEPOSITS.fieldNames()

    for more in (None, second):
        if more is not None:
            drop(more, f"{root}/trades")
        consume(both_feeds(spark, root), f"{root}/cp", step).awaitTermination()
    assert seen == [(9, 5), (9, 0)]


def actions(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns, "metadata_action", "metadata_image").collect()), key=repr)


@pytest.mark.parametrize("compact_every", [50, 1])
def test_changes_of_a_table_between_two_versions(spark, tmp_path, compact_every):
    held = ChangeTable(spark, str(tmp_path / "held"), POSITIONS, POSITION_KEY, 4)
    step = positions_step(held, NOW, compact_every)
    step(trades(spark, (1, "A", "Buy", 10, 100, 1), (1, "B", "Buy", 5, 50, 1), (2, "A", "Buy", 1, 9, 1)), 0)
    step(trades(spark, (1, "A", "Buy", 2, 30, 2), (1, "B", "Sell", 5, 1, 2), (3, "C", "Buy", 4, 8, 2)), 1)
    step(trades(spark, (3, "C", "Sell", 4, 1, 3), (1, "B", "Buy", 1, 1, 3)), 2)
    key = ("customer_id", "ticker", F.col("current_shares").cast("int"))
    assert actions(held.changes(-1, 0), *key) == [(1, "A", 10, "INSERT", "after"), (1, "B", 5, "INSERT", "after"), (2, "A", 1, "INSERT", "after")]
    assert actions(held.changes(0, 1), *key) == [
        (1, "A", 10, "UPDATE", "before"), (1, "A", 12, "UPDATE", "after"), (1, "B", 5, "DELETE", "before"), (3, "C", 4, "INSERT", "after"),
    ]
    # Two batches at once: what came and went between them is no change, what went and came back is one.
    assert actions(held.changes(0), *key) == [
        (1, "A", 10, "UPDATE", "before"), (1, "A", 12, "UPDATE", "after"), (1, "B", 1, "UPDATE", "after"), (1, "B", 5, "UPDATE", "before"),
    ]
    assert actions(held.changes(2), *key) == []


def test_changes_of_sums(spark, tmp_path):
    sums = BatchSums(spark, str(tmp_path / "daily"), DAILY_CASH, C.DAILY_KEY, "daily_net_cash")
    sums.add(C.daily_cash(C.deposit_cash(deposits(spark, (1, 1, 5), (2, 1, 3)))), 0)
    sums.compact(0)
    sums.add(C.daily_cash(C.deposit_cash(deposits(spark, (1, 1, 2), (3, 1, 4), (2, 1, 0)))), 1)
    value = ("customer_id", F.col("daily_net_cash").cast("int"))
    assert actions(sums.changes({}, {"feed": 0}), *value) == [(1, 5, "INSERT", "after"), (2, 3, "INSERT", "after")]
    assert actions(sums.changes({"feed": 0}), *value) == [(1, 5, "UPDATE", "before"), (1, 7, "UPDATE", "after"), (3, 4, "INSERT", "after")]
    assert sums.changes(sums.versions()).collect() == []
    assert sums.read({"feed": 0}).count() == 2


def test_a_batch_of_one_key_opens_one_bucket(spark, tmp_path):
    held = ChangeTable(spark, str(tmp_path / "held"), POSITIONS, POSITION_KEY, 8)
    step = positions_step(held, NOW, compact_every=2)
    step(trades(spark, *((c, "A", "Buy", 1, 1, 1) for c in range(200))), 0)
    step(trades(spark, *((c, "A", "Buy", 1, 1, 1) for c in range(200))), 1)
    one = trades(spark, (7, "A", "Buy", 1, 1, 1))
    (bucket,) = held.buckets_of(one)
    found = held.read(only=one)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line and "batch_id" in line]
    assert filters and all(f"bucket" in line.split("PartitionFilters: ")[1].split("]")[0] and str(bucket) in line for line in filters)
    assert found.first().current_shares == 2
    # Compaction writes only the buckets that changed since the last copy; reads take the newest copy of each.
    step(one, 2)
    step(one, 3)
    copies = tmp_path / "held" / "copies" / "source=feed"
    assert [p.name for p in (copies / "batch_id=3").iterdir() if p.is_dir()] == [f"bucket={bucket}"]
    assert len([p for p in (copies / "batch_id=1").iterdir() if p.is_dir()]) == 8
    shares = {row.customer_id: int(row.current_shares) for row in held.read().collect()}
    assert shares == {c: 4 if c == 7 else 2 for c in range(200)}
    assert len(folders_read(held.read())) == 2


def test_totals_do_not_age(spark, tmp_path):
    totals = totals_table(spark, str(tmp_path / "totals"))
    for n in range(20):
        row = (dt.date(2024, 1, 1 + n % 5), "IRA", "A", n, Decimal(1), Decimal(1), Decimal(1), Decimal(0), n)
        totals.add(spark.createDataFrame([row], totals.schema), n)
        if n % 4 == 3:
            totals.compact(n)
        assert len(folders_read(totals.read())) <= 4
        days = {row.snapshot_date.day: row.positions for row in totals.read().collect()}
        assert days == {1 + k % 5: k for k in range(max(0, n - 4), n + 1)}


def test_sums_in_the_state_store_survive_a_restart(spark, tmp_path, rows):
    root = str(tmp_path)
    target = ChangeTable(spark, f"{root}/daily", DAILY_CASH, C.DAILY_KEY, 4)
    everything = []
    for found in ([(1, 1, 5), (2, 1, 3), (1, 1, 4)], [(1, 1, 2), (3, 2, 4)], []):
        everything += found
        drop(deposits(spark, *found), f"{root}/deposits")
        moved = C.deposit_cash(change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)).select(*C.DAILY_KEY, "amount")
        stateful_sums(moved, C.DAILY_KEY, "amount", target, f"{root}/cp").awaitTermination()
    columns = DAILY_CASH.fieldNames()
    assert rows(target.read(), *columns) == rows(C.daily_cash(C.deposit_cash(deposits(spark, *everything))), *columns)
    # The second run wrote only the keys that it touched.
    assert target.changes(0, 1).where("metadata_image = 'after'").count() == 2


def test_states_are_hashed_and_those_of_one_batch_not_even_shuffled(spark, tmp_path):
    held = ChangeTable(spark, str(tmp_path / "held"), POSITIONS, POSITION_KEY, 4)
    step = positions_step(held, NOW)
    step(trades(spark, (1, "A", "Buy", 10, 100, 1), (None, "B", "Buy", 5, 50, 1)), 0)
    one = held.read()
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    assert {(row.customer_id, int(row.current_shares)) for row in one.collect()} == {(1, 10), (None, 5)}
    step(trades(spark, (1, "A", "Sell", 10, 1, 2), (2, "A", "Buy", 1, 9, 2)), 1)
    two = held.read()
    text = two._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "HashAggregate" in text
    assert {(row.customer_id, int(row.current_shares)) for row in two.collect()} == {(None, 5), (2, 1)}


def odd_intervals(spark, history):
    """The intervals of a history, and some with parts of shares, many shares, no cost and no account."""
    day = dt.date(2024, 1, 3)
    odd = [
        (50, "IRA", "A", Decimal("2.5"), Decimal("-7.01"), None, day, day, NOW, 0, None),
        (50, "IRA", "B", Decimal(10**8 + 1), Decimal("999999.99"), None, day, None, NOW, 0, 1),
        (51, None, "A", Decimal(7), None, None, day, day, NOW, 0, 2),
        (51, "Odd", "C", Decimal("0.0001"), Decimal(1), None, day, day, NOW, 1, None),
        (52, "Odd", "C", Decimal(0), Decimal(1), None, day, day, NOW, 1, None),
        (1, "IRA", None, Decimal(3), Decimal(1), None, day, day, NOW, 0, None),
    ]
    return history.intervals().unionByName(spark.createDataFrame(odd, I.INTERVALS))


def test_totals_of_days_are_the_sums_of_their_rows(spark, tmp_path, rows):
    history, prices = new_history(spark, str(tmp_path)), some_prices(spark)
    for n, (traded, paid) in enumerate(some_batches(spark, 3)):
        the_step(history)(tagged_union(trades=traded, deposits=paid), n)
    intervals, cash, days = odd_intervals(spark, history), history.cash.read(), history.all_days()
    key, sums = ("snapshot_date", "account_type", "holding_type"), ("quantity", "cost_basis", "market_value")
    expected = I.holdings_on_days(days, intervals, prices, cash).groupBy(*key).agg(
        F.count("*").alias("rows"), *(F.sum(name).alias(name) for name in sums), F.max("last_transaction_date").alias("last_transaction_date")
    )
    shown = I.holdings_on_days(days, intervals, prices, cash, units=True)
    found = I.totals_of_days(shown, I.account_types(intervals, cash))
    assert found.dtypes == expected.dtypes
    assert rows(found) == rows(expected)
    assert {row.account_type for row in found.collect()} > {None, "Odd"}
    # With `units` the rows are the same.
    assert rows(shown.select(*COLUMNS)) == rows(I.holdings_on_days(days, intervals, prices, cash).select(*COLUMNS))
    assert I.totals_of_days(I.holdings_on_days(days.limit(0), intervals, prices, cash, units=True), I.account_types(intervals, cash)).collect() == []


def test_sums_of_units_are_exact(spark):
    values = [2**63 - 1, 2**63 - 1, -5, None, -(2**40)]
    units = spark.createDataFrame([(1, value) for value in values] + [(2, None)], "k int, units bigint")
    found = {row.k: row.total for row in units.groupBy("k").agg(I.exact_sum("units", POSITIONS["current_shares"].dataType).alias("total")).collect()}
    assert found == {1: Decimal(2 * (2**63 - 1) - 5 - 2**40).scaleb(-4), 2: None}


def test_rows_of_days_are_summed_by_the_stage_that_makes_them(spark, tmp_path):
    """Nothing stands between the expansion over the days and the first sums, and no decimal is summed there."""
    history, prices = new_history(spark, str(tmp_path)), some_prices(spark)
    for n, (traded, paid) in enumerate(some_batches(spark, 2)):
        the_step(history)(tagged_union(trades=traded, deposits=paid), n)
    cash = history.cash.read()
    shown = I.holdings_on_days(history.all_days(), history.intervals(), prices, cash, units=True)
    found = I.totals_of_days(shown, I.account_types(history.intervals(), cash))
    # Of a node with subqueries, these stand before its child and begin with a colon.
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    spine = [line.lstrip()[3:] for line in lines if line.lstrip().startswith("+- ")]
    partial = next(place for place, node in enumerate(spine) if node.startswith("HashAggregate") and "partial_sum" in node)
    assert [node.split(" ")[0] for node in spine[partial + 1 : partial + 3]] == ["Project", "Generate"]
    assert "sequence(" in spine[partial + 2]
    assert "decimal" not in spine[partial].lower() and "account_type" not in spine[partial]


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(place).getName() for place in range(found.size()) if found.apply(place).getName().startswith("shuffle_")}


def test_shuffles_go_with_the_write_that_made_them(spark, tmp_path, rows):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name, None)
    sums = spark.range(2000).selectExpr("id % 700 AS customer_id", "id AS n").groupBy("customer_id").agg(F.sum("n").alias("n"))
    stored = write_table(sums, str(tmp_path / "sums"))
    held = ChangeTable(spark, str(tmp_path / "held"), POSITIONS, POSITION_KEY, 4)
    step = positions_step(held, NOW)
    for day in (1, 2):
        step(trades(spark, *((c, "A", "Buy", 1, 1, day) for c in range(50))), day)
    # Only the look for buckets, which is no write, may have left some.
    left = {file for file in shuffle_files(spark) - before if file.endswith(".data")}
    assert stored.count() == 700 and {int(row.current_shares) for row in held.read().collect()} == {2}
    assert len({file.split("_")[1] for file in left}) <= 1
    with shuffles_dropped(spark), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == setting


def test_first_changes_are_read_without_a_join(spark, tmp_path):
    history = new_history(spark, str(tmp_path))
    (traded, paid), *_ = some_batches(spark, 1)
    the_step(history)(tagged_union(trades=traded, deposits=paid), 0)
    for changed in (history.positions.changes(-1, 0), history.cash.changes({"feed": -1}, {"feed": 0})):
        assert "Join" not in changed._jdf.queryExecution().optimizedPlan().toString()
        assert {row.metadata_action for row in changed.collect()} == {"INSERT"}


def test_a_batch_is_not_copied_to_disk_and_few_buckets_are_not_shuffled(spark, tmp_path, rows):
    levels = []
    run_steps(lambda batch, batch_id: levels.append(batch.storageLevel))(spark.range(3), 0)
    assert [(level.useMemory, level.useDisk) for level in levels] == [(True, False)]
    few, many = (ChangeTable(spark, str(tmp_path / name), POSITIONS, POSITION_KEY, count) for name, count in (("few", 4), ("many", 64)))
    assert few._changes().few and not many._changes().few
    traded = trades(spark, *((c, "A", "Buy", 1 + c, 10, 1) for c in range(90)))
    for table in (few, many):
        positions_step(table, NOW, compact_every=1)(traded, 0)
    assert rows(few.read()) == rows(many.read()) and few.read().count() == 90
    assert len(list((tmp_path / "few" / "changes" / "source=feed" / "batch_id=0").glob("bucket=*"))) == 4


def test_files_land_by_being_moved(spark, tmp_path, rows):
    for number in (0, 1):
        spark.range(number, number + 1).write.parquet(str(tmp_path / f"drop={number}"))
        move_files(spark, str(tmp_path / f"drop={number}"), str(tmp_path / "landed"), f"drop{number}-")
        assert rows(spark.read.parquet(str(tmp_path / "landed"))) == [(n,) for n in range(number + 1)]
    move_files(spark, str(tmp_path / "missing"), str(tmp_path / "empty"), "")
    assert list((tmp_path / "empty").iterdir()) == []
