"""What happens to a micro-batch."""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import changed_positions
from ..plans.cash import daily_cash
from ..plans.holdings import portfolio_snapshot, snapshot_totals, write_snapshot
from ..plans.intervals import INTERVALS, closed_intervals
from ..sources.unload import unload_by_date, unloaded_days
from ..types import LEDGER, POSITION_KEY, POSITIONS, SNAPSHOT_TOTALS
from .tables import BatchLog, BatchSums, ChangeTable, NewestPerKey

Step = Callable[[DataFrame, int], None]
SPILLING = StorageLevel.MEMORY_AND_DISK
VERSION = T.StructField("version", T.LongType())


def run_steps(*steps: Step) -> Step:
    """Several steps on one batch, in order, over one cached copy of it.

    What memory does not hold of the copy is read from the feed's files again, as these are smaller than a copy on disk.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_ONLY)
        try:
            for step in steps:
                step(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def part_step(name: str, step: Step) -> Step:
    """A step on one feed's rows of a batch made by `tagged_union`."""
    return lambda batch, batch_id: step(part(batch, name), batch_id)


def part(batch: DataFrame, name: str) -> DataFrame:
    """The rows that one feed gave to a batch made by `tagged_union`."""
    return batch.where(F.col("feed") == name).select(f"{name}.*")


def daily_cash_step(
    target: BatchSums, source: str, as_cash: Callable[[DataFrame], DataFrame], compact_every: int = 50
) -> Step:
    """Add a batch to the daily sums, after `as_cash` has made cash movements of it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        target.add(daily_cash(as_cash(batch)), batch_id, source)
        if (batch_id + 1) % compact_every == 0:
            target.compact(batch_id, source)

    return run


def positions_step(target: ChangeTable, as_of: dt.datetime, compact_every: int = 50) -> Step:
    """Merge a batch of trades into the positions, with a copy of the changed buckets now and then."""

    def run(batch: DataFrame, batch_id: int) -> None:
        held = target.read(before=batch_id, only=batch)
        target.apply(changed_positions(held, batch, as_of), batch_id)
        if (batch_id + 1) % compact_every == 0:
            target.compact(batch_id)

    return run


def touched_dates(batch: DataFrame) -> DataFrame:
    """Days a batch of cash or trades bears on."""
    return batch.select(F.col("transaction_date").cast("date").alias("snapshot_date")).distinct()


def snapshot_step(
    history: str,
    positions: ChangeTable,
    cash: BatchSums,
    prices: DataFrame,
    as_of: dt.datetime,
    dates: Callable[[DataFrame], DataFrame] = touched_dates,
) -> Step:
    """Snapshot the days of a batch, or those that `dates` picks; goes after the step that updates the positions.

    Only the cash of these days takes part, and cash without a position is kept under its day, so
    a stored day is whole and is replaced as a whole.  One query at a time may write a history.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        # Both are read several times over, and each read adds up batches.
        held, days = positions.read().persist(SPILLING), dates(batch).persist(SPILLING)
        on_days = F.col("transaction_date").cast("date") == F.col("d.snapshot_date")
        flows = cash.read().join(days.alias("d"), on_days, "left_semi").persist(SPILLING)
        try:
            write_snapshot(portfolio_snapshot(days, held, prices, flows, date_cash=True), history, as_of)
        finally:
            for frame in (held, days, flows):
                frame.unpersist()

    return run


def totals_table(spark: SparkSession, path: str) -> NewestPerKey:
    """Totals of days; of each day those of the last batch that bore on it."""
    return NewestPerKey(spark, path, T.StructType([*SNAPSHOT_TOTALS.fields, VERSION]), ("snapshot_date",))


def totals_step(
    history: NewestPerKey, positions: ChangeTable, prices: DataFrame, source: str = "feed", compact_every: int = 50
) -> Step:
    """Totals of every day of a batch; goes after the step that updates the positions."""

    def run(batch: DataFrame, batch_id: int) -> None:
        totals = snapshot_totals(touched_dates(batch), positions.read(), prices)
        history.add(totals.withColumn("version", F.lit(batch_id).cast("bigint")), batch_id, source)
        if (batch_id + 1) % compact_every == 0:
            history.compact(batch_id, source)

    return run


def newest_totals(history: NewestPerKey) -> DataFrame:
    """Of every day the totals of the last batch that bore on it."""
    return history.read().drop("version")


@dataclass(frozen=True)
class UnloadLedger(BatchLog):
    """Days with the rows unloaded so far, kept by batch; a day that comes again adds to its rows."""

    def folded(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("transaction_date").agg(
            F.sum("records").alias("records"), F.max("unload_status").alias("unload_status"), F.max("unload_time").alias("unload_time")
        )


def unload_ledger(spark: SparkSession, path: str) -> UnloadLedger:
    return UnloadLedger(spark, path, T.StructType([*LEDGER.fields, T.StructField("records", T.LongType())]))


def unload_step(path: str, ledger: UnloadLedger, at: dt.datetime, compact_every: int = 50) -> Step:
    """Unload the days of a batch and enter them in the ledger.

    Files first: a batch that fails in between is replayed, overwrites its own folders of its days and
    then makes its entry, so neither rows nor entries come twice and no entry stands without its files.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        unload_by_date(batch, path, batch_id=batch_id)
        ledger.add(unloaded_days(batch, at), batch_id)
        if (batch_id + 1) % compact_every == 0:
            ledger.compact(batch_id)

    return run


@dataclass(frozen=True)
class HoldingsHistory:
    """All that the holdings of any day are made of, kept by one query over all feeds.

    A batch is a version.  `positions` holds what is open, with the version it holds from, `closed` the
    intervals that ended, `days` the last version that bore on each day, `cash` the daily sums.  What is
    stored grows with trades, cash and days, never with days times positions.
    """

    positions: ChangeTable
    closed: BatchLog
    days: NewestPerKey
    cash: BatchSums

    def intervals(self) -> DataFrame:
        """Every state that a position was in, from one version up to, and without, another; NULL where it still is."""
        still = F.lit(None).cast("bigint").alias("valid_to")
        return self.closed.read().unionByName(self.positions.read().select("*", still))

    def all_days(self) -> DataFrame:
        """(snapshot_date, version) for every day that a batch bore on."""
        return self.days.read()


def holdings_history(spark: SparkSession, path: str, cash: BatchSums, buckets: int = 64) -> HoldingsHistory:
    """An empty or earlier history below a path."""
    open_rows = T.StructType([*POSITIONS.fields, T.StructField("valid_from", T.LongType())])
    day = T.StructType([T.StructField("snapshot_date", T.DateType()), VERSION])
    return HoldingsHistory(
        ChangeTable(spark, f"{path}/positions", open_rows, POSITION_KEY, buckets),
        BatchLog(spark, f"{path}/closed", INTERVALS),
        NewestPerKey(spark, f"{path}/days", day, ("snapshot_date",)),
        cash,
    )


def history_step(
    history: HoldingsHistory,
    trades: Callable[[DataFrame], DataFrame],
    movements: Callable[[DataFrame], DataFrame],
    as_of: dt.datetime,
    compact_every: int = 50,
) -> Step:
    """Bring a history up to a batch: cash, positions, the intervals that end, the days it bears on.

    `trades` and `movements` take trades and cash movements out of a batch.  Each table is written under the
    batch's id and reads only what was there before it, so a replay leaves all of them as they are.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        traded, moved = trades(batch), movements(batch)
        history.cash.add(daily_cash(moved), batch_id)
        held = history.positions.read(before=batch_id, only=traded).persist(SPILLING)
        try:
            changes = changed_positions(held.drop("valid_from"), traded, as_of).withColumn("valid_from", F.lit(batch_id).cast("bigint"))
            history.positions.apply(changes, batch_id)
            # What was written says which keys changed, so the merge is not done again.
            history.closed.add(closed_intervals(held, history.positions.changed(batch_id), batch_id), batch_id)
        finally:
            held.unpersist()
        # The daily sums say on which days cash moved, so movements are not gathered again.
        days = touched_dates(traded).union(touched_dates(history.cash.added(batch_id))).distinct()
        history.days.add(days.withColumn("version", F.lit(batch_id).cast("bigint")), batch_id)
        if (batch_id + 1) % compact_every == 0:
            history.positions.compact(batch_id)
            for log in (history.cash, history.closed, history.days):
                log.compact(batch_id)

    return run
