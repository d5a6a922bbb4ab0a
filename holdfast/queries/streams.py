"""Queries that reach their result through micro-batches.

Every query lands files, runs its feeds until nothing is left, lands the rest and
runs them again, as a restarted job would.  Results are read from the tables the
feeds keep.
"""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import build_payload
from ..plans import adapters as A
from ..plans import cash as C
from ..plans import holdings as H
from ..plans import intervals as I
from ..plans.trades import flattened
from ..session import move_files, workspace
from ..sources.files import CSV_WRITE_OPTIONS, parse_payload, write_table
from ..streaming import (
    BatchFolders,
    BatchSums,
    ChangeTable,
    HoldingsHistory,
    auto_ingest,
    change_feed,
    consume,
    csv_feed,
    daily_cash_step,
    has_data,
    history_step,
    holdings_history,
    newest_totals,
    part,
    positions_step,
    run_steps,
    stateful_sums,
    tagged_union,
    totals_step,
    totals_table,
    with_change_metadata,
)
from ..types import (
    CASH,
    CASH_DEPOSITS,
    DAILY_CASH,
    LONG,
    POSITION_KEY,
    POSITIONS,
    SECURITY_TRADES_CSV,
    TEXT,
    TRADES_FLAT,
    schema,
)
from .common import plain

MID_MONTH = dt.datetime(2024, 1, 16)
# Few, as the tables here are small; a bucket is to be a few files.
BUCKETS = 8


def _deposit_drops(spark: SparkSession, folder: str) -> list[DataFrame]:
    deposits = A.cash_deposits(spark, folder)
    early = F.col("transaction_date") < F.lit(MID_MONTH)
    return [deposits.where(early), deposits.where(~early)]


def _daily(spark: SparkSession, path: str) -> BatchSums:
    return BatchSums(spark, path, DAILY_CASH, C.DAILY_KEY, "daily_net_cash")


def stream_initial(spark: SparkSession, folder: str) -> DataFrame:
    """The first run of a feed sees all rows already there."""
    root = workspace(spark)
    A.cash_deposits(spark, folder).write.parquet(f"{root}/deposits")
    seen = BatchFolders(spark, f"{root}/seen", CASH_DEPOSITS)
    feed = change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)
    consume(feed, f"{root}/checkpoint", lambda batch, n: seen.write(batch, n)).awaitTermination()
    return plain(seen.read().select(*CASH_DEPOSITS.fieldNames()))


def stream_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Two consumers of one feed, running at different times, both see every row."""
    root = workspace(spark)
    seen = BatchFolders(spark, f"{root}/seen", CASH_DEPOSITS)

    def run(consumer: str) -> None:
        feed = change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)
        consume(
            feed, f"{root}/checkpoint_{consumer}", lambda batch, n: seen.write(batch, n, consumer)
        ).awaitTermination()

    first, second = _deposit_drops(spark, folder)
    first.write.parquet(f"{root}/deposits")
    run("eager")
    run("eager")
    second.write.mode("append").parquet(f"{root}/deposits")
    run("eager")
    run("late")
    return plain(
        seen.read().groupBy(F.col("source").alias("consumer"), "customer_id").agg(
            F.count("*").alias("deposits"), F.sum("deposit_amount").alias("amount")
        )
    )


def stream_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Deposits with the kind of change, and whether their row ids are digests and told apart.

    The ids themselves depend on file names.
    """
    root = workspace(spark)
    A.cash_deposits(spark, folder).write.parquet(f"{root}/deposits")
    columns = CASH_DEPOSITS.fieldNames()
    feed = with_change_metadata(change_feed(spark, f"{root}/deposits", CASH_DEPOSITS), columns)
    auto_ingest(feed, f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    changes = spark.read.parquet(f"{root}/changes")
    ids = changes.groupBy("metadata_row_id").agg((F.count("*") == 1).alias("id_is_unique"))
    digest = F.col("metadata_row_id").rlike("^[0-9a-f]{32}$").alias("id_is_digest")
    return plain(changes.join(ids, "metadata_row_id").select(*columns, "metadata_action", "id_is_unique", digest))


def daily_cash_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Daily net cash refreshed from two feeds, deposits and trades, in two drops each."""
    root = workspace(spark)
    target = _daily(spark, f"{root}/daily")
    trades = A.brand_trades(spark, folder)
    early = F.col("transaction_date") < F.lit(A.BATCH_CUT)
    drops = zip(_deposit_drops(spark, folder), (trades.where(early), trades.where(~early)), strict=True)
    for deposits, traded in drops:
        deposits.write.mode("append").parquet(f"{root}/deposits")
        traded.select(*TRADES_FLAT.fieldNames()).write.mode("append").parquet(f"{root}/trades")
        running = [
            consume(
                change_feed(spark, f"{root}/deposits", CASH_DEPOSITS),
                f"{root}/checkpoint_deposits",
                daily_cash_step(target, "deposits", C.deposit_cash),
            ),
            consume(
                change_feed(spark, f"{root}/trades", TRADES_FLAT),
                f"{root}/checkpoint_trades",
                daily_cash_step(target, "trades", C.trade_cash),
            ),
        ]
        for query in running:
            query.awaitTermination()
    return plain(target.read())


def merge_positions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Positions kept by a feed; the drops are cut at a fixed day, as is the batch form."""
    root = workspace(spark)
    target = ChangeTable(spark, f"{root}/positions", POSITIONS, POSITION_KEY, BUCKETS)
    trades = A.brand_trades(spark, folder).select(*TRADES_FLAT.fieldNames())
    early = F.col("transaction_date") < F.lit(A.BATCH_CUT)
    for drop in (trades.where(early), trades.where(~early)):
        drop.write.mode("append").parquet(f"{root}/trades")
        consume(
            change_feed(spark, f"{root}/trades", TRADES_FLAT),
            f"{root}/checkpoint",
            positions_step(target, A.AS_OF, compact_every=1),
        ).awaitTermination()
    return plain(target.read().drop("last_updated"))


def portfolio_snapshot_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of every day that a batch of trades touches, made after its positions; two drops."""
    root = workspace(spark)
    positions = ChangeTable(spark, f"{root}/positions", POSITIONS, POSITION_KEY, BUCKETS)
    prices = write_table(A.brand_prices(spark, folder), f"{root}/prices")
    history = totals_table(spark, f"{root}/totals")
    steps = run_steps(positions_step(positions, A.AS_OF), totals_step(history, positions, prices))
    trades = A.brand_trades(spark, folder).select(*TRADES_FLAT.fieldNames())
    early = F.col("transaction_date") < F.lit(A.BATCH_CUT)
    for drop in (trades.where(early), trades.where(~early)):
        drop.write.mode("append").parquet(f"{root}/trades")
        feed = change_feed(spark, f"{root}/trades", TRADES_FLAT)
        consume(feed, f"{root}/checkpoint", steps).awaitTermination()
    return plain(newest_totals(history))


def feed_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a consumer has rows to take: before its first run, after it, after a drop, after that run."""
    root = workspace(spark)
    said: list[tuple[int, bool, int]] = []
    seen = BatchFolders(spark, f"{root}/seen", CASH_DEPOSITS)
    for drop in _deposit_drops(spark, folder):
        drop.write.mode("append").parquet(f"{root}/deposits")
        feed = change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)
        for _ in range(2):
            waiting = has_data(feed, f"{root}/checkpoint")
            if waiting:
                consume(feed, f"{root}/checkpoint", lambda batch, n: seen.write(batch, n)).awaitTermination()
            said.append((len(said), waiting, seen.read().count()))
    return spark.createDataFrame(said, "step bigint, has_data boolean, taken bigint")


def _history(spark: SparkSession, root: str) -> HoldingsHistory:
    return holdings_history(spark, f"{root}/holdings", _daily(spark, f"{root}/daily"), BUCKETS)


def _follow(spark: SparkSession, root: str, trades: str, deposits: str) -> HoldingsHistory:
    """Run the one writer of a history over all that waits in both feeds."""
    history = _history(spark, root)
    feed = tagged_union(
        trades=change_feed(spark, trades, TRADES_FLAT), deposits=change_feed(spark, deposits, CASH_DEPOSITS)
    )
    step = history_step(
        history,
        trades=lambda batch: part(batch, "trades"),
        movements=lambda batch: C.cash_detail(part(batch, "deposits"), part(batch, "trades")),
        as_of=A.AS_OF,
    )
    consume(feed, f"{root}/checkpoint/holdings", run_steps(step)).awaitTermination()
    return history


def _two_drops(spark: SparkSession, folder: str, root: str) -> HoldingsHistory:
    """A history after two drops of both feeds, of trades that are joined and stored once and land as files."""
    drop = F.when(F.col("transaction_date") < F.lit(A.BATCH_CUT), 0).when(F.col("transaction_date") >= F.lit(A.BATCH_CUT), 1)
    traded = A.brand_trades(spark, folder, all_days=True).select(*TRADES_FLAT.fieldNames()).withColumn("drop", drop).where("drop IS NOT NULL")
    write_table(traded, f"{root}/traded", partition_by=("drop",), few=True)
    for number, deposits in enumerate(_deposit_drops(spark, folder)):
        move_files(spark, f"{root}/traded/drop={number}", f"{root}/trades", f"drop{number}-")
        deposits.write.mode("append").option("compression", "zstd").parquet(f"{root}/deposits")
        history = _follow(spark, root, f"{root}/trades", f"{root}/deposits")
    return history


def holdings_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Every state of every position with the batches it held from and up to, kept over two drops of both feeds."""
    history = _two_drops(spark, folder, workspace(spark))
    return plain(history.intervals(), nullable_numbers=("valid_to",), times=("last_updated",))


def holdings_on_days(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings row by row on every day that a batch bore on, read from intervals, then summed per day, account type and kind."""
    root = workspace(spark)
    history = _two_drops(spark, folder, root)
    prices = write_table(A.brand_prices(spark, folder), f"{root}/prices")
    intervals = write_table(history.intervals(), f"{root}/intervals")
    cash = write_table(history.cash.read(), f"{root}/cash")
    rows = I.holdings_on_days(history.all_days(), intervals, prices, cash, units=True)
    return plain(I.totals_of_days(rows, I.account_types(intervals, cash)))


ACCOUNT_CASH = schema(customer_id=LONG, account_type=TEXT, net_cash=CASH)


def aggregate_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What each of two batches did to two tables that update: the net cash per account, and the positions."""
    root = workspace(spark)
    history = _two_drops(spark, folder, root)
    accounts = BatchSums(spark, f"{root}/accounts", ACCOUNT_CASH, ("customer_id", "account_type"), "net_cash")
    # The daily sums are themselves a feed, whose batches are added up per account.
    daily = history.cash
    for batch_id in (0, 1):
        changed = daily.changes({"feed": batch_id - 1}, {"feed": batch_id})
        sign = F.when(F.col("metadata_image") == "after", F.col("daily_net_cash")).otherwise(-F.col("daily_net_cash"))
        partial = changed.groupBy("customer_id", "account_type").agg(F.sum(sign).cast(CASH).alias("net_cash"))
        accounts.add(partial, batch_id)
    found = []
    for batch_id in (0, 1):
        cash = accounts.changes({"feed": batch_id - 1}, {"feed": batch_id})
        held = history.positions.changes(batch_id - 1, batch_id)
        found.append(
            cash.select(
                F.lit("account cash").alias("table_name"), "customer_id", "account_type", F.lit(None).cast("string").alias("ticker"),
                F.col("net_cash").alias("value"), "metadata_action", "metadata_image", F.lit(batch_id).alias("batch_id"),
            )
        )
        found.append(
            held.select(
                F.lit("positions"), *POSITION_KEY, F.col("current_shares").cast(CASH), "metadata_action", "metadata_image", F.lit(batch_id)
            )
        )
    return plain(reduce(DataFrame.union, found))


def daily_cash_stateful(spark: SparkSession, folder: str) -> DataFrame:
    """Daily net cash kept by the state store, in two drops with a restart between them."""
    root = workspace(spark)
    target = ChangeTable(spark, f"{root}/daily", DAILY_CASH, C.DAILY_KEY, BUCKETS)
    traded = A.brand_trades(spark, folder).select(*TRADES_FLAT.fieldNames())
    early = F.col("transaction_date") < F.lit(A.BATCH_CUT)
    for trades, deposits in zip((traded.where(early), traded.where(~early)), _deposit_drops(spark, folder), strict=True):
        trades.write.mode("append").parquet(f"{root}/trades")
        deposits.write.mode("append").parquet(f"{root}/deposits")
        moved = C.deposit_cash(change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)).select(*C.DAILY_KEY, "amount")
        moved = moved.unionByName(C.trade_movements(change_feed(spark, f"{root}/trades", TRADES_FLAT)))
        stateful_sums(moved, C.DAILY_KEY, "amount", target, f"{root}/checkpoint").awaitTermination()
    return plain(target.read())


def holdings_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files to current holdings.

    Trades land as JSON in CSV and deposits as CSV.  They are ingested and trades are flattened.  One
    query then reads both feeds, and each of its batches brings cash, positions, intervals and days up to
    date together.  Any day can be read from that (`holdings_on_days`); here the newest is made a snapshot.
    """
    root = workspace(spark)

    # Landing.
    raw = build_payload(A.payload_input(A.brand_trades(spark, folder)))
    text = raw.withColumn("transaction_payload", F.to_json("transaction_payload"))
    # Landed files are as many as the tasks that write them, so a compressed one need not be split.
    text.write.options(**CSV_WRITE_OPTIONS, compression="gzip").csv(f"{root}/landing/trades")
    deposits = A.cash_deposits(spark, folder)
    deposits.write.options(**CSV_WRITE_OPTIONS, compression="gzip").csv(f"{root}/landing/deposits")
    prices = write_table(A.brand_prices(spark, folder), f"{root}/prices")

    # Ingestion.
    ingests = [
        auto_ingest(
            parse_payload(csv_feed(spark, f"{root}/landing/trades", SECURITY_TRADES_CSV)),
            f"{root}/raw/trades",
            f"{root}/checkpoint/raw_trades",
        ),
        auto_ingest(
            csv_feed(spark, f"{root}/landing/deposits", CASH_DEPOSITS),
            f"{root}/raw/deposits",
            f"{root}/checkpoint/raw_deposits",
        ),
    ]
    for query in ingests:
        query.awaitTermination()
    raw_layout = spark.read.parquet(f"{root}/raw/trades").schema
    auto_ingest(
        flattened(change_feed(spark, f"{root}/raw/trades", raw_layout)),
        f"{root}/trades",
        f"{root}/checkpoint/trades",
    ).awaitTermination()

    history = _follow(spark, root, f"{root}/trades", f"{root}/raw/deposits")
    cash = write_table(history.cash.read(), f"{root}/cash")
    shown = I.holdings_on_days(I.newest_day(history.all_days()), history.intervals(), prices, cash)
    shown = H.write_snapshot(shown, f"{root}/history", A.AS_OF, few_days=True)
    return plain(H.current_holdings(shown, cash, A.AS_OF), times=("last_refreshed",))


QUERIES = {
    "stream_initial": stream_initial,
    "stream_fanout": stream_fanout,
    "stream_metadata": stream_metadata,
    "daily_cash_stream": daily_cash_stream,
    "merge_positions_stream": merge_positions_stream,
    "portfolio_snapshot_stream": portfolio_snapshot_stream,
    "feed_gate": feed_gate,
    "holdings_interval": holdings_interval,
    "holdings_on_days": holdings_on_days,
    "aggregate_changes": aggregate_changes,
    "daily_cash_stateful": daily_cash_stateful,
    "holdings_end_to_end": holdings_end_to_end,
}
