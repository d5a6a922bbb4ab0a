"""Queries over sources and sinks.  Each writes below a folder of its own."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources as S
from ..plans import adapters as A
from ..plans.trades import flattened
from ..session import workspace
from ..sources.files import CSV_WRITE_OPTIONS
from ..streaming import auto_ingest, change_feed, consume, csv_feed, unload_ledger, unload_step
from ..types import AMOUNT, CASH_DEPOSITS, LEDGER, LONG, RETIREMENT_CONTRIBUTIONS, TEXT, schema
from .common import plain

START = dt.date(1995, 1, 1)
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
SCHEMA_CUT = dt.datetime(1998, 1, 1)


def _write_csv(df: DataFrame, path: str, mode: str = "errorifexists", max_rows: int = 0) -> None:
    """`max_rows`: most rows of a file, 0 for no limit."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).option("maxRecordsPerFile", max_rows).csv(path)


def scan_typed(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"l_orderkey": "bigint", "l_extendedprice": "decimal(12,2)", "l_shipdate": "date"}
    return plain(S.scan_parquet(spark, f"{folder}/lineitem.parquet", columns))


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    documents = S.table(spark, folder, "documents")
    path = f"{workspace(spark)}/documents"
    # A file with line breaks inside quotes is one task, so files are kept small.
    _write_csv(documents, path, max_rows=20_000)
    return S.scan_csv(spark, path, documents.schema, multiline=True)


def csv_json_payload(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{workspace(spark)}/trades"
    raw = A.trades_raw(spark, folder)
    _write_csv(raw.withColumn("transaction_payload", F.to_json("transaction_payload")), path)
    trades = flattened(S.scan_json_payload_csv(spark, path))
    return plain(
        trades.groupBy("customer_id", "transaction_date", "account_type").agg(
            F.count("*").alias("trades"),
            F.sum("shares").alias("shares"),
            F.sum("total_trade_value").alias("value"),
        )
    )


def _contribution_folders(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Contributions as landed: an older folder without the schedule, a newer one with it."""
    landing = workspace(spark)
    rows = A.contributions(spark, folder)
    older, newer = f"{landing}/original_schema", f"{landing}/new_schema"
    is_old = F.col("transaction_date") < F.lit(SCHEMA_CUT)
    rows.where(is_old).drop("contribution_schedule").write.parquet(older)
    new = rows.where(~is_old)
    new.toDF(*(name.upper() for name in new.columns)).write.parquet(newer)
    return older, newer


def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    """The two layouts that contributions landed in, from the footers of all their files, and the shape of all payloads."""
    older, newer = _contribution_folders(spark, folder)
    columns = S.diff_reports(*(S.merged_report(S.schema_by_file(spark, path), path) for path in (older, newer)))
    payload = S.payload_shape(A.trades_raw(spark, folder), "transaction_payload", "trades")
    return columns.unionByName(
        payload.select(
            "column_name",
            F.lit(None).cast("string").alias("old_type"),
            F.col("type").alias("new_type"),
            F.lit("payload").alias("status"),
        )
    )


def schema_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of every given table, from the footer of each of its files."""
    found = None
    for name in TABLES:
        one = S.schema_by_file(spark, f"{folder}/{name}.parquet").select(F.lit(name).alias("table_name"), "column_name", "type", "nullable", "order_id")
        found = one if found is None else found.union(one)
    return plain(found.distinct())


def create_inferred(spark: SparkSession, folder: str) -> DataFrame:
    older, _ = _contribution_folders(spark, folder)
    inferred = S.inferred_schema(spark, older)
    path = f"{workspace(spark)}/contributions"
    S.create_from_schema(spark, inferred, path)
    S.load_by_name(spark.read.parquet(older), inferred).write.mode("append").parquet(path)
    return _by_account(spark.read.schema(inferred).parquet(path))


def _by_account(rows: DataFrame, *more: str) -> DataFrame:
    return plain(
        rows.groupBy("account_type_name", "customer_id", *more).agg(
            F.count("*").alias("contributions"),
            F.sum("share_amount").alias("shares"),
            F.sum("total_trade_amount").alias("amount"),
        )
    )


def load_by_name(spark: SparkSession, folder: str) -> DataFrame:
    staged = S.table(spark, folder, "customer").selectExpr(
        "c_mktsegment as DEPARTMENT", "c_name as First_Name", "c_custkey as CUSTOMER_ID",
        "c_acctbal as Salary", "c_nationkey as unused",
    )
    target = schema(customer_id=LONG, first_name=TEXT, salary=AMOUNT, department=TEXT, ssn=TEXT)
    return plain(S.load_by_name(staged, target))


def schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    older, newer = _contribution_folders(spark, folder)
    base = S.load_by_name(spark.read.parquet(older), RETIREMENT_CONTRIBUTIONS)
    return _by_account(S.evolve_append(base, spark.read.parquet(newer)), "contribution_schedule")


def load_positional(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{workspace(spark)}/deposits"
    _write_csv(A.cash_deposits(spark, folder).withColumn("eighth", F.lit("left out")), path)
    staged = S.scan_csv(spark, path, schema(**{f"field_{n}": TEXT for n in range(8)}))
    return plain(S.load_positional(staged, CASH_DEPOSITS))


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files per layout; how many files there are is up to the writer, folders are one per account type."""
    landing = workspace(spark)
    rows = A.contributions(spark, folder)
    is_old = F.col("transaction_date") < F.lit(SCHEMA_CUT)
    for name, part in (("original_schema", rows.where(is_old)), ("new_schema", rows.where(~is_old))):
        S.write_table(part, f"{landing}/{name}", partition_by=("account_type_name",))
    patterns = {"new_schema": "%new_schema%", "original_schema": "%original_schema%"}
    found = S.file_inventory(spark, landing, patterns).where("schema_type IS NOT NULL")
    return found.select(
        "schema_type",
        (F.col("total_bytes") > 0).alias("has_bytes"),
        (F.col("num_of_files") >= F.col("num_of_folders")).alias("has_files"),
        F.col("num_of_folders").alias("account_types"),
    )


def auto_ingest_query(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops of files, the ingest run after each and once more with nothing new."""
    root = workspace(spark)
    landing, sink, checkpoint = f"{root}/landing", f"{root}/deposits", f"{root}/checkpoint"
    deposits = A.cash_deposits(spark, folder)
    first = F.col("transaction_date") < F.lit(dt.datetime(2024, 1, 16))
    for drop in (deposits.where(first), deposits.where(~first), None):
        if drop is not None:
            _write_csv(drop, landing, "append")
        feed = csv_feed(spark, landing, CASH_DEPOSITS)
        auto_ingest(feed, sink, checkpoint).awaitTermination()
    return plain(spark.read.parquet(sink))


def unload_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Unload by day, unload one half again, read all days back."""
    path = f"{workspace(spark)}/deposits"
    deposits = A.cash_deposits(spark, folder)
    S.unload_by_date(deposits, path)
    S.unload_by_date(deposits.where(F.col("transaction_date") < dt.datetime(2024, 1, 16)), path)
    return plain(S.scan_csv(spark, path, CASH_DEPOSITS).select(*CASH_DEPOSITS.fieldNames()))


def _feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    trades = A.trades_flat(spark, folder).select(
        "customer_id", "transaction_date", "account_type"
    ).distinct()
    return {"trades": trades, "deposits": A.cash_deposits(spark, folder)}


def _calendar(spark: SparkSession, folder: str) -> DataFrame:
    empty = spark.createDataFrame([], LEDGER)
    return S.load_calendar(_feeds(spark, folder), {"trades": empty, "deposits": empty}, START)


def load_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_calendar(spark, folder))


def unload_status(spark: SparkSession, folder: str) -> DataFrame:
    calendar = _calendar(spark, folder)
    status = S.unload_status(calendar, "trades").withColumn("feed", F.lit("trades"))
    return plain(
        status.unionByName(S.unload_status(calendar, "deposits").withColumn("feed", F.lit("deposits")))
    )


def ledger_mark(spark: SparkSession, folder: str) -> DataFrame:
    """Mark the days up to the cut, then list marked and pending days."""
    trades = _feeds(spark, folder)["trades"]
    empty = spark.createDataFrame([], LEDGER)
    early = S.pending_days(trades, empty).where(F.col("transaction_date") < F.lit(A.BATCH_CUT))
    ledger = S.mark_done(empty, early, A.AS_OF)
    pending = S.pending_days(trades, ledger)
    return plain(
        ledger.select("transaction_date", "unload_status").unionByName(
            pending.select("transaction_date", F.lit("PENDING").alias("unload_status"))
        )
    )


def unload_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Pending days unloaded, marked and read back, from a ledger with the days before the cut.

    One row per feed and day: rows in the feed, rows read back, status before and after, and whether
    the cursor stood on the day.
    """
    raw = A.trades_raw(spark, folder)
    feeds = {
        "trades": raw.withColumn("transaction_payload", F.to_json("transaction_payload")),
        "deposits": A.cash_deposits(spark, folder),
    }
    cuts = {"trades": A.BATCH_CUT, "deposits": dt.date(2024, 1, 16)}
    root, out = workspace(spark), []
    empty = spark.createDataFrame([], LEDGER)
    for name, rows in feeds.items():
        rows = S.write_table(rows, f"{root}/{name}")
        known = S.pending_days(rows, empty)
        ledger = S.mark_done(empty, known.where(F.col("transaction_date") < F.lit(cuts[name])), A.AS_OF)
        ledger = S.write_table(ledger, f"{root}/{name}-ledger")
        pending = S.pending_days(rows, ledger)
        cursor = S.next_day(rows, ledger).withColumn("is_next", F.lit(True))
        due = rows.withColumn("_day", F.col("transaction_date").cast("date")).join(
            pending.select(F.col("transaction_date").alias("_day")), "_day", "left_semi"
        )
        S.unload_by_date(due.drop("_day"), f"{root}/{name}-unloaded")
        back = S.scan_csv(spark, f"{root}/{name}-unloaded", rows.schema).select(*rows.columns)
        unloaded = S.pending_days(back, empty).withColumnRenamed("records", "unloaded")
        after = S.mark_done(ledger, pending, A.AS_OF)
        before, then = (
            frame.select("transaction_date", F.col("unload_status").alias(column))
            for frame, column in ((ledger, "status_before"), (after, "status_after"))
        )
        report = known
        for frame in (before, then, unloaded, cursor):
            report = report.join(frame, "transaction_date", "left")
        out.append(
            report.select(
                F.lit(name).alias("feed"),
                "transaction_date",
                "records",
                F.coalesce("unloaded", F.lit(0)).alias("unloaded"),
                F.coalesce("status_before", F.lit("PENDING")).alias("status_before"),
                F.coalesce("status_after", F.lit("PENDING")).alias("status_after"),
                F.coalesce("is_next", F.lit(False)).alias("is_next"),
            )
        )
    return plain(out[0].unionByName(out[1]))


def unload_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Deposits unloaded as they come, in two drops; the ledger's rows of each day beside those read back.

    The second drop brings days again, which are then unloaded in two folders.
    """
    root = workspace(spark)
    deposits = A.cash_deposits(spark, folder)
    first = F.col("customer_id") % 2 == 0
    ledger = unload_ledger(spark, f"{root}/ledger")
    for drop in (deposits.where(first), deposits.where(~first)):
        drop.write.mode("append").parquet(f"{root}/deposits")
        feed = change_feed(spark, f"{root}/deposits", CASH_DEPOSITS)
        consume(feed, f"{root}/checkpoint", unload_step(f"{root}/unloaded", ledger, A.AS_OF)).awaitTermination()
    back = S.scan_csv(spark, f"{root}/unloaded", CASH_DEPOSITS).groupBy(F.col("transaction_date").cast("date").alias("transaction_date"))
    back = back.agg(F.count("*").alias("unloaded"), F.countDistinct("batch_id").alias("folders"))
    return plain(ledger.read().join(back, "transaction_date", "full"), times=("unload_time",))


def add_columns(spark: SparkSession, folder: str) -> DataFrame:
    widened = S.add_columns(
        A.cash_deposits(spark, folder), {"unload_status": "string", "unload_time": "timestamp_ntz"}
    )
    return plain(widened)


QUERIES = {
    "scan_typed": scan_typed,
    "csv_roundtrip": csv_roundtrip,
    "csv_json_payload": csv_json_payload,
    "schema_report": schema_report,
    "schema_by_file": schema_by_file,
    "create_inferred": create_inferred,
    "load_by_name": load_by_name,
    "schema_evolution": schema_evolution,
    "load_positional": load_positional,
    "file_inventory": file_inventory,
    "auto_ingest": auto_ingest_query,
    "unload_roundtrip": unload_roundtrip,
    "unload_status": unload_status,
    "load_calendar": load_calendar,
    "ledger_mark": ledger_mark,
    "unload_cycle": unload_cycle,
    "unload_stream": unload_stream,
    "add_columns": add_columns,
}
