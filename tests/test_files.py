"""CSV details, loading by name and place, ledgers and calendars."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from holdfast import sources as S
from holdfast import types as L

D = {n: dt.date(2019, 1, n) for n in range(1, 32)}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_and_null_marker(spark, tmp_path):
    path = write(
        tmp_path / "s.csv",
        '"TICKER","NAME","EXCHANGE","SECTOR","MARKETCAP","GEO","ASSET_CLASS_HASH"\n'
        '"CASH","CASH","\\N","CASH","CASH","CASH","h1"\n'
        '"AB","A ""B"", C","NYSE",""," x ","US","h2"\n',
    )
    got = [tuple(row) for row in S.scan_csv(spark, path, L.DIM_SECURITIES, header=True).collect()]
    assert got == [
        ("CASH", "CASH", None, "CASH", "CASH", "CASH", "h1"),
        ("AB", 'A "B", C', "NYSE", "", " x ", "US", "h2"),
    ]


def test_csv_newline_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "m.csv", '"1","a\nb"\n"2","c"\n')
    layout = L.schema(number=L.LONG, text=L.TEXT)
    assert [tuple(row) for row in S.scan_csv(spark, path, layout, multiline=True).collect()] == [
        (1, "a\nb"), (2, "c"),
    ]


def test_dimension_files(spark, tmp_path, rows):
    """A dimension of each kind, and the checks that hold between them."""
    # The column headings of the files.
    classes = S.scan_csv(
        spark,
        write(
            tmp_path / "c.csv",
            '"ASSET_CLASS_HASH","ASSET_CLASS_DESCRIPTION","NUMBER_OF_SECURITIES","SECTOR",'
            '"MARKETCAP","GEO","SECURITY_TYPE"\n'
            '"h1","Bonds",1,"All","All","US","Bond"\n"h2","Small caps",2,"All","Small","US","ETF"\n',
        ),
        L.DIM_ASSET_CLASS,
        header=True,
    )
    portfolios = S.scan_csv(
        spark,
        write(
            tmp_path / "p.csv",
            '"PORTFOLIO_ID","PORTFOLIO_DESCRIPTION","RISK_LEVEL","RISK_LEVEL_DESCRIPTION",'
            '"ASSET_CLASS_COMPOSITION"\n'
            '0,"Mixed",1,"Low","{""composition"":[{""amount"":0.8,""asset_class_hash"":""h1""},'
            '{""amount"":0.2,""asset_class_hash"":""h2""}]}"\n',
        ),
        L.DIM_PORTFOLIO,
        header=True,
    )
    funds = S.scan_csv(
        spark,
        write(
            tmp_path / "f.csv",
            ",".join(name.upper() for name in L.DIM_RETIREMENT_FUNDS.fieldNames())
            + '\n"F1","Target One",2020,-4,0.80,0.10,0.05,0.03,0.02,0.19999999999999996,0.80\n',
        ),
        L.DIM_RETIREMENT_FUNDS,
        header=True,
    )
    from holdfast.plans.customers import composition_unnest

    parts = composition_unnest(portfolios, classes)
    assert rows(parts, "asset_class_hash", "amount", "asset_class_description") == [
        ("h1", 0.8, "Bonds"), ("h2", 0.2, "Small caps"),
    ]
    fund = funds.first()
    assert fund.years_to_retirement == -4
    assert fund.total_equity_pct == Decimal("0.19999999999999996")


def test_json_payload_csv(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        '"2019-01-02","id1","{""customer_id"":7,""trades"":[]}"\n"2019-01-03","id2","{broken"\n',
    )
    got = S.scan_json_payload_csv(spark, path).select(
        "transaction_date", F.try_variant_get("transaction_payload", "$.customer_id", "bigint")
    )
    assert [tuple(row) for row in got.collect()] == [(D[2], 7), (D[3], None)]


def test_scan_gives_null_for_bad_casts(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("7", "x"), ("y", "x")], "a string, b string").write.parquet(path)
    scan = S.scan_parquet(spark, path, {"a": "bigint"})
    assert sorted(row.a or 0 for row in scan.collect()) == [0, 7]
    assert "ReadSchema: struct<a:string>" in scan._jdf.queryExecution().toString()


def test_load_by_name(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "`Customer_ID` int, EXTRA string, Amount double")
    target = L.schema(amount=L.AMOUNT, customer_id=L.LONG, missing=L.TEXT)
    loaded = S.load_by_name(df, target)
    assert loaded.schema == target
    assert tuple(loaded.first()) == (Decimal("2.50"), 1, None)
    twice = df.withColumn("b", F.lit(1)).toDF("a", "A", "b", "c")
    with pytest.raises(ValueError, match="differ only in case"):
        S.load_by_name(twice, target)


def test_load_positional(spark):
    df = spark.createDataFrame([("1", "2.5", "left out")], "x string, y string, z string")
    target = L.schema(number=L.LONG, amount=L.AMOUNT)
    assert tuple(S.load_positional(df, target).first()) == (1, Decimal("2.50"))
    with pytest.raises(ValueError, match="1 input columns"):
        S.load_positional(df.select("x"), target)


def test_evolve_append(spark, rows):
    base = spark.createDataFrame([(1, "a")], "id int, name string")
    new = spark.createDataFrame([("b", 2, "weekly")], "NAME string, ID int, Schedule string")
    both = S.evolve_append(base, new)
    assert both.columns == ["id", "name", "Schedule"]
    assert rows(both) == [(1, "a", None), (2, "b", "weekly")]


def test_schema_reports(spark, tmp_path, rows):
    spark.createDataFrame([(1, "a")], "id int, name string").write.parquet(str(tmp_path / "old"))
    spark.createDataFrame([(1, 2)], "ID bigint, extra int").write.parquet(str(tmp_path / "new"))
    old = S.schema_report(spark, "old", str(tmp_path / "old"))
    new = S.schema_report(spark, "new", str(tmp_path / "new"))
    assert rows(S.diff_reports(old, new), "column_name", "status") == [
        ("extra", "added"), ("id", "changed"), ("name", "removed"),
    ]


def feed(spark, *days):
    return spark.createDataFrame([(D[day],) for day in days], "transaction_date date")


def test_calendar_and_status(spark, rows):
    empty = spark.createDataFrame([], L.LEDGER)
    feeds = {"trades": feed(spark, 3, 3, 9), "cash": feed(spark, 5)}
    ledgers = {"trades": S.mark_done(empty, feed(spark, 9), dt.datetime(2020, 1, 1)), "cash": empty}
    calendar = S.load_calendar(feeds, ledgers)
    # Day 9 is done, so the cursor stops at the last pending day of the other feed.
    assert rows(calendar) == [
        (D[2], 0, 0), (D[3], 2, 0), (D[4], 0, 0), (D[5], 0, 1),
    ]
    assert rows(S.unload_status(calendar, "trades"), "transaction_date", "status") == [
        (D[2], "SKIPPED"), (D[3], "PROCESSED"), (D[4], "SKIPPED"), (D[5], "SKIPPED"),
    ]


def test_calendar_of_empty_feeds_visits_the_start(spark, rows):
    empty, none = spark.createDataFrame([], L.LEDGER), feed(spark, 1).limit(0)
    assert rows(S.load_calendar({"trades": none}, {"trades": empty})) == [(D[2], 0)]


def test_ledger(spark, rows):
    empty = spark.createDataFrame([], L.LEDGER)
    days = feed(spark, 3, 4, 5)
    first = S.mark_done(empty, feed(spark, 3, 4), dt.datetime(2020, 1, 1))
    again = S.mark_done(first, feed(spark, 4), dt.datetime(2020, 1, 2))
    assert rows(again, "transaction_date", "unload_status", "unload_time") == [
        (D[3], "SUCCESS", dt.datetime(2020, 1, 1)), (D[4], "SUCCESS", dt.datetime(2020, 1, 2)),
    ]
    assert rows(S.pending_days(days, again)) == [(D[5], 1)]
    assert rows(S.next_day(days, first)) == [(D[5],)]
    assert rows(S.next_day(feed(spark, 3), first)) == [(None,)]
    assert rows(S.pending_days(days, S.reset_days(again, D[4]))) == [(D[4], 1), (D[5], 1)]
    assert S.reset_days(again).count() == 0


def test_unload_overwrites_only_its_days(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    layout = L.schema(transaction_date=L.DATE, text=L.TEXT)
    def df(*found):
        return spark.createDataFrame(list(found), layout)

    S.unload_by_date(df((D[1], 'say "a", b'), (D[2], None)), path)
    S.unload_by_date(df((D[2], "")), path)
    assert rows(S.scan_csv(spark, path, layout).select("transaction_date", "text")) == [
        (D[1], 'say "a", b'), (D[2], ""),
    ]


def test_add_columns(spark):
    widened = S.add_columns(feed(spark, 1), {"unload_status": "string", "unload_time": "timestamp_ntz"})
    assert tuple(widened.first()) == (D[1], None, None)


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        S.scan_parquet(spark, str(tmp_path / "nothing"), {"a": "int"})


def test_schemas_of_single_files(spark, tmp_path, rows):
    """Spark's and other writers' files, among them one that differs, by footers alone."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "n bigint, s string, at timestamp_ntz").coalesce(1).write.parquet(str(tmp_path / "t" / "one"))
    other = pa.table({"n": pa.array([1], pa.int32()), "at": pa.array([0], pa.timestamp("us")), "odd": pa.array([1], pa.uint64())})
    (tmp_path / "t" / "two").mkdir()
    pq.write_table(other, tmp_path / "t" / "two" / "x.parquet")
    (tmp_path / "t" / "two" / "notes.txt").write_text("no table")
    found = S.schema_by_file(spark, str(tmp_path / "t"))
    assert found.select("source").distinct().count() == 2
    assert rows(found.where("source LIKE '%x.parquet'"), "column_name", "type", "nullable", "order_id") == [
        ("at", "timestamp_ntz", True, 1), ("n", "int", True, 0), ("odd", "uint64", True, 2),
    ]
    merged = S.merged_report(found, "t")
    assert rows(merged, "column_name", "type", "order_id") == [
        ("at", "timestamp_ntz", 1), ("n", "bigint | int", 0), ("odd", "uint64", 2), ("s", "string", 1),
    ]
    old, new = (S.merged_report(found.where(F.col("source").like(f"%{name}%")), name) for name in ("one", "two"))
    assert rows(S.diff_reports(old, new), "column_name", "status") == [("at", "same"), ("n", "changed"), ("odd", "added"), ("s", "removed")]


def test_unloads_by_batch_can_be_replayed(spark, tmp_path, rows):
    from holdfast.streaming import unload_ledger, unload_step

    def batch(*days):
        return spark.createDataFrame([(D[day], f"r{day}") for day in days], "transaction_date date, name string")

    once, again = (str(tmp_path / name) for name in ("once", "again"))
    for root, tries in ((once, 1), (again, 2)):
        ledger = unload_ledger(spark, f"{root}/ledger")
        step = unload_step(f"{root}/out", ledger, dt.datetime(2024, 2, 1), compact_every=2)
        for batch_id, days in enumerate(([1, 1, 2], [2, 3], [], [1])):
            for _ in range(tries):
                step(batch(*days), batch_id)
        assert rows(ledger.read(), "transaction_date", "records", "unload_status") == [(D[1], 3, "SUCCESS"), (D[2], 2, "SUCCESS"), (D[3], 1, "SUCCESS")]
        back = S.scan_csv(spark, f"{root}/out", batch(1).schema)
        assert rows(back, "transaction_date", "name") == sorted((D[d], f"r{d}") for d in (1, 1, 2, 2, 3, 1))
        assert S.pending_days(batch(1, 2, 3, 4), ledger.read()).first().transaction_date == D[4]


ALONE = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, sys.argv[1])
from holdfast import sources as S
print("FOUND", *sorted(row["column_name"] for row in S.schema_by_file(spark, sys.argv[2]).collect()))
spark.stop()
"""


def test_footers_are_read_where_the_package_is_not(tmp_path):
    """The package is on the driver's path only."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    asked = [sys.executable, "-c", ALONE, str(Path(__file__).parents[1]), "/root/testdata/sf0.001/region.parquet"]
    said = subprocess.run(asked, capture_output=True, text=True, cwd=tmp_path, env=env, timeout=300)
    assert "FOUND r_name r_regionkey" in said.stdout or "FOUND r_comment" in said.stdout, said.stderr[-2000:]
