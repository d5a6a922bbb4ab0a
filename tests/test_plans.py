"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from holdfast import operators as O
from holdfast.plans import adapters as A
from holdfast.plans import holdings as H

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["portfolio_snapshot", "cross_dates", "asof_price", "current_holdings"])
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name", ["enrich_trades", "flatten_trades", "daily_cash", "merge_positions", "masked_customers"]
)
def test_no_python_in_plans(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["filter_in"](spark, FOLDER))
    assert "PushedFilters: [In(c_mktsegment" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    text = plan(entry.queries()["scan_typed"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text


def test_latest_rows_are_limited_before_the_shuffle(spark):
    text = plan(H.latest_cash(A.daily(spark, FOLDER)))
    assert text.count("WindowGroupLimit") == 2


def test_top_traders_keep_a_bounded_heap(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_traders"](spark, FOLDER))


def test_asof_shuffles_twice(spark):
    probes = spark.range(9).select(F.col("id").cast("string").alias("ticker"), F.lit(A.BATCH_CUT).alias("as_of"))
    text = plan(O.asof_prices(probes, A.part_prices(spark, FOLDER).withColumn("close_price", F.col("close_price"))))
    # One for the adapter's daily maximum, one per ticker and day, one per ticker.
    assert text.count("Exchange hashpartitioning") == 3


def test_role_decides_the_plan(spark):
    people, links, users = (
        A.customers(spark, FOLDER), A.customer_advisor(spark, FOLDER), A.advisor_users(spark, FOLDER)
    )
    own = plan(O.row_access(people, O.Principal("ADV0", "CLIENT_ADVISOR_RL"), links, users))
    everyone = plan(O.row_access(people, O.Principal("ADV0", "SYSADMIN"), links, users))
    assert "LeftSemi" in own
    assert "LeftSemi" not in everyone and "supplier" not in everyone


def test_classification_reads_once(spark):
    text = plan(O.classify_columns(A.customers(spark, FOLDER)))
    assert text.count("customer.parquet") == 1


def test_nothing_above_the_dates_is_shuffled(spark):
    positions, cash = A.positions(spark, FOLDER), A.daily(spark, FOLDER)
    days = A.year_ends(A.feed_days(A.brand_trades(spark, FOLDER), A.cash_deposits(spark, FOLDER)))
    flows = cash.select(
        "customer_id", "account_type", "daily_net_cash", F.col("transaction_date").alias("cash_date"),
        F.col("transaction_date").cast("date").alias("snapshot_date"),
    )
    curves = H.price_curves(positions.select("ticker").distinct(), days, A.brand_prices(spark, FOLDER))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(H.dated_positions(positions, days, curves, flows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in text[: text.index("Generate explode(slots")]


def test_a_hot_ticker_is_split(spark, tmp_path):
    wide = "x" * 200
    held = spark.range(60_000).select(
        F.col("id").alias("customer_id"), F.lit(wide).alias("account_type"),
        F.when(F.col("id") % 10 < 8, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("ticker"),
        F.lit(1).cast("decimal(18,4)").alias("current_shares"),
    ).repartition(16)
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string").select(F.col("d").cast("date").alias("snapshot_date"))
    flows = spark.createDataFrame(
        [], "customer_id bigint, account_type string, daily_net_cash decimal(18,2), cash_date timestamp_ntz, snapshot_date date"
    )
    path = str(tmp_path / "curves")
    prices = spark.createDataFrame([], "ticker string, price_date date, close_price decimal(10,2)")
    H.price_curves(held.select("ticker").distinct(), days, prices).write.parquet(path)
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {key: spark.conf.get(key) for key in low}
    for key, value in low.items():
        spark.conf.set(key, value)
    try:
        found = H.dated_positions(held, days, spark.read.parquet(path), flows)
        rows = found.collect()
        text = plan(found)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(rows) == 120_000
    assert "skew=true" in text


def test_a_day_filter_needs_no_sort_of_the_lines(spark):
    assert "SortMergeJoin" not in plan(entry.queries()["filter_eq"](spark, FOLDER))


def test_paths_of_stored_payloads_read_their_own_columns(spark, tmp_path):
    """Payloads are stored shredded; a path read names its sub-columns, and no whole payload."""
    path = str(tmp_path / "payloads")
    A.trades_raw(spark, FOLDER).coalesce(1).write.parquet(path)
    import pyarrow.parquet as pq

    (stored,) = (tmp_path / "payloads").glob("*.parquet")
    columns = pq.ParquetFile(stored).schema.to_arrow_schema().field("transaction_payload").type
    shredded = columns.field("typed_value").type
    assert {"customer_id", "account_type", "trades"} <= {shredded.field(k).name for k in range(shredded.num_fields)}
    paths = {"customer_id": ("$.customer_id", "bigint"), "ticker": ("$.trades[0].ticker", "string")}
    found = O.payload_paths(spark.read.parquet(path), paths)
    assert "transaction_payload:struct<0:bigint,1:string>" in plan(found)
    whole = F.try_variant_get("transaction_payload", "$", "struct<customer_id: bigint, trades: array<struct<ticker: string>>>")
    expected = spark.read.parquet(path).select(whole.alias("p")).select("p.customer_id", F.get("p.trades", F.lit(0))["ticker"])
    assert found.select("customer_id", "ticker").exceptAll(expected).isEmpty()
    odd = spark.sql("SELECT 1 AS id, parse_json('{\"customer_id\": \"x\", \"trades\": 3}') AS transaction_payload")
    assert [tuple(row) for row in O.payload_paths(odd, paths).collect()] == [(1, None, None)]


def test_orders_meet_customers_before_their_lines(spark):
    text = A.brand_trades(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join Inner" in line]
    assert len(joins) == 3
    # The join with the customers is the deepest: below the one with the lines.
    assert "c_custkey" in max(joins, key=lambda line: line.index("Join"))
