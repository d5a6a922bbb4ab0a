"""As-of prices, snapshots and current holdings."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from holdfast.operators import asof_instants, asof_prices, each_date, weekly_schedule
from holdfast.plans import cash as C
from holdfast.plans import holdings as H
from holdfast.types import DAILY_CASH, POSITIONS

NOW = dt.datetime(2024, 1, 1)
D = {n: dt.date(2024, 1, n) for n in range(1, 32)}
PRICES = "ticker string, price_date date, close_price decimal(10,2)"


def money(value):
    return None if value is None else Decimal(value).quantize(Decimal("0.01"))


def prices(spark, *found):
    return spark.createDataFrame(
        [(ticker, D[day], money(close)) for ticker, day, close in found], PRICES
    )


def dates(spark, *days):
    return spark.createDataFrame([(D[day],) for day in days], "snapshot_date date")


def positions(spark, *held):
    return spark.createDataFrame(
        [
            (customer, account, ticker, Decimal(shares), money(basis),
             Decimal(basis) / Decimal(shares) if shares else None, D[1], D[2], None)
            for customer, account, ticker, shares, basis in held
        ],
        POSITIONS,
    )


def cash(spark, *flows):
    return spark.createDataFrame(
        [
            (customer, dt.datetime(2024, 1, day), ticker, account, money(net))
            for customer, account, day, net, ticker in flows
        ],
        DAILY_CASH,
    )


def test_asof_cases(spark):
    probes = spark.createDataFrame(
        [("none", D[5]), ("later", D[5]), ("same", D[5]), ("many", D[5]), ("many", D[9]), ("two", D[5]),
         ("two", D[5]), ("null", D[5])],
        "ticker string, as_of date",
    )
    found = prices(
        spark, ("later", 6, 1), ("same", 5, 2), ("many", 1, 3), ("many", 4, 4), ("many", 7, 5),
        ("two", 5, 6), ("two", 5, 7), ("null", 3, 8), ("null", 4, None),
    )
    got = {(row.ticker, row.as_of.day): row.latest_price for row in asof_prices(probes, found).collect()}
    assert got == {
        ("none", 5): None, ("later", 5): None, ("same", 5): money(2), ("many", 5): money(4),
        ("many", 9): money(5), ("two", 5): money(7), ("null", 5): None,
    }


def test_asof_matches_brute_force_with_a_hot_ticker(spark):
    rng = random.Random(5)
    names = ["hot"] * 30 + list("abcdef")
    found = [(rng.choice(names), rng.randrange(1, 32), rng.randrange(1, 99)) for _ in range(300)]
    probes = [(rng.choice(names), D[rng.randrange(1, 32)]) for _ in range(300)]
    got = {
        (row.ticker, row.as_of): row.latest_price
        for row in asof_prices(
            spark.createDataFrame(probes, "ticker string, as_of date"), prices(spark, *found)
        ).collect()
    }
    expected = {}
    for ticker, day in probes:
        seen = [(d, close) for name, d, close in found if name == ticker and D[d] <= day]
        expected[ticker, day] = money(max(seen)[1]) if seen else None
    assert got == expected


def literal_snapshot(days, held, close, flows):
    """The outer join as defined, over SQL views."""
    spark = days.sparkSession
    asof_prices(
        each_date(held.select("ticker").distinct(), days).withColumnRenamed("snapshot_date", "as_of"), close
    ).createOrReplaceTempView("t_prices")
    days.distinct().createOrReplaceTempView("t_days")
    held.createOrReplaceTempView("t_held")
    flows.createOrReplaceTempView("t_flows")
    return spark.sql("""
        SELECT sd.snapshot_date, coalesce(sp.customer_id, cp.customer_id) AS customer_id,
               coalesce(sp.account_type, cp.account_type) AS account_type,
               CASE WHEN sp.ticker IS NOT NULL THEN 'SECURITY' ELSE 'CASH' END AS holding_type,
               coalesce(sp.ticker, 'CASH') AS ticker,
               CAST(CASE WHEN sp.ticker IS NOT NULL THEN CAST(sp.current_shares AS INT)
                    ELSE round(cp.daily_net_cash, 2) END AS DOUBLE) AS quantity,
               CAST(round(coalesce(lp.latest_price, 1.0), 2) AS DOUBLE) AS market_price,
               CAST(round(CASE WHEN sp.ticker IS NOT NULL
                    THEN sp.current_shares * coalesce(lp.latest_price, 0)
                    ELSE cp.daily_net_cash END, 2) AS DOUBLE) AS market_value,
               coalesce(sp.last_trade_date, CAST(cp.transaction_date AS DATE)) AS last_transaction_date
        FROM t_days sd
        LEFT JOIN t_held sp ON 1 = 1
        LEFT JOIN t_prices lp ON sd.snapshot_date = lp.as_of AND sp.ticker = lp.ticker
        FULL OUTER JOIN t_flows cp ON sd.snapshot_date = cp.transaction_date
             AND sp.customer_id = cp.customer_id AND sp.account_type = cp.account_type
        WHERE coalesce(sp.current_shares, cp.daily_net_cash, 0) > 0""")


SHARED = (
    "snapshot_date", "customer_id", "account_type", "holding_type", "ticker", "quantity",
    "market_price", "market_value", "last_transaction_date",
)


@pytest.mark.parametrize("seed", range(3))
def test_snapshot_equals_the_outer_join(spark, rows, seed):
    rng = random.Random(seed)
    held = {(rng.randrange(4), rng.choice("XY"), rng.choice("AB")): rng.randrange(1, 9) for _ in range(8)}
    flows = {
        (rng.randrange(6), rng.choice("XY"), rng.randrange(1, 5), rng.choice(["CASH", "USD"])):
        rng.randrange(-50, 90) for _ in range(30)
    }
    arguments = (
        dates(spark, 2, 4),
        positions(spark, *((*key, shares, shares * 7) for key, shares in held.items())),
        prices(spark, ("A", 1, 5), ("B", 3, 6)),
        cash(spark, *((c, a, day, net, t) for (c, a, day, t), net in flows.items())),
    )
    ours = H.portfolio_snapshot(*arguments).withColumns(
        {name: F.col(name).cast("double") for name in ("quantity", "market_price", "market_value")}
    )
    theirs = literal_snapshot(*arguments)
    assert rows(ours, *SHARED) == rows(theirs, *SHARED)
    assert ours.where("holding_type = 'CASH'").count() > 0


def test_snapshot_without_positions_keeps_cash(spark, rows):
    none = positions(spark).limit(0)
    flows = cash(spark, (1, "X", 2, 5, "CASH"), (1, "X", 3, -5, "CASH"))
    got = H.portfolio_snapshot(dates(spark, 2), none, prices(spark, ("A", 1, 1)), flows)
    assert rows(got, "snapshot_date", "ticker", "quantity") == [(None, "CASH", Decimal("5.0000"))]
    dated = H.portfolio_snapshot(
        dates(spark, 2), none, prices(spark, ("A", 1, 1)), flows, date_cash=True
    )
    assert rows(dated, "snapshot_date", "ticker") == [(D[2], "CASH")]


def test_missing_price_is_one_in_price_and_zero_in_value(spark):
    row = H.portfolio_snapshot(
        dates(spark, 2), positions(spark, (1, "X", "A", 3, 30)), prices(spark, ("A", 9, 5)), cash(spark).limit(0)
    ).first()
    assert (row.market_price, row.market_value, row.unrealized_gain_loss) == (1, 0, -30)
    assert row.unrealized_gain_loss_pct == -100


def test_two_cash_tickers_double_the_position(spark):
    flows = cash(spark, (1, "X", 2, 5, "CASH"), (1, "X", 2, 6, "USD"))
    got = H.portfolio_snapshot(
        dates(spark, 2), positions(spark, (1, "X", "A", 3, 30)), prices(spark, ("A", 1, 5)), flows
    )
    assert [row.holding_type for row in got.collect()] == ["SECURITY", "SECURITY"]


def test_percentage_is_not_rounded_twice(spark):
    row = H.portfolio_snapshot(
        dates(spark, 2), positions(spark, (1, "X", "A", 18, "94813.43")),
        prices(spark, ("A", 1, "5365.65")), cash(spark).limit(0),
    ).first()
    assert row.unrealized_gain_loss_pct == Decimal("1.8600")


def history(spark, *found):
    return H.portfolio_snapshot(
        dates(spark, 2), positions(spark, *found), prices(spark, ("A", 1, 5)), cash(spark).limit(0)
    )


def test_current_holdings(spark, rows):
    """Newer cash, a negative newest day, and a tie on the newest day."""
    old = history(spark, (1, "X", "A", 3, 30)).withColumn("snapshot_date", F.lit(D[1]))
    new = history(spark, (1, "X", "A", 4, 40), (2, "X", "A", 1, 10))
    shown = new.where("customer_id = 2").withColumns(
        {"holding_type": F.lit("CASH"), "ticker": F.lit("CASH"), "quantity": F.lit(7).cast("decimal(18,4)")}
    )
    flows = cash(
        spark, (1, "X", 1, 9, "CASH"), (1, "X", 3, -4, "CASH"), (2, "X", 5, 11, "CASH"),
        (3, "X", 1, 8, "CASH"), (4, "X", 6, 2, "B"), (4, "X", 6, 1, "A"),
    )
    got = H.current_holdings(old.unionByName(new).unionByName(shown), flows, NOW)
    assert rows(got, "customer_id", "ticker", "snapshot_date", "quantity", "last_transaction_date") == [
        (1, "A", D[2], Decimal("4.0000"), D[2]),
        (2, "A", D[2], Decimal("1.0000"), D[2]),
        (2, "CASH", D[2], Decimal("11.0000"), D[2]),
        (3, "CASH", D[2], Decimal("8.0000"), D[1]),
        (4, "CASH", D[2], Decimal("1.0000"), D[6]),
    ]


def test_rewriting_a_snapshot_replaces_its_dates(spark, tmp_path):
    path = str(tmp_path / "history")
    first = history(spark, (1, "X", "A", 3, 30), (2, "X", "A", 3, 30))
    H.write_snapshot(first.withColumn("snapshot_date", F.lit(D[1])), path, NOW)
    H.write_snapshot(first, path, NOW)
    stored = H.write_snapshot(history(spark, (1, "X", "A", 9, 30)), path, NOW + dt.timedelta(hours=1))
    counts = {row[0]: row[1] for row in stored.groupBy("snapshot_date").count().collect()}
    assert counts == {D[1]: 2, D[2]: 1}
    made = {row.snapshot_date: row.processed_timestamp for row in stored.collect()}
    assert made == {D[1]: NOW, D[2]: NOW + dt.timedelta(hours=1)}


def test_newest_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "history")
    H.write_snapshot(history(spark, (1, "X", "A", 3, 30)), path, NOW)
    from holdfast.operators import newest

    plan = newest(spark.read.parquet(path), "snapshot_date")._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters: [isnotnull(snapshot_date" in line)
    assert "Subquery" in scan.split("PartitionFilters:")[1].split("]")[0]


def test_snapshot_dates_meet_as_timestamps(spark, rows):
    trades = spark.createDataFrame([(D[1],), (D[1],), (D[2],)], "transaction_date date")
    flows = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 3, 4),)], "transaction_date timestamp_ntz"
    )
    got = C.snapshot_dates(trades, flows)
    assert rows(got) == [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 3, 4),)]


def instants(spark, seed, tickers, count):
    """Prices and probes within some days, many on the same second, and the answers of a scan through them."""
    rng = random.Random(seed)

    def at():
        return dt.datetime(2024, 1, rng.randrange(1, 9), rng.randrange(24), rng.randrange(0, 60, 10), 0, rng.choice([0, 0, 5]))

    found = [(rng.choice(tickers), at(), money(rng.randrange(1, 99)) if rng.random() < 0.9 else None) for _ in range(count)]
    probes = [(rng.choice(tickers), at()) for _ in range(count)]
    expected = {}
    for ticker, when in set(probes):
        closes = [(time, close) for name, time, close in found if name == ticker and time <= when]
        last = max((time for time, _ in closes), default=None)
        values = [close for time, close in closes if time == last and close is not None]
        expected[ticker, when] = max(values) if values else None
    frames = (
        spark.createDataFrame(probes, "ticker string, as_of timestamp_ntz"),
        spark.createDataFrame(found, "ticker string, price_time timestamp_ntz, close_price decimal(10,2)"),
    )
    return *frames, expected


@pytest.mark.parametrize("width", [3600, 24 * 3600, 30 * 24 * 3600])
def test_prices_at_instants(spark, width):
    probes, found, expected = instants(spark, 4, ["hot"] * 20 + ["a", "b"], 400)
    got = {(row.ticker, row.as_of): row.latest_price for row in asof_instants(probes, found, width).collect()}
    assert got == expected
    assert asof_instants(probes.limit(0), found).collect() == []


def test_a_ticker_with_many_instants_is_several_tasks(spark):
    """One ticker, eight days: its instants are dealt by ticker and range."""
    probes, found, _ = instants(spark, 5, ["hot"], 3000)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        answered = asof_instants(probes, found, 3600)
        plan = answered._jdf.queryExecution().executedPlan().toString()
        tasks = answered.select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "hashpartitioning(ticker" in plan and tasks > 4


def test_weekly_schedule(spark):
    people = spark.createDataFrame(
        [(1, dt.date(2024, 1, 3), dt.date(2024, 1, 17), Decimal("52000.00")),
         (2, dt.date(2024, 3, 1), dt.date(2050, 1, 1), Decimal("1.00"))],
        "customer_id bigint, start_date date, retirement_date date, salary decimal(38,2)",
    )
    got = [(row.transaction_date.day, row.amount, row.transaction_category)
           for row in weekly_schedule(people, D[31]).orderBy("transaction_date").collect()]
    assert got == [
        (3, Decimal("20.00"), "Deposit"), (10, Decimal("20.00"), "Deposit"),
        (17, Decimal("-40.00"), "Withdrawal"), (24, Decimal("-40.00"), "Withdrawal"),
        (31, Decimal("-40.00"), "Withdrawal"),
    ]


def test_few_days_are_written_without_a_shuffle_or_sort(spark, tmp_path, rows):
    frame = spark.range(40).selectExpr(
        "CAST(IF(id % 5 = 4, NULL, DATE'2024-01-01' + CAST(id % 5 AS int)) AS date) AS snapshot_date", "id AS quantity"
    )
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    plain = H.write_snapshot(frame, f"{tmp_path}/plain", NOW)
    assert rows(H.write_snapshot(frame, f"{tmp_path}/few", NOW, few_days=True)) == rows(plain)
    again = H.write_snapshot(frame.where("snapshot_date = DATE'2024-01-02'"), f"{tmp_path}/few", NOW, few_days=True)
    assert rows(again) == rows(plain)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = sorted(str(file) for file in (tmp_path / "few").glob("snapshot_date=*/*.parquet"))
    # Every task wrote its own rows; rebalanced ones would be gathered in one.
    assert len({file.split("/")[-1].split("-")[1] for file in files}) > 1
