"""Holdings of any day from intervals.

A position is stored once for every state it was in, with the versions (batch ids) from which and up to
which it held.  A day is shown as the last batch that bore on it left it, so a day has a version, and
the positions to show on it are those whose interval holds that version.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types
from ..session import workspace
from ..sources.files import write_table
from .holdings import price_curves, snapshot_columns

INTERVALS = T.StructType(
    [*types.POSITIONS.fields, T.StructField("valid_from", T.LongType()), T.StructField("valid_to", T.LongType())]
)
ACCOUNT = ["customer_id", "account_type"]


def closed_intervals(held: DataFrame, changes: DataFrame, version: int) -> DataFrame:
    """The open rows of `held` that a batch with these changes ends."""
    ended = held.join(changes.select(*types.POSITION_KEY), list(types.POSITION_KEY), "left_semi")
    return ended.withColumn("valid_to", F.lit(version).cast("bigint")).select(*INTERVALS.fieldNames())


def in_force(version: Column, start: Column, end: Column) -> Column:
    """Whether a version lies in an interval; an end of NULL is still to come."""
    return (version >= start) & (end.isNull() | (version < end))


def _versions_below(days: DataFrame) -> Column:
    """One array: at place v, how many of `days` have a version below v, up to one beyond the greatest."""
    spark = days.sparkSession
    top = days.agg(F.max("version")).first()[0]
    counts = days.groupBy("version").agg(F.count("*").alias("days"))
    versions = spark.range((-1 if top is None else top) + 2).withColumnRenamed("id", "version")
    known = versions.join(counts, "version", "left").agg(
        F.array_sort(F.collect_list(F.struct("version", F.coalesce("days", F.lit(0)).alias("days")))).alias("known")
    )
    # Versions are batches; a running sum over their array, kept as (sum, sums so far).
    running = F.aggregate(
        "known",
        F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("sums")),
        lambda so_far, one: F.struct(
            (so_far["total"] + one["days"]).alias("total"), F.concat(so_far["sums"], F.array(so_far["total"])).alias("sums")
        ),
        lambda so_far: so_far["sums"],
    )
    return known.select(running).scalar()


def _stretches(own: Column) -> Column:
    """The places from `first` up to, and without, `last`: one stretch per row of cash, and the stretches between these.

    `own` is sorted by place.  A stretch is (start, stop, daily_net_cash, cash_date).
    """
    kind = "struct<start: int, stop: int, daily_net_cash: {}, cash_date: timestamp_ntz>"
    after = F.transform(F.concat(F.array(F.col("first") - 1), own["place"]), lambda place: place + 1)
    up_to = F.concat(own["place"], F.array("last"))
    kind = kind.format(types.CASH.simpleString())
    between = F.zip_with(
        after, up_to, lambda start, stop: F.struct(start, stop, F.lit(None).cast(types.CASH), F.lit(None).cast("timestamp_ntz")).cast(kind)
    )
    with_cash = F.transform(own, lambda row: F.struct(row["place"], row["place"] + 1, row["daily_net_cash"], row["cash_date"]).cast(kind))
    return F.concat(with_cash, F.filter(between, lambda one: one["start"] < one["stop"]))


def _units(value: Column, kind: T.DecimalType) -> Column:
    """A decimal as a whole number of its last digit."""
    return (value.cast(kind) * 10**kind.scale).cast("bigint")


def holdings_on_days(days: DataFrame, intervals: DataFrame, prices: DataFrame, cash: DataFrame, units: bool = False) -> DataFrame:
    """Snapshot rows of all given days, each as the batch of its version left it.

    `days` has a row (snapshot_date, version) per day, `intervals` the layout INTERVALS.  Rows are those of
    `portfolio_snapshot` with the cash of these days, over the positions of the day's version.  With `units`,
    quantity, cost_basis and market_value stand beside that as whole numbers of their last digit, and account_type
    as its place in `account_types`, which are far cheaper to add up and to group by (`totals_of_days`).

    Days are sorted by version in one array, of one entry per calendar day at most, so an interval's days are
    those from one place of it to another: the range join is two look-ups per interval, and nothing is shuffled above it.
    Accounts carry the cash of their days and tickers their price curve as arrays.  Rows of cash alone come in as
    intervals of one day.  Days are expanded last, from stretches of places, and what does
    not depend on the day is worked out before; so a row costs two look-ups by place and a product.
    Intervals are few beside the rows that they become, so they are dealt to a fixed number of tasks, as
    for the join with the accounts, and not to as many as their own size asks for.
    """
    tasks = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = days.select(F.col("snapshot_date").cast("date").alias("snapshot_date"), "version")
    by_date = F.array_sort(F.collect_list(F.struct("snapshot_date", "version")))
    by_version = F.array_sort(
        F.transform(by_date, lambda day, place: F.struct(day["version"].alias("version"), day["snapshot_date"].alias("snapshot_date"), place.alias("date_place")))
    )
    sorted_days = days.agg(by_version.alias("days"))
    placed = sorted_days.select(F.posexplode("days").alias("place", "day")).select("place", "day.version", "day.snapshot_date")
    flows = cash.select(
        *ACCOUNT, "daily_net_cash", F.col("transaction_date").alias("cash_date"), F.col("transaction_date").cast("date").alias("snapshot_date")
    ).join(placed, "snapshot_date")
    per_account = flows.groupBy(*ACCOUNT).agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("daily_net_cash").cast(types.CASH).alias("daily_net_cash"), "cash_date"))).alias("cash")
    )
    # Stored in the order of the dates; read, they are put into the order of the places.
    curves = write_table(
        price_curves(intervals.select("ticker").distinct(), days, prices), f"{workspace(intervals.sparkSession)}/curves"
    )
    curves = curves.withColumn("date_places", sorted_days.select("days.date_place").scalar()).select(
        "ticker", F.transform("date_places", lambda place: F.get("curve", place)).alias("curve")
    )
    whole_curve = F.transform("curve", lambda price: F.coalesce(_units(price, types.PRICE), F.lit(0).cast("bigint")))
    curves = curves.withColumn("whole_curve", whole_curve)

    def below(version: str) -> Column:
        return F.coalesce(F.get("below", F.col(version).cast("int")), F.lit(sorted_days.select(F.size("days")).scalar())).cast("int")

    own_cash = F.filter(
        F.coalesce("cash", F.array().cast(per_account.schema["cash"].dataType)),
        lambda row: (row["place"] >= F.col("first")) & (row["place"] < F.col("last")),
    )
    held = (
        intervals.repartition(tasks, *ACCOUNT)
        .withColumn("below", _versions_below(days))
        .withColumn("first", below("valid_from"))
        .withColumn("last", below("valid_to"))
        .drop("below")
        .where(F.col("first") < F.col("last"))
        .join(per_account, ACCOUNT, "left")
        .withColumn("own", own_cash)
        .withColumn("stretches", _stretches(F.col("own")))
        .join(curves, "ticker")
        .withColumnRenamed("ticker", "held_ticker")
    )

    accounts = intervals.select(*ACCOUNT, "valid_from", "valid_to").distinct().alias("a")
    alone = flows.alias("f").join(
        accounts,
        (F.col("f.customer_id") == F.col("a.customer_id"))
        & (F.col("f.account_type") == F.col("a.account_type"))
        & in_force(F.col("f.version"), F.col("a.valid_from"), F.col("a.valid_to")),
        "left_anti",
    )
    one_day = F.struct(
        F.col("place").alias("start"), (F.col("place") + 1).alias("stop"), F.col("daily_net_cash").cast(types.CASH).alias("daily_net_cash"), "cash_date"
    )
    needed = [
        *ACCOUNT, "held_ticker", "current_shares", "total_cost_basis", "average_cost_per_share", "last_trade_date", "curve", "whole_curve", "stretches",
    ]
    nothing = {name: F.lit(None).cast(held.schema[name].dataType) for name in needed if name not in (*ACCOUNT, "stretches")}
    cash_rows = alone.withColumns({**nothing, "stretches": F.array(one_day)}).select(*needed)

    shares, basis = F.col("current_shares"), F.col("total_cost_basis")
    # Whole shares, few enough that their value is a decimal of 18 digits at any price.
    few = F.when((shares == F.round(shares, 0)) & (F.abs(shares) < 10**8), shares.cast("bigint"))
    both = held.select(*needed).unionByName(cash_rows)
    if units:
        number = F.array_position(account_types(intervals, cash), F.col("account_type")).cast("int")
        both, needed = both.withColumn("account_number", number), [*needed, "account_number"]
    stretches = (
        both.withColumn("stretch", F.explode("stretches"))
        .select(*(name for name in needed if name != "stretches"), "stretch.*")
        .where(F.coalesce("current_shares", "daily_net_cash", F.lit(0)) > 0)
    )
    if units:
        stretches = stretches.withColumn("few_shares", few).withColumns(
            {
                "quantity_units": _units(F.when(F.col("held_ticker").isNotNull(), F.round(shares, 0)).otherwise(F.col("daily_net_cash")), types.SHARE),
                "cost_basis_units": _units(F.coalesce(basis, "daily_net_cash"), types.COST),
            }
        )
    rows = (
        stretches.withColumn("place", F.explode(F.sequence("start", F.col("stop") - 1)))
        .withColumn("snapshot_date", F.get(sorted_days.select("days.snapshot_date").scalar(), F.col("place")))
        .withColumn("latest_price", F.get("curve", F.col("place")))
    )
    if not units:
        return rows.select(*snapshot_columns())
    slow = F.round(F.when(F.col("held_ticker").isNotNull(), shares * F.coalesce("latest_price", F.lit(0).cast(types.PRICE))).otherwise(F.col("daily_net_cash")), 2)
    value = F.when(F.col("few_shares").isNotNull(), F.col("few_shares") * F.get("whole_curve", F.col("place"))).otherwise(_units(slow, types.COST))
    return rows.select(*snapshot_columns(), "account_number", "quantity_units", "cost_basis_units", value.alias("market_value_units"))


def account_types(intervals: DataFrame, cash: DataFrame) -> Column:
    """All account types, sorted, as one array; a result with a row per account type is larger."""
    found = intervals.select("account_type").union(cash.select("account_type"))
    return found.agg(F.array_sort(F.collect_set("account_type"))).scalar()


def totals_of_days(rows: DataFrame, account_types: Column) -> DataFrame:
    """Rows of `holdings_on_days`, made with `units`, summed per day, account type and kind.

    A row is hashed by numbers: texts as keys would cost as much as the rest of the row.
    """
    sums = {"quantity": types.SHARE, "cost_basis": types.COST, "market_value": types.COST}
    is_cash = F.col("holding_type") == "CASH"
    totals = rows.groupBy("snapshot_date", "account_number", is_cash.alias("is_cash")).agg(
        F.count("*").alias("rows"),
        *(exact_sum(f"{name}_units", kind).alias(name) for name, kind in sums.items()),
        F.max("last_transaction_date").alias("last_transaction_date"),
    )
    return totals.select(
        "snapshot_date",
        F.get(account_types, F.col("account_number") - 1).alias("account_type"),
        F.when(F.col("is_cash"), "CASH").otherwise("SECURITY").alias("holding_type"),
        "rows",
        *sums,
        "last_transaction_date",
    )


def exact_sum(units: str, kind: T.DecimalType) -> Column:
    """The sum of whole numbers of a decimal's last digit, as that decimal's sum.

    Their upper and lower halves are summed apart, as bigint, so no sum of less than 2^31 rows is too large.
    """
    low = F.sum(F.col(units).bitwiseAND(0xFFFFFFFF)).cast("decimal(20,0)")
    high = F.sum(F.shiftright(units, 32)).cast("decimal(20,0)")
    unit = F.lit(Decimal(1).scaleb(-kind.scale))
    return ((high * F.lit(Decimal(2**32)) + low).cast("decimal(30,0)") * unit).cast(f"decimal({kind.precision + 10},{kind.scale})")


def newest_day(days: DataFrame) -> DataFrame:
    """The last of the days, with its version."""
    return days.agg(F.max_by(F.struct("snapshot_date", "version"), "snapshot_date").alias("day")).where("day IS NOT NULL").select("day.*")
