"""Latest price at or before a date or an instant."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_prices(probes: DataFrame, prices: DataFrame) -> DataFrame:
    """Attach to each distinct (ticker, as_of) the close price in force on that day.

    `probes` has columns ticker and as_of, `prices` has ticker, price_date and
    close_price.  `latest_price` is NULL where no price is old enough.

    Prices and probes are stacked and reduced to one row per ticker and day, in one
    aggregate that combines before the shuffle.  The last price is then carried
    forward along the days of each ticker: one sort, no pairs of rows.  A ticker's
    window holds at most one row per calendar day, however often the ticker is
    traded.  Several closes on one day count as the greatest of them.
    """
    closes = prices.select(
        "ticker",
        F.col("price_date").cast("date").alias("as_of"),
        "close_price",
        F.lit(False).alias("asked"),
    )
    asked = probes.select(
        "ticker",
        F.col("as_of").cast("date").alias("as_of"),
        F.lit(None).cast(prices.schema["close_price"].dataType).alias("close_price"),
        F.lit(True).alias("asked"),
    )
    days = (
        closes.unionByName(asked)
        .groupBy("ticker", "as_of")
        .agg(
            F.max("close_price").alias("close_price"),
            F.max("asked").alias("asked"),
            (~F.min("asked")).alias("priced"),
        )
    )
    along = (
        Window.partitionBy("ticker")
        .orderBy("as_of")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # The struct keeps a NULL close apart from "no price yet".
    close = F.when(F.col("priced"), F.struct("close_price"))
    return (
        days.withColumn("close", F.last(close, ignorenulls=True).over(along))
        .where("asked")
        .select("ticker", "as_of", F.col("close.close_price").alias("latest_price"))
    )


DAY_SECONDS = 24 * 60 * 60


def _seconds(name: str) -> Column:
    """Whole seconds of a timestamp without zone, whatever the session's zone."""
    days = F.date_diff(F.col(name).cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * DAY_SECONDS + F.hour(name) * 3600 + F.minute(name) * 60 + F.second(name)


def asof_instants(probes: DataFrame, prices: DataFrame, width: int = DAY_SECONDS) -> DataFrame:
    """Attach to each distinct (ticker, as_of) the price in force at that instant.

    `probes` has ticker and as_of, `prices` has ticker, price_time and close_price; times are
    timestamps without zone.  `latest_price` is NULL where no price is old enough.  A price of the very instant
    counts; several of one instant count as the greatest of them.

    Time is cut into ranges of `width` seconds.  Prices are carried forward inside a range of a ticker, and
    the last price of each range into the ranges after it, of which there is one row each.  So a ticker
    with any number of instants is as many tasks as it has ranges, and no window holds more than one range.
    """
    kind = prices.schema["close_price"].dataType
    closes = prices.select("ticker", F.col("price_time").alias("as_of"), "close_price", F.lit(False).alias("asked"))
    asked = probes.select("ticker", "as_of", F.lit(None).cast(kind).alias("close_price"), F.lit(True).alias("asked"))
    instants = (
        closes.unionByName(asked)
        .withColumn("range", F.floor(_seconds("as_of") / width))
        .groupBy("ticker", "range", "as_of")
        .agg(F.max("close_price").alias("close_price"), F.max("asked").alias("asked"), (~F.min("asked")).alias("priced"))
        # The struct keeps a NULL close apart from "no price yet".
        .withColumn("close", F.when(F.col("priced"), F.struct("close_price")))
    )
    in_range = Window.partitionBy("ticker", "range").orderBy("as_of")
    before = Window.partitionBy("ticker").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    last = instants.groupBy("ticker", "range").agg(F.max_by("close", F.when(F.col("priced"), F.col("as_of"))).alias("last"))
    carried = last.select("ticker", "range", F.last("last", ignorenulls=True).over(before).alias("carried"))
    here = F.last("close", ignorenulls=True).over(in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        instants.withColumn("here", here)
        .where("asked")
        .join(carried, ["ticker", "range"])
        .select("ticker", "as_of", F.coalesce("here", "carried")["close_price"].alias("latest_price"))
    )
