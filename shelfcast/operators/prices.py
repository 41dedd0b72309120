"""Weekly prices per store and item."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import PRICE_KEYS
from shelfcast.operators.packed import PackedPanel, gather_dense

_SERIES_KEYS = ["store_id", "item_id"]
FOLDED = "_price_by_week"
WEEK = "_week"
#: Prices of one (store, item, week) that an array may hold; more are joined row by row.
MOST_COPIES = 1_000


def prune_prices(prices: DataFrame, weeks: DataFrame) -> DataFrame:
    """Prices of the given distinct weeks."""
    return prices.join(weeks, "wm_yr_wk", "left_semi")


def most_copies(prices: DataFrame) -> int:
    """How many prices a (store, item, week) has at most; one aggregation, one row to the driver."""
    return prices.groupBy(*PRICE_KEYS).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def join_prices(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on (store, item, week); repeated price keys repeat the panel row."""
    priced = prices.select(*PRICE_KEYS, F.col("sell_price").cast("double").alias("sell_price"))
    return panel.join(priced, list(PRICE_KEYS), "left")


def weeks_in_order(calendar: DataFrame) -> DataFrame:
    """One row with the distinct weeks of a calendar in order, as ``weeks``."""
    return calendar.agg(F.sort_array(F.collect_set("wm_yr_wk")).alias("weeks"))


def number_weeks(calendar: DataFrame) -> DataFrame:
    """Adds the place of each row's week among all weeks, 0 for a row without a week; no window, no sort of rows."""
    place = F.array_position(weeks_in_order(calendar).scalar(), F.col("wm_yr_wk"))
    return calendar.withColumn(WEEK, F.coalesce(place, F.lit(0)).cast("int"))


def dated_weeks(calendar: DataFrame) -> Column:
    """The days of a numbered calendar with their weeks, an array of (day_number, week place) for any frame.

    Read by a scalar subquery, so that the week of a day is known where the day is generated. A day in several weeks
    is there with each of them.
    """
    return calendar.agg(F.sort_array(F.collect_set(F.struct("day_number", WEEK)))).scalar()


def fold_prices(panel: PackedPanel, prices: DataFrame, calendar: DataFrame, repeated: bool = False) -> PackedPanel:
    """Join prices to packed series.

    All prices of a (store, item) become one array over the weeks of the calendar; the long rows then read their
    price by position. If keys are ``repeated``, its entries are arrays of all prices of the week. Only packed
    series and prices are shuffled, never the long rows. Without ``repeated`` a second price of a week raises.
    """
    places = weeks_in_order(calendar).select(F.posexplode("weeks").alias(WEEK, "wm_yr_wk"))
    priced = prices.join(places, "wm_yr_wk").select(
        *_SERIES_KEYS, (F.col(WEEK) + 1).alias(WEEK), F.col("sell_price").cast("double").alias("sell_price")
    )
    kind = "double"
    if repeated:
        # dealt by series first, so that both groupings go without a further exchange
        copies = F.collect_list(F.struct("sell_price"))  # a struct, as a list leaves nulls out
        by_week = priced.repartition(*_SERIES_KEYS).groupBy(*_SERIES_KEYS, WEEK).agg(copies.alias("copies"))
        priced = by_week.withColumn("sell_price", F.transform("copies", lambda copy: copy["sell_price"]))
        kind = "array<double>"
    folded = gather_dense(priced, _SERIES_KEYS, F.col(WEEK), F.col("sell_price"), FOLDED, kind=kind)
    return replace(panel, frame=panel.frame.join(folded, _SERIES_KEYS, "left"))


def look_up_price(panel: DataFrame, repeated: bool = False) -> DataFrame:
    """Replace the folded prices by the price of the row's week, null if there is none.

    With ``repeated`` prices each of them repeats the row.
    """
    price = F.get(F.col(FOLDED), F.col(WEEK) - 1)
    return panel.select(*(c for c in panel.columns if c != FOLDED), (F.explode_outer(price) if repeated else price).alias("sell_price"))


def fill_missing(panel: DataFrame) -> DataFrame:
    """A missing price is 0.0 and a missing snap flag 0."""
    return panel.fillna({"sell_price": 0.0, "snap": 0})
