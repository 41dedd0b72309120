"""A retail panel from the order lines of a star schema.

A series is a brand sold in a nation; its sales of a day are the quantities shipped on that day. Day 1
is the first ship date of the table, the last day its last one, and a day without shipment sold 0.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import ID_COLUMNS, FeatureConfig
from shelfcast.functions.columns import day_label
from shelfcast.operators.history import history_rows
from shelfcast.operators.packed import PackedPanel, pack_long
from shelfcast.sources.saved import scratch_path

_SERIES = ["p_brand", "s_nationkey"]


class OrderLinePanel:
    """Panel, calendar and prices of the tables in a directory, all of them lazy."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self._spark = spark
        self._directory = directory.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._daily: DataFrame | None = None

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._directory}/{name}.parquet")
        return self._tables[name]

    def bounds(self) -> DataFrame:
        """First and last ship date, one row."""
        shipped = F.col("l_shipdate").cast("date")
        return self._table("lineitem").agg(
            F.min(shipped).alias("first_date"), F.max(shipped).alias("last_date")
        )

    def first_date(self) -> Column:
        return self.bounds().select("first_date").scalar()

    def last_day(self) -> Column:
        days = F.date_diff("last_date", "first_date") + 1
        return self.bounds().select(days.alias("last_day")).scalar()

    def lines(self) -> DataFrame:
        """One row per order line: brand and nation of its series, its day, quantity, list price.

        Suppliers and parts grow with the data, so whether they are broadcast is left to their size, and
        a hot part or supplier to the skew handling of the shuffled join.
        """
        day = F.date_diff(F.col("l_shipdate").cast("date"), self.first_date()) + 1
        return (
            self._table("lineitem")
            .join(self._table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self._table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                *_SERIES,
                day.alias("day_number"),
                F.col("l_quantity").alias("sales"),
                "p_retailprice",
            )
        )

    def daily(self) -> DataFrame:
        """Sales and highest list price of each series and day.

        Order lines are joined and summed once; the result, at most one row for each series and day, is
        written to the scratch folder, and both the panel and the prices come from it.
        """
        if self._daily is None:
            path = scratch_path(self._spark, "daily")
            summed = self.lines().groupBy(*_SERIES, "day_number").agg(
                F.sum("sales").alias("sales"), F.max("p_retailprice").alias("price")
            )
            summed.write.parquet(path)
            self._daily = self._spark.read.schema(summed.schema).parquet(path)
        return self._daily

    def _with_names(self, frame: DataFrame) -> DataFrame:
        """Adds ``item_id, store_id, state_id``; called on aggregates, never on order lines."""
        nation, region = self._table("nation"), self._table("region")
        places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return frame.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
            *frame.columns,
            F.col("p_brand").alias("item_id"),
            F.col("n_name").alias("store_id"),
            F.col("r_name").alias("state_id"),
        )

    def packed(self, config: FeatureConfig = FeatureConfig()) -> PackedPanel:
        """The panel with one row per series.

        Lines are summed per series and day before anything is gathered, map-side first, so a series
        with a third of all lines still arrives as one number a day.
        """
        panel = pack_long(
            self.daily(), config, self.last_day(), attributes=_SERIES, key=_SERIES, fill=0.0
        )
        brand = F.regexp_extract("item_id", r"(\d+)", 1).cast("int")
        frame = self._with_names(panel.frame).select(
            F.concat_ws("_", "item_id", "store_id").alias("id"),
            "item_id",
            F.concat(F.lit("DEPT_"), brand % 7).alias("dept_id"),
            F.concat(F.lit("CAT_"), brand % 3).alias("cat_id"),
            "store_id",
            "state_id",
            "history",
        )
        return replace(panel, frame=frame)

    def long(self) -> DataFrame:
        """``(ids, d, sales, day_number)`` for every series and day."""
        return history_rows(self.packed(), FeatureConfig(lags=(), rolling_windows=()))

    def wide(self) -> DataFrame:
        """The panel with columns ``d_1 ... d_N``; their number is read from the table first."""
        last = self.bounds().select(F.date_diff("last_date", "first_date") + 1).first()[0]
        days = (f"history[{day - 1}] AS d_{day}" for day in range(1, last + 1))
        return self.packed().frame.selectExpr(*ID_COLUMNS, *days)

    def calendar(self) -> DataFrame:
        """One row per day from the first to the last ship date."""
        number, date = F.col("position") + 1, F.col("date")
        dates = self.bounds().select(
            F.posexplode(F.sequence("first_date", "last_date")).alias("position", "date")
        )
        day_of_month = F.dayofmonth(date)

        def flag(condition: Column) -> Column:
            return F.when(condition, 1).otherwise(0)

        return dates.select(
            day_label(number).alias("d"),
            _week(number).alias("wm_yr_wk"),
            (F.pmod(number - 1, F.lit(7)) + 1).alias("wday"),
            F.month(date).alias("month"),
            F.year(date).alias("year"),
            flag(day_of_month <= 5).alias("snap_CA"),
            flag(day_of_month.isin(10, 20)).alias("snap_TX"),
            flag(day_of_month % 15 == 0).alias("snap_WI"),
        )

    def prices(self) -> DataFrame:
        """The highest list price of the week for each store and item that sold in it."""
        weekly = (
            self.daily()
            .groupBy(*_SERIES, _week(F.col("day_number")).alias("wm_yr_wk"))
            .agg(F.max("price").alias("sell_price"))
        )
        return self._with_names(weekly).select("store_id", "item_id", "wm_yr_wk", "sell_price")

    def run_reports(self) -> DataFrame:
        """Events read as stage reports: a user is a run, an event a stage, its value the seconds."""
        # The stage each event type stands for.
        stage_of = {
            "view": "prepare", "click": "train", "purchase": "predict", "signup": "benchmark",
            "error": "other",
        }
        stage = F.col("event_type")
        for event, name in stage_of.items():
            stage = F.when(F.col("event_type") == event, name).otherwise(stage)
        return self._table("events").select(
            F.col("user_id").alias("run_id"),
            stage.alias("stage"),
            F.col("value").alias("duration_seconds"),
            F.col("ts").alias("created_at_utc"),
        )


def _week(day_number: Column) -> Column:
    return (F.floor((day_number - 1) / 7) + 1).cast("int")
