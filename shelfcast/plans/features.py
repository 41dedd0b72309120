"""The feature table: history, calendar and prices of every complete series-day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import FeatureConfig
from shelfcast.functions.columns import item_bucket
from shelfcast.operators.calendar import (
    calendar_features,
    join_calendar,
    numbered_days,
    selected_weeks,
)
from shelfcast.operators.history import history_rows
from shelfcast.operators.packed import (
    PackedPanel,
    lay_out_series,
    output_partitions,
    pack_long,
    pack_wide,
    spread_series,
)
from shelfcast.operators.prices import (
    FOLDED,
    MOST_COPIES,
    WEEK,
    dated_weeks,
    fill_missing,
    fold_prices,
    join_prices,
    look_up_price,
    most_copies,
    number_weeks,
    prune_prices,
)


def build_features(
    sales: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    *,
    unique_prices: bool = False,
) -> DataFrame:
    """Feature table of a wide panel with day columns ``d_1 ... d_N``.

    ``unique_prices`` says that each (store, item, week) has at most one price; without this claim one job over
    the prices finds out how many it has. Repeated ones repeat the row.
    """
    return assemble(pack_wide(sales, config), calendar, prices, config, unique_prices)


def build_features_from_long(
    sales: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    *,
    last_day: Column | int | None = None,
    fill: float | None = None,
    unique_prices: bool = False,
) -> DataFrame:
    """Feature table of long rows ``(ids, day_number, sales)``, unique per series and day."""
    panel = pack_long(sales, config, last_day, fill=fill)
    return assemble(panel, calendar, prices, config, unique_prices)


def assemble(
    panel: PackedPanel,
    calendar: DataFrame,
    prices: DataFrame,
    config: FeatureConfig,
    unique_prices: bool = False,
) -> DataFrame:
    """Join history, calendar and prices and keep the complete rows.

    Rows come out in the partitions that the files of ``config`` ask for, unless a price has so many copies that rows
    are joined to prices one by one.
    """
    panel = panel.after_warm_up(config.reach)
    days = number_weeks(numbered_days(calendar_features(calendar)).where(panel.covers(F.col("day_number"))))
    copies = 1 if unique_prices else most_copies(prices)
    if copies <= MOST_COPIES:
        # the week is known where a day is generated, so prices are read there and go no further
        priced, dated = fold_prices(panel, prices, days, repeated=copies > 1), dated_weeks(days)
        files = output_partitions(priced.frame.sparkSession, config)
        if files is None and not config.partition_by:
            priced = spread_series(priced)
        else:
            priced = lay_out_series(priced, config, files, dated, lambda entry: entry["day_number"])
        rows = look_up_price(history_rows(priced, config, [FOLDED], (dated, [WEEK])), repeated=copies > 1)
        rows = complete_rows(join_calendar(rows, days, ["day_number", WEEK]), _nullable(config))
    else:
        prices = prune_prices(prices, selected_weeks(days))
        rows = join_calendar(history_rows(spread_series(panel), config), days)
        rows = join_prices(complete_rows(rows, _nullable(config)), prices)
    hashed = fill_missing(rows).withColumn("item_hash", item_bucket(F.col("item_id")))
    return hashed.select(*config.table_columns)


def complete_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with neither null nor NaN in the given columns."""
    return rows.dropna(subset=list(columns))


def required_columns(config: FeatureConfig) -> list[str]:
    """What a row of the feature table must have: every model input and the sales."""
    return [*config.feature_columns, "sales"]


def _nullable(config: FeatureConfig) -> list[str]:
    """The required columns that can be missing at all; the others are filled or computed.

    Testing only these lets incomplete rows go before prices are looked up or joined.
    """
    return [c for c in required_columns(config) if c not in ("sell_price", "snap", "item_hash")]
