"""The registered queries: each operator over the whole panel that a set of order-line tables holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import ID_COLUMNS, FeatureConfig, ForestConfig
from shelfcast.functions import columns as col_of
from shelfcast.operators import calendar as calendars
from shelfcast.operators import prices as price_ops
from shelfcast.operators import split, summaries
from shelfcast.operators.history import history_long, history_rows, history_wide
from shelfcast.operators.reshape import day_columns, union_by_name, unpivot_sales
from shelfcast.plans.features import assemble, complete_rows, required_columns
from shelfcast.plans.forest import (
    category_counts,
    category_indexer,
    fit_and_score,
    forecast,
    label_counts,
    vector_assembler,
    vector_inputs,
)
from shelfcast.plans.reports import stage_listing, stage_time_rollup
from shelfcast.sources.order_lines import OrderLinePanel
from shelfcast.sources.raw_panel import CALENDAR_FILE, PRICES_FILE, SALES_FILE, read_raw_panel, read_raw_sales
from shelfcast.sources.saved import (
    BY_DAY,
    load_model,
    read_features,
    read_predictions,
    save_model,
    scratch_path,
    write_features,
    write_predictions,
)

CONFIG = FeatureConfig()
RECENT = FeatureConfig(limit_days=128)
HORIZON = FeatureConfig(limit_days=28)
#: Some days by themselves, some in a row, one before any history is complete.
CHOSEN_DAYS = (5, 29, 30, 31, 365, 366, 900, 1001, 1002, 1003, 1004, 1800, 2200, 2201, 2499)
QUARTER = FeatureConfig(lags=(), rolling_windows=(90,))
STORED = FeatureConfig(auto_partitions=True)
HISTORY = ["id", "d", "day_number", "sales", *CONFIG.history_columns]

Query = Callable[[SparkSession, str], DataFrame]


def features_of(panel: OrderLinePanel, config: FeatureConfig = CONFIG) -> DataFrame:
    return assemble(
        panel.packed(config), panel.calendar(), panel.prices(), config,
        unique_prices=True,
    )


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    write_features(features_of(OrderLinePanel(spark, sf_dir), STORED), path, STORED, laid_out=True)
    return read_features(spark, path)


def _stored_raw(spark: SparkSession, panel: OrderLinePanel, *frames: str) -> str:
    """The panel written in its raw CSV form; returns the folder."""
    folder = scratch_path(spark, "raw")
    makers = {SALES_FILE: panel.wide, CALENDAR_FILE: panel.calendar, PRICES_FILE: panel.prices}
    for name in frames or makers:
        makers[name]().write.csv(f"{folder}/{name}", header=True)
    return folder


def _raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide panel as a file, which is how wide panels come."""
    folder = _stored_raw(spark, OrderLinePanel(spark, sf_dir), SALES_FILE)
    return read_raw_sales(spark, folder, day_type="double")


def _numbered_calendar(panel: OrderLinePanel) -> DataFrame:
    return calendars.numbered_days(calendars.calendar_features(panel.calendar()))


def _recent_calendar(panel: OrderLinePanel) -> DataFrame:
    day = F.col("day_number")
    return _numbered_calendar(panel).where(day > panel.last_day() - RECENT.limit_days)


# --- sources and sinks ---


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the panel in its raw CSV form, read it back, join its three files."""
    folder = _stored_raw(spark, OrderLinePanel(spark, sf_dir))
    sales, calendar, prices = read_raw_panel(spark, folder, day_type="double")
    rows = unpivot_sales(sales).join(calendar.select("d", "wm_yr_wk"), "d")
    return price_ops.join_prices(rows, prices).select("id", "d", "sales", "wm_yr_wk", "sell_price")


def feature_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_features(spark, sf_dir).select(
        "id", "d", "sales", "lag_28", "rolling_mean_28", "snap", "sell_price"
    )


def prediction_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four-week lag taken as forecast, written as predictions and read back."""
    panel = OrderLinePanel(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    recent = split.scoring_window(features_of(panel, HORIZON), 28, panel.last_day())
    write_predictions(recent.withColumn("prediction", F.col("lag_28")), path)
    return read_predictions(spark, path)


# --- projections, filters, nulls ---


def panel_recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 128 days, each with history from all days before it."""
    packed = OrderLinePanel(spark, sf_dir).packed(RECENT)
    return history_rows(packed, RECENT).select(*HISTORY)


def calendar_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.calendar_features(OrderLinePanel(spark, sf_dir).calendar())


def item_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines per item with the item's hash bucket."""
    lines = OrderLinePanel(spark, sf_dir).lines()
    counted = lines.groupBy(F.col("p_brand").alias("item_id")).agg(F.count("*").alias("lines"))
    return counted.select("item_id", "lines", col_of.item_bucket(F.col("item_id")).alias("item_hash"))


def day_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = OrderLinePanel(spark, sf_dir).calendar()
    return calendar.select("d", col_of.day_number(F.col("d")).alias("day_number"))


def clamp_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A naive trend forecast, which falls below 0 and is null in the first days."""
    history = _history(spark, sf_dir)
    trend = F.col("lag_7") * 2 - F.col("lag_14")
    return history.select("id", "day_number", col_of.non_negative(trend).alias("prediction"))


def complete_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left of the whole joined panel once those with a missing input are dropped."""
    panel = OrderLinePanel(spark, sf_dir)
    rows = calendars.join_calendar(history_rows(panel.packed(), CONFIG), _numbered_calendar(panel))
    priced = price_ops.fill_missing(price_ops.join_prices(rows, panel.prices()))
    hashed = priced.withColumn("item_hash", col_of.item_bucket(F.col("item_id")))
    complete = complete_rows(hashed, required_columns(CONFIG))
    return complete.select("id", "day_number", "lag_28", "rolling_mean_28")


def split_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = OrderLinePanel(spark, sf_dir)
    labelled = split.with_split_label(panel.long(), CONFIG.validation_days, panel.last_day())
    return labelled.select("id", "day_number", "sales", "split")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, days and sales of the two parts of a split."""
    panel = OrderLinePanel(spark, sf_dir)
    labelled = split.with_split_label(panel.long(), CONFIG.validation_days, panel.last_day())
    return labelled.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.min("day_number").alias("first_day"),
        F.max("day_number").alias("last_day"),
        F.sum("sales").alias("sales"),
    )


def score_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = OrderLinePanel(spark, sf_dir)
    history = history_rows(panel.packed(HORIZON), HORIZON)
    recent = split.scoring_window(history, 28, panel.last_day())
    return recent.select("id", "d", "day_number", "sales", "lag_28")


# --- reshape and history ---


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_rows(OrderLinePanel(spark, sf_dir).packed(), CONFIG)


def panel_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_sales(_raw_sales(spark, sf_dir)).select(*ID_COLUMNS, "d", "sales")


def panel_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide panel unpivoted in four pieces of days, which are united by name."""
    wide = _raw_sales(spark, sf_dir)
    days = day_columns(wide.columns)
    size = -(-len(days) // 4)
    pieces = [unpivot_sales(wide, days[at : at + size]) for at in range(0, len(days), size)]
    reordered = [piece.select("sales", "d", *ID_COLUMNS) if n % 2 else piece
                 for n, piece in enumerate(pieces)]
    return union_by_name(reordered).select("id", "d", "sales")


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).select("id", "day_number", "lag_7", "lag_14", "lag_28")


def trailing_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).select("id", "day_number", "rolling_mean_7", "rolling_mean_28")


def trailing_mean_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of more days than are unrolled."""
    history = history_rows(OrderLinePanel(spark, sf_dir).packed(QUARTER), QUARTER)
    return history.select("id", "day_number", F.round("rolling_mean_90", 6).alias("rolling_mean_90"))


def history_wide_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_wide(_raw_sales(spark, sf_dir), CONFIG).select(*HISTORY)


def history_long_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_long(OrderLinePanel(spark, sf_dir).long(), CONFIG).select(*HISTORY)


# --- joins ---


def price_week_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = OrderLinePanel(spark, sf_dir)
    weeks = calendars.selected_weeks(_recent_calendar(panel))
    pruned = price_ops.prune_prices(panel.prices(), weeks)
    return pruned.select("store_id", "item_id", "wm_yr_wk", "sell_price")


def panel_calendar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = OrderLinePanel(spark, sf_dir)
    rows = calendars.join_calendar(panel.long(), _numbered_calendar(panel))
    return rows.select("id", "d", "wm_yr_wk", "wday", "month", "year", "snap")


def panel_price_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level price join, the form that also serves repeated price keys."""
    panel = OrderLinePanel(spark, sf_dir)
    rows = calendars.join_calendar(panel.long(), _numbered_calendar(panel))
    priced = price_ops.join_prices(rows, panel.prices())
    return price_ops.fill_missing(priced).select("id", "day_number", "wm_yr_wk", "sell_price")


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_of(OrderLinePanel(spark, sf_dir))


def feature_table_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of the last 128 days, with prices pruned to their weeks."""
    return features_of(OrderLinePanel(spark, sf_dir), RECENT)


def feature_table_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the chosen days by day, of which some are written again over what is there of them."""
    path = scratch_path(spark, "features-by-day")
    for days in (CHOSEN_DAYS, CHOSEN_DAYS[1::3]):
        config = FeatureConfig(days=days, partition_by=BY_DAY)
        write_features(features_of(OrderLinePanel(spark, sf_dir), config), path, config, laid_out=True)
    return read_features(spark, path).select(*CONFIG.table_columns)


def feature_table_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of the last 128 days with two prices in each even week: every row of such a week comes twice."""
    panel = OrderLinePanel(spark, sf_dir)
    prices = panel.prices()
    even = prices.where(F.col("wm_yr_wk") % 2 == 0).withColumn("sell_price", F.col("sell_price") * 2)
    return assemble(panel.packed(RECENT), panel.calendar(), prices.unionByName(even), RECENT)


# --- aggregations ---


def max_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.last_day(OrderLinePanel(spark, sf_dir).lines())


def selected_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.selected_weeks(_recent_calendar(OrderLinePanel(spark, sf_dir)))


def regression_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the four-week lag as forecast, over all days."""
    scores = summaries.regression_scores(_history(spark, sf_dir), "sales", "lag_28")
    return scores.select(F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


def scan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.row_count(feature_table(spark, sf_dir))


def group_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = summaries.group_profile(feature_table(spark, sf_dir))
    return profile.withColumn("avg_sales", F.round("avg_sales", 6))


def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.group_count(feature_table(spark, sf_dir))


def stage_time_rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = stage_time_rollup(OrderLinePanel(spark, sf_dir).run_reports())
    rounded = (F.round(c, 4).alias(c) for c in totals.columns if c != "run_id")
    return totals.select("run_id", *rounded)


def stage_listing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of every run with their last report."""
    listed = stage_listing(OrderLinePanel(spark, sf_dir).run_reports())
    return listed.select("run_id", "place", "stage", "duration_seconds")


# --- learning and scoring ---


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label of each category with its rows and index, learned from the feature table."""
    found = label_counts(category_counts(feature_table(spark, sf_dir)))
    return found.select("category", "label", "index", "rows")


def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled vector of each row, spelled out by position."""
    from pyspark.ml.functions import vector_to_array

    features = feature_table(spark, sf_dir)
    indexed = category_indexer(features).transform(features)
    vectors = vector_assembler(CONFIG).transform(indexed)
    entries = vector_to_array("features")

    def entry(position: int, name: str) -> Column:
        return entries[position].alias(f"v_{name}")

    return vectors.select("id", "d", *(entry(n, c) for n, c in enumerate(vector_inputs(CONFIG))))


def _fitted(spark: SparkSession, sf_dir: str):
    """Features, their last day, the forest and its scores; one fit serves all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITS:
        features = _stored_features(spark, sf_dir)
        last = split.last_day_value(features)
        _FITS[key] = (features, last, *fit_and_score(features, last, CONFIG, ForestConfig()))
    return _FITS[key]


def forest_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, and score the last 28 days."""
    features, last, model, _ = _fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_model(model, path)
    return forecast(load_model(spark, path), split.scoring_window(features, 28, last))


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE and MAE of the forest on the held-out days."""
    features, last, model, _ = _fitted(spark, sf_dir)
    _, validation = split.split_by_time(features, CONFIG.validation_days, last)
    return summaries.regression_scores(model.transform(validation), "sales", "prediction").select("rmse", "mae")


def forest_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of the last 28 days by two forests, and whether they are equal row by row.

    The second learns from the same rows in another layout: other files, other order, other tasks.
    """
    features, last, model, _ = _fitted(spark, sf_dir)
    path = scratch_path(spark, "shuffled")
    features.repartition(7, "sales").sortWithinPartitions(F.desc("day_number")).write.parquet(path)
    other, _ = fit_and_score(read_features(spark, path), last, CONFIG, ForestConfig())
    rows = split.scoring_window(features, 28, last)
    first, second = (forecast(m, rows).withColumnRenamed("prediction", n) for m, n in ((model, "a"), (other, "b")))
    return first.join(second, ["id", "d"]).select("id", "d", F.col("a").eqNullSafe(F.col("b")).alias("equal"))


def forest_forecast_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each forecast of a loaded model lies between 0 and the largest, and the smallest, training sales.

    A forest predicts means of training values, so what its splits are does not matter here.
    """
    features, last, model, _ = _fitted(spark, sf_dir)
    training, _ = split.split_by_time(features, CONFIG.validation_days, last)
    least, most = training.agg(F.min("sales"), F.max("sales")).first()
    path = scratch_path(spark, "model")
    save_model(model, path)
    rows = forecast(load_model(spark, path), split.scoring_window(features, 28, last))
    inside = F.col("prediction").between(max(least, 0.0), most)
    return rows.select("id", "d", F.coalesce(inside, F.lit(False)).alias("inside"))


def forest_fit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows fitted on and held out, the held-out RMSE of the training mean, and whether the forest has a smaller one."""
    features, last, _, scores = _fitted(spark, sf_dir)
    training, validation = split.split_by_time(features, CONFIG.validation_days, last)
    mean, rows = training.agg(F.avg("sales"), F.count("*")).first()
    scored = validation.agg(
        F.lit(rows).cast("long").alias("training_rows"),
        F.count("*").alias("validation_rows"),
        F.round(F.sqrt(F.avg(F.pow(F.col("sales") - mean, F.lit(2)))), 4).alias("mean_rmse"),
    )
    return scored.withColumn("forest_better", F.lit(scores["rmse"]) < F.col("mean_rmse"))


_FITS: dict[tuple[str, str], tuple] = {}

QUERIES: dict[str, Query] = {
    "csv_round_trip": csv_round_trip,
    "feature_round_trip": feature_round_trip,
    "prediction_round_trip": prediction_round_trip,
    "panel_recent_days": panel_recent_days,
    "calendar_snap": calendar_snap,
    "item_bucket": item_bucket,
    "day_number_parse": day_number_parse,
    "clamp_predictions": clamp_predictions,
    "complete_rows": complete_rows_query,
    "split_label": split_label,
    "split_sizes": split_sizes,
    "score_window": score_window,
    "panel_unpivot": panel_unpivot,
    "panel_union": panel_union,
    "lag_features": lag_features,
    "trailing_means": trailing_means,
    "trailing_mean_quarter": trailing_mean_quarter,
    "history_wide": history_wide_query,
    "history_long": history_long_query,
    "price_week_prune": price_week_prune,
    "panel_calendar_join": panel_calendar_join,
    "panel_price_join": panel_price_join,
    "feature_table": feature_table,
    "feature_table_recent": feature_table_recent,
    "feature_table_days": feature_table_days,
    "feature_table_repeated": feature_table_repeated,
    "max_day": max_day,
    "selected_weeks": selected_weeks,
    "regression_scores": regression_scores,
    "scan_rows": scan_rows,
    "group_profile": group_profile,
    "group_count": group_count,
    "stage_time_rollup": stage_time_rollup_query,
    "stage_listing": stage_listing_query,
    "category_index": category_index,
    "feature_vector": feature_vector,
    "forest_forecast": forest_forecast,
    "forest_scores": forest_scores,
    "forest_stable": forest_stable,
    "forest_forecast_bounds": forest_forecast_bounds,
    "forest_fit_rows": forest_fit_rows,
}
