"""The stages a user runs. They meet only through files, so each can be repeated by itself."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import FeatureConfig, ForestConfig
from shelfcast.operators.split import last_day_value, scoring_window
from shelfcast.operators.summaries import group_profile
from shelfcast.plans.features import build_features
from shelfcast.plans.forest import fit_and_score, forecast
from shelfcast.plans.reports import read_reports, reported, stage_time_rollup
from shelfcast.sources.raw_panel import read_raw_panel
from shelfcast.sources.saved import (
    BY_DAY,
    load_model,
    read_features,
    save_model,
    write_features,
    write_predictions,
)


def _day_of(day: int | str) -> int:
    """``7`` and ``'d_7'`` -> ``7``."""
    return int(day.removeprefix("d_")) if isinstance(day, str) else day


def prepare(
    spark: SparkSession,
    data_dir: str,
    features_dir: str,
    config: FeatureConfig = FeatureConfig(),
    *,
    days: Iterable[int | str] | None = None,
    day_type: str = "int",
    infer: bool = False,
    reports: str | None = None,
    run_id: str | None = None,
) -> None:
    """Raw CSV panel -> feature table as Parquet.

    With ``days`` (numbers, or labels such as ``d_7``) only the features of those days are built, and replace what a
    table with ``partition_by=("day_number",)`` has of them; a table of another layout is refused.
    ``day_type`` is the type of the day columns; ``infer`` leaves all types to Spark. With ``reports``, the path of a
    report table, this and every other stage adds its row there.
    """
    if days is not None:
        if config.partition_by != BY_DAY:
            raise ValueError(f"single days can only be replaced in a table with partition_by={BY_DAY}")
        config = replace(config, days=tuple(map(_day_of, days)), limit_days=None)
    details = {
        "inputs": {"data_dir": data_dir, "limit_days": config.limit_days, "days": config.days},
        "outputs": {"features_dir": features_dir},
    }
    with reported(spark, reports, run_id, "prepare", **details):
        raw = read_raw_panel(spark, data_dir, day_type=day_type, infer=infer)
        write_features(build_features(*raw, config), features_dir, config, laid_out=True)


def train(
    spark: SparkSession,
    features_dir: str,
    model_dir: str,
    config: FeatureConfig = FeatureConfig(),
    forest: ForestConfig = ForestConfig(),
    *,
    reports: str | None = None,
    run_id: str | None = None,
) -> dict[str, float]:
    """Fit, validate on the held-out days, save the model; returns ``rmse`` and ``mae``."""
    inputs = {"features_dir": features_dir, "max_depth": forest.max_depth, "num_trees": forest.num_trees}
    details = {"inputs": inputs, "outputs": {"model_dir": model_dir}}
    with reported(spark, reports, run_id, "train", **details) as metrics:
        features = read_features(spark, features_dir)
        model, scores = fit_and_score(features, last_day_value(features), config, forest)
        save_model(model, model_dir)
        metrics |= scores
    return scores


def predict(
    spark: SparkSession,
    features_dir: str,
    model_dir: str,
    output_dir: str,
    horizon: int = 28,
    *,
    reports: str | None = None,
    run_id: str | None = None,
) -> None:
    """Score the last ``horizon`` days of the features and write them as CSV."""
    details = {
        "inputs": {"features_dir": features_dir, "model_dir": model_dir, "horizon": horizon},
        "outputs": {"predictions_dir": output_dir},
    }
    with reported(spark, reports, run_id, "predict", **details):
        features = read_features(spark, features_dir)
        model = load_model(spark, model_dir)
        recent = scoring_window(features, horizon, last_day_value(features))
        write_predictions(forecast(model, recent), output_dir)


def profile_scan(
    spark: SparkSession, features_dir: str, *, reports: str | None = None, run_id: str | None = None
) -> dict[str, float]:
    """Time one full aggregation over the features.

    The profile is computed whole - its mean is not pruned away - and its rows are summed up on the way, so
    the features are read once. A task that is run again counts once.
    """
    with reported(spark, reports, run_id, "benchmark", inputs={"features_dir": features_dir}) as metrics:
        features = read_features(spark, features_dir)
        started = time.perf_counter()
        groups = group_profile(features).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("input_rows"),
            F.count("*").alias("aggregation_groups"), F.max("avg_sales").alias("largest_mean"),
        ).first()
        seconds = time.perf_counter() - started
        found = {
            "input_rows": groups["input_rows"],
            "aggregation_groups": groups["aggregation_groups"],
            "input_partitions": features.rdd.getNumPartitions(),
            "benchmark_duration_seconds": seconds,
        }
        metrics |= found
    return found


def run(
    spark: SparkSession,
    data_dir: str,
    work_dir: str,
    config: FeatureConfig = FeatureConfig(),
    forest: ForestConfig = ForestConfig(),
    *,
    horizon: int = 28,
    benchmark: bool = True,
    run_id: str | None = None,
    day_type: str = "int",
    infer: bool = False,
) -> DataFrame:
    """All stages in order, each with a row in ``<work_dir>/run_reports``; returns this run's totals."""
    run_id = run_id or uuid.uuid4().hex
    work_dir = work_dir.rstrip("/")
    features_dir, model_dir = f"{work_dir}/features", f"{work_dir}/model"
    report = {"reports": f"{work_dir}/run_reports", "run_id": run_id}
    prepare(spark, data_dir, features_dir, config, day_type=day_type, infer=infer, **report)
    train(spark, features_dir, model_dir, config, forest, **report)
    predict(spark, features_dir, model_dir, f"{work_dir}/predictions", horizon, **report)
    if benchmark:
        profile_scan(spark, features_dir, **report)
    return stage_time_rollup(read_reports(spark, report["reports"]).where(F.col("run_id") == run_id))
