"""Aggregates over features and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_scores(
    frame: DataFrame, label: str = "sales", prediction: str = "prediction"
) -> DataFrame:
    """One row with ``rmse`` and ``mae``; pairs with a null are skipped, no pairs give nulls."""
    error = F.col(label) - F.col(prediction)
    return frame.agg(
        F.sqrt(F.avg(F.pow(error, F.lit(2)))).alias("rmse"), F.avg(F.abs(error)).alias("mae")
    )


def score_values(
    frame: DataFrame, label: str = "sales", prediction: str = "prediction"
) -> dict[str, float]:
    """The same as a dict; raises ``ValueError`` if there is no pair to score."""
    scores = regression_scores(frame, label, prediction).first().asDict()
    if scores["rmse"] is None:
        raise ValueError(f"no rows with both {label} and {prediction} to score")
    return scores


def row_count(features: DataFrame) -> DataFrame:
    return features.agg(F.count(F.lit(1)).alias("input_rows"))


def group_profile(features: DataFrame) -> DataFrame:
    """Rows and mean sales per store and category."""
    return features.groupBy("store_id", "cat_id").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("sales").alias("avg_sales")
    )


def group_count(features: DataFrame) -> DataFrame:
    """How many store and category groups there are."""
    groups = features.select("store_id", "cat_id").distinct()
    return groups.agg(F.count(F.lit(1)).alias("aggregation_groups"))
