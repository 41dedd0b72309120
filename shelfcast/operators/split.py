"""Splits by time: later days never leak into earlier ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_day(features: DataFrame) -> DataFrame:
    """One row with ``max_day``, null for an empty table."""
    return features.agg(F.max("day_number").alias("max_day"))


def last_day_value(features: DataFrame) -> int:
    """The last day as a number; an empty table raises ``ValueError``."""
    value = last_day(features).first()["max_day"]
    if value is None:
        raise ValueError("the feature table has no rows, so it has no last day")
    return value


def _last_day_of(features: DataFrame, known: int | Column | None) -> Column:
    """A known last day, else a scalar subquery over the features, which fails on an empty table.

    The subquery is cheap over stored features, of which it reads one column, and runs their whole
    plan otherwise.
    """
    if known is not None:
        return F.lit(known)
    empty = F.raise_error(F.lit("the feature table has no rows, so it has no last day"))
    return features.agg(F.coalesce(F.max("day_number"), empty)).scalar()


def split_by_time(
    features: DataFrame, validation_days: int, known_last_day: int | Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(train, validation)``: the last ``validation_days`` days are held out."""
    cutoff = _last_day_of(features, known_last_day) - validation_days
    day = F.col("day_number")
    return features.where(day <= cutoff), features.where(day > cutoff)


def with_split_label(
    features: DataFrame, validation_days: int, known_last_day: int | Column | None = None
) -> DataFrame:
    """Both parts in one pass, told apart by ``split``."""
    cutoff = _last_day_of(features, known_last_day) - validation_days
    label = F.when(F.col("day_number") <= cutoff, "train").otherwise("validation")
    return features.withColumn("split", label)


def scoring_window(
    features: DataFrame, horizon: int, known_last_day: int | Column | None = None
) -> DataFrame:
    """Rows of the last ``horizon`` days that exist."""
    return features.where(
        F.col("day_number") > _last_day_of(features, known_last_day) - horizon
    )
