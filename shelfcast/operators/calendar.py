"""Calendar attributes of a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import day_label, snap_flag

# The calendar columns in use.
_DAY_COLUMNS = ("d", "wm_yr_wk", "wday", "month", "year")
_SNAP_COLUMNS = ("snap_CA", "snap_TX", "snap_WI")


def calendar_features(calendar: DataFrame) -> DataFrame:
    """``d, wm_yr_wk, wday, month, year, snap`` of every calendar row."""
    flags = (F.col(name) for name in _SNAP_COLUMNS)
    return calendar.select(*_DAY_COLUMNS, snap_flag(*flags).alias("snap"))


def numbered_days(calendar: DataFrame) -> DataFrame:
    """Adds ``day_number``; a label not written ``d_<n>`` names no day of a panel and is left out."""
    numbered = calendar.withColumn("day_number", F.expr("try_cast(substring(d, 3) AS INT)"))
    return numbered.where(F.col("d") == day_label(F.col("day_number")))


def selected_weeks(calendar: DataFrame) -> DataFrame:
    """Distinct weeks of the given calendar rows."""
    return calendar.select("wm_yr_wk").distinct()


def join_calendar(panel: DataFrame, calendar: DataFrame, on: Sequence[str] = ("day_number",)) -> DataFrame:
    """Left join on the day; ``calendar`` carries ``day_number`` and is matched on it, or on all of ``on``.

    The calendar grows with days, not with sales. No hint is set: its size estimate makes the join a
    broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and a shuffled one above.
    """
    return panel.join(calendar.drop("d"), list(on), "left")
