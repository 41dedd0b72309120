"""Lags and trailing means of daily sales.

For day n of a series: ``lag_k`` is the sale of day n-k, null before day k+1; ``rolling_mean_w`` is the
mean of days n-w ... n-1, null unless all w of them exist and are not null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import ID_COLUMNS, SERIES_KEY, FeatureConfig
from shelfcast.functions.columns import day_label
from shelfcast.operators.packed import DAYS, START, PackedPanel, pack_wide

# A mean over more days than this is computed in the packed row, to keep generated methods small
# enough for the JIT.
_UNROLLED_DAYS = 64


def history_wide(sales: DataFrame, config: FeatureConfig) -> DataFrame:
    """History of a wide panel: one narrow stage, no shuffle, sort or window."""
    return history_rows(pack_wide(sales, config), config)


def history_rows(
    panel: PackedPanel,
    config: FeatureConfig,
    carry: Sequence[str] = (),
    dated: tuple[Column, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per series and day; ``carry`` names further columns of the packed frame to keep.

    ``dated`` gives the days in place of the panel's: an array of structs with ``day_number``, and the names of its
    other fields, which come out as columns.

    Days are generated first and the array is then read by position in ordinary expressions, so that
    generator, look-backs and whatever follows compile into one loop which never copies the array.
    """
    day = F.col("day_number")
    position = day - panel.start
    history = F.col("history")
    long_means = {w: _mean_array(w) for w in config.rolling_windows if w > _UNROLLED_DAYS}
    days, fields = dated or (panel.days, ())
    laid_out = DAYS in panel.frame.columns
    packed = panel.frame.select(
        *ID_COLUMNS, *carry, history, *([DAYS, START] if laid_out else [days.alias(DAYS)]),
        *(mean.alias(f"_mean_{w}") for w, mean in long_means.items()),
    )
    each = F.inline(DAYS) if dated else F.explode(DAYS).alias("day_number")
    generated = packed.select(*(c for c in packed.columns if c != DAYS), each)

    def mean(window: int) -> Column:
        if window in long_means:
            return F.get(F.col(f"_mean_{window}"), position)
        total = F.get(history, position - window)
        for back in range(window - 1, 0, -1):
            total = total + F.get(history, position - back)
        return total / F.lit(float(window))

    return generated.select(
        *ID_COLUMNS,
        *carry,
        *fields,
        day_label(day).alias("d"),
        F.get(history, position).alias("sales"),
        *(F.get(history, position - k).alias(f"lag_{k}") for k in config.lags),
        *(mean(w).alias(f"rolling_mean_{w}") for w in config.rolling_windows),
        day,
    )


def history_long(sales: DataFrame, config: FeatureConfig, block_days: int = 512) -> DataFrame:
    """History of long rows ``(ids, day_number, sales)``, unique per series and day.

    Frames are RANGE frames over the day number, so a missing day gives null and never a shifted
    value. Each series is cut into blocks of ``block_days`` days; the days just before a block are
    copied into it, so blocks are independent and a series of any length spreads over many tasks.
    """
    if block_days < 1:
        raise ValueError(f"block_days must be positive, got {block_days}")
    day = F.col("day_number")
    zero_based = F.coalesce(day, F.raise_error(F.lit("a row of the panel has no day")).cast("int")) - 1
    own = F.floor(zero_based / block_days).cast("int")
    furthest = F.floor((zero_based + config.reach) / block_days).cast("int")
    rows = sales.select(
        *ID_COLUMNS,
        "day_number",
        F.col("sales").cast("double").alias("sales"),
        own.alias("_own"),
        F.explode(F.sequence(own, furthest)).alias("_block"),
    )
    by_day = Window.partitionBy(SERIES_KEY, "_block").orderBy("day_number")

    def lag(k: int) -> Column:
        return F.max("sales").over(by_day.rangeBetween(-k, -k))

    def mean(w: int) -> Column:
        frame = by_day.rangeBetween(-w, -1)
        full = F.count("sales").over(frame) == w
        return F.when(full, F.sum("sales").over(frame) / F.lit(float(w)))

    derived = rows.select(
        "*",
        *(lag(k).alias(f"lag_{k}") for k in config.lags),
        *(mean(w).alias(f"rolling_mean_{w}") for w in config.rolling_windows),
    )
    return derived.where(F.col("_block") == F.col("_own")).select(
        *ID_COLUMNS,
        day_label(F.col("day_number")).alias("d"),
        "sales",
        *config.history_columns,
        "day_number",
    )


def _mean_array(window: int) -> Column:
    """For each entry of ``history`` the mean of the ``window`` entries before it."""
    history = F.col("history")

    def mean(position: Column) -> Column:
        start = F.greatest(position - window, F.lit(0)) + 1
        before = F.slice(history, start, F.lit(window))
        total = F.aggregate(before, F.lit(0.0), lambda sum_, value: sum_ + value)
        return F.when(position >= window, total / F.lit(float(window)))

    return F.transform(F.sequence(F.lit(0), F.size(history) - 1), mean)
