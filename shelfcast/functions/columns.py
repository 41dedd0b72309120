"""Column expressions of the feature table; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_label(day_number: Column) -> Column:
    """``7`` -> ``'d_7'``."""
    return F.concat(F.lit("d_"), day_number.cast("string"))


def day_number(label: Column) -> Column:
    """``'d_7'`` -> ``7``; a label without digits raises under ANSI mode."""
    return F.regexp_extract(label, r"d_(\d+)", 1).cast("int")


def snap_flag(*flags: Column) -> Column:
    """1 if any flag is 1; a null flag counts as not set."""
    hit = F.lit(False)
    for flag in flags:
        hit = hit | (flag == 1)
    return F.when(hit, 1).otherwise(0)


def item_bucket(item_id: Column, buckets: int = 1024) -> Column:
    """Stable bucket of an item, as a double so that it can enter a feature vector."""
    return F.pmod(F.xxhash64(item_id), F.lit(buckets)).cast("double")


def non_negative(prediction: Column) -> Column:
    """Demand is never negative: negative and null become 0, NaN stays NaN."""
    return F.greatest(prediction, F.lit(0.0))
