import math

import xxhash
from pyspark.sql import functions as F

from shelfcast.config import FeatureConfig
from shelfcast.functions import columns
from shelfcast.operators.calendar import calendar_features, numbered_days


def test_item_bucket_is_xxh64_with_seed_42(spark):
    items = ["", "a", "Brand#1", "HOBBIES_1_001", "FOODS_3_827", "x" * 40, "Köln-Straße"]
    frame = spark.createDataFrame([(i,) for i in [*items, None]], "item_id string")
    found = {r[0]: r[1] for r in frame.select("item_id", columns.item_bucket(F.col("item_id"))).collect()}
    assert found.pop(None) == 42.0
    assert found == {i: float(xxhash.xxh64(i.encode(), seed=42).intdigest() % 1024) for i in items}
    assert found["HOBBIES_1_001"] == 643.0


def test_snap_flag_takes_any_state_and_null_as_unset(spark):
    rows = [(1, 0, 0), (0, 1, None), (None, None, 1), (0, 0, 0), (None, None, None), (2, 0, 0)]
    frame = spark.createDataFrame(rows, "ca int, tx int, wi int")
    flags = frame.select(columns.snap_flag(F.col("ca"), F.col("tx"), F.col("wi"))).collect()
    assert [r[0] for r in flags] == [1, 1, 1, 0, 0, 0]


def test_non_negative(spark):
    frame = spark.createDataFrame([(-1.5,), (2.0,), (None,), (math.nan,)], "p double")
    values = [r[0] for r in frame.select(columns.non_negative(F.col("p"))).collect()]
    assert values[:3] == [0.0, 2.0, 0.0] and math.isnan(values[3])


def test_day_number(spark):
    frame = spark.createDataFrame([("d_1",), ("d_1913",)], "d string")
    assert [r[0] for r in frame.select(columns.day_number(F.col("d"))).collect()] == [1, 1913]


def test_calendar_features_and_labels_that_name_no_day(spark):
    rows = [("d_1", 1, 1, 1, 2011, 0, 1, 0, "x"), ("d_01", 1, 1, 1, 2011, 0, 0, 0, "x"),
            ("day", 1, 1, 1, 2011, 0, 0, 0, "x"), (None, 1, 1, 1, 2011, 0, 0, 0, "x")]
    calendar = spark.createDataFrame(
        rows, "d string, wm_yr_wk int, wday int, month int, year int, snap_CA int, snap_TX int, "
        "snap_WI int, event string"
    )
    features = calendar_features(calendar)
    assert features.columns == ["d", "wm_yr_wk", "wday", "month", "year", "snap"]
    assert [(r["day_number"], r["snap"]) for r in numbered_days(features).collect()] == [(1, 1)]


def test_history_features_keep_the_order_in_which_they_are_asked_for():
    """A stored model reads its vector by position, so the order must not depend on the values."""
    config = FeatureConfig(lags=(28, 2), rolling_windows=(9, 4))
    assert config.feature_columns[-4:] == ["lag_28", "lag_2", "rolling_mean_9", "rolling_mean_4"]
    assert set(config.feature_columns) < set(config.table_columns)
