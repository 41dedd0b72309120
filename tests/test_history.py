import math
import pytest
from pyspark.sql import functions as F
from panels import assert_history, brute_force, long_frame, random_sales, wide_frame

from shelfcast.config import FeatureConfig
from shelfcast.operators.history import history_long, history_rows, history_wide
from shelfcast.operators.packed import pack_long

CONFIGS = [
    FeatureConfig(),
    FeatureConfig(lags=(1, 7), rolling_windows=(2,)),
    FeatureConfig(lags=(3,), rolling_windows=(70, 5)),
    FeatureConfig(lags=(), rolling_windows=(4,)),
]


@pytest.mark.parametrize("config", CONFIGS, ids=str)
@pytest.mark.parametrize("seed", [1, 2])
def test_all_forms_agree_with_brute_force(spark, config, seed):
    sales = random_sales(4, 90, seed, nulls=0.02)
    expected = brute_force(sales, config)
    assert_history(history_wide(wide_frame(spark, sales), config), expected, config)
    long = long_frame(spark, sales)
    for block_days in (512, 16, 1):
        assert_history(history_long(long, config, block_days), expected, config)
    assert_history(history_rows(pack_long(long, config), config), expected, config)


def test_long_form_never_shifts_over_a_gap(spark):
    config = FeatureConfig(lags=(1, 7), rolling_windows=(3,))
    sales = random_sales(3, 60, 5, nulls=0.0)

    def keep(series, day):
        return (series + day) % 11 != 0 and not 20 <= day <= 25

    expected = brute_force(sales, config, keep)
    long = long_frame(spark, sales, keep)
    assert_history(history_long(long, config, 8), expected, config)
    dense = history_rows(pack_long(long, config), config).where("sales IS NOT NULL")
    assert_history(dense, expected, config)


def test_first_day_with_full_history(spark):
    config = FeatureConfig()
    history = history_wide(wide_frame(spark, [list(range(30))]), config)
    rows = {r["day_number"]: r for r in history.collect()}
    assert rows[28]["lag_28"] is None and rows[28]["rolling_mean_28"] is None
    assert rows[29]["lag_28"] == 0.0
    assert rows[29]["rolling_mean_28"] == sum(range(28)) / 28
    assert rows[8]["rolling_mean_7"] == 3.0 and rows[7]["rolling_mean_7"] is None
    assert rows[1]["d"] == "d_1" and rows[30]["sales"] == 29.0


@pytest.mark.parametrize("form", ["wide", "long"])
def test_recent_days_keep_their_history(spark, form):
    sales = random_sales(3, 60, 7, nulls=0.0)
    config = FeatureConfig(limit_days=10)
    if form == "wide":
        recent = history_wide(wide_frame(spark, sales), config)
    else:
        recent = history_rows(pack_long(long_frame(spark, sales), config), config)
    every = brute_force(sales, config)
    assert_history(recent, {k: v for k, v in every.items() if k[1] > 50}, config)


def test_more_days_asked_for_than_there_are(spark):
    sales = random_sales(2, 20, 8)
    config = FeatureConfig(lags=(1,), rolling_windows=(2,), limit_days=50)
    expected = brute_force(sales, config)
    assert_history(history_wide(wide_frame(spark, sales), config), expected, config)
    long = pack_long(long_frame(spark, sales), config)
    assert_history(history_rows(long, config), expected, config)


def test_wide_form_is_one_compiled_narrow_stage(spark, tmp_path):
    wide_frame(spark, random_sales(3, 150, 9)).write.parquet(f"{tmp_path}/wide")
    history = history_wide(spark.read.parquet(f"{tmp_path}/wide"), FeatureConfig())
    plan = history._jdf.queryExecution().executedPlan().toString()
    for word in ("Exchange", "Window", "Sort"):
        assert word not in plan
    lines = [line for line in plan.splitlines() if "Generate" in line]
    assert len(lines) == 1 and "*(" in lines[0]


def test_long_form_partitions_by_series_and_block(spark):
    plan = history_long(long_frame(spark, [[1, 2, 3]]), FeatureConfig())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(id") == 1 and "_block" in text


def test_chosen_days_and_limit_days_exclude_each_other():
    for days in ((), (0, 1), (3, 3)):
        with pytest.raises(ValueError, match="distinct positive"):
            FeatureConfig(days=days)
    with pytest.raises(ValueError, match="exclude"):
        FeatureConfig(days=(1,), limit_days=3)


@pytest.mark.parametrize("days", [(60,), (3, 29, 30, 59), (40, 41, 42), (1,)])
@pytest.mark.parametrize("form", ["wide", "long", "filled"])
def test_chosen_days_look_back_at_all_days(spark, days, form):
    sales = random_sales(3, 60, 21)
    config = FeatureConfig(lags=(1, 28), rolling_windows=(7,), days=days)
    if form == "wide":
        found = history_wide(wide_frame(spark, sales), config)
    else:
        sales = [[0 if form == "filled" and v is None else v for v in row] for row in sales]
        fill = 0.0 if form == "filled" else None
        found = history_rows(pack_long(long_frame(spark, sales), config, fill=fill), config)
    every = brute_force(sales, config)
    assert_history(found, {k: v for k, v in every.items() if k[1] in days}, config)


def test_a_chosen_day_that_the_panel_lacks_is_named(spark):
    with pytest.raises(ValueError, match="chosen days: d_21..d_22"):
        history_wide(wide_frame(spark, random_sales(1, 20, 3)), FeatureConfig(days=(5, 21, 22)))


def test_chosen_days_of_long_rows_read_only_what_they_need(spark, tmp_path):
    long_frame(spark, random_sales(2, 90, 14, nulls=0.0)).write.parquet(f"{tmp_path}/long")
    config = FeatureConfig(lags=(7,), rolling_windows=(), days=(40, 50))
    panel = pack_long(spark.read.parquet(f"{tmp_path}/long"), config)
    plan = panel.frame._jdf.queryExecution().toString()
    assert "GreaterThan(day_number,32)" in plan and "LessThanOrEqual(day_number,50)" in plan
    assert {len(r["history"]) for r in panel.frame.collect()} == {18}


@pytest.mark.parametrize("day", [None, 0, -3])
@pytest.mark.parametrize("limit", [None, 5])
def test_a_wrong_day_of_long_rows_fails(spark, day, limit):
    rows = long_frame(spark, random_sales(1, 20, 3))
    wrong = rows.limit(1).withColumn("day_number", F.lit(day).cast("int"))
    config = FeatureConfig(lags=(1,), rolling_windows=(), limit_days=limit)
    with pytest.raises(Exception, match="no day of a panel"):
        pack_long(rows.unionByName(wrong), config).frame.collect()


@pytest.mark.parametrize("window", [1, 7, 63, 64, 65, 90, 200])
def test_windows_of_any_length(spark, window):
    config = FeatureConfig(lags=(), rolling_windows=(window, 2))
    sales = random_sales(2, 260, window, nulls=0.005)
    assert_history(history_wide(wide_frame(spark, sales), config), brute_force(sales, config), config)


def test_values_that_are_not_finite_stay_in_their_windows(spark):
    """A running sum would carry them on for ever."""
    values = [float(n % 9) for n in range(200)]
    values[20], values[100], values[150], values[151] = math.inf, math.nan, math.inf, -math.inf
    config = FeatureConfig(lags=(), rolling_windows=(7, 70))
    rows = long_frame(spark, [values])
    for row in history_rows(pack_long(rows, config), config).collect():
        for window in config.rolling_windows:
            some = values[row["day_number"] - 1 - window : row["day_number"] - 1] if row["day_number"] > window else None
            mine, expected = row[f"rolling_mean_{window}"], sum(some) / window if some else None
            assert mine == expected or (math.isnan(mine) and math.isnan(expected)) or abs(mine - expected) < 1e-9


@pytest.mark.parametrize("bad", [
    {"lags": (0,)}, {"lags": (7, 7)}, {"rolling_windows": (-1,)}, {"limit_days": 0},
    {"limit_days": -5}, {"output_partitions": 0}, {"validation_days": -1},
])
def test_config_rejects(bad):
    with pytest.raises(ValueError):
        FeatureConfig(**bad)


def test_one_series_with_most_of_the_rows(spark):
    """A long series is cut into blocks; the others have a few days each."""
    config = FeatureConfig()
    sales = random_sales(6, 700, 13, nulls=0.01)

    def keep(series, day):
        return series == 0 or day > 640

    expected = brute_force(sales, config, keep)
    long = long_frame(spark, sales, keep)
    assert_history(history_long(long, config, 64), expected, config)
    dense = history_rows(pack_long(long, config), config)
    days = {(r["id"], r["day_number"]) for r in long.collect()}
    kept = dense.where("sales IS NOT NULL OR id = 'item_0_store_0' OR day_number > 640")
    assert_history(kept, {k: expected[k] for k in days}, config)


def test_recent_days_of_long_rows_gather_only_what_they_need(spark, tmp_path):
    long_frame(spark, random_sales(2, 90, 14, nulls=0.0)).write.parquet(f"{tmp_path}/long")
    config = FeatureConfig(lags=(7,), rolling_windows=(), limit_days=10)
    panel = pack_long(spark.read.parquet(f"{tmp_path}/long"), config, 90)
    assert "GreaterThan(day_number,73)" in panel.frame._jdf.queryExecution().toString()
    assert {len(r["history"]) for r in panel.frame.collect()} == {17}
