import pytest
from panels import DAYS, ITEMS, SERIES, STORES, ids, long_frame, random_sales, sold, wide_frame
from pyspark.sql import functions as F

from shelfcast.config import FeatureConfig
from shelfcast.plans.features import build_features, build_features_from_long
from shelfcast.sources.raw_panel import read_raw_panel

SMALL = FeatureConfig(lags=(1, 7), rolling_windows=(2,))
CALENDAR = ("d string, wm_yr_wk int, wday int, month int, year int, snap_CA int, snap_TX int, "
            "snap_WI int")


def calendar_frame(spark, days, leave_out=()):
    rows = [
        (f"d_{n}", 100 + (n - 1) // 7, (n - 1) % 7 + 1, 1, 2011, int(n % 5 == 0), None, 0)
        for n in range(1, days + 1) if n not in leave_out
    ]
    return spark.createDataFrame(rows, CALENDAR)


def price_frame(spark, series, weeks, copies=lambda s, w: 1):
    rows = [
        (ids(s)[4], ids(s)[1], 100 + w, 1.0 + s + w / 100 + c)
        for s in range(series) for w in range(weeks) for c in range(copies(s, w))
    ]
    return spark.createDataFrame(
        rows, "store_id string, item_id string, wm_yr_wk int, sell_price double"
    )


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_every_value_of_the_raw_panel(spark, raw_dir):
    features = build_features(*read_raw_panel(spark, raw_dir), SMALL)
    assert features.columns == SMALL.table_columns
    rows = {(r["item_id"], r["store_id"], r["day_number"]): r for r in features.collect()}
    assert len(rows) == SERIES * (DAYS - 7)
    for (item, store, day), r in rows.items():
        i, s = ITEMS.index(item), STORES.index(store)
        assert (r["sales"], r["lag_1"], r["lag_7"]) == tuple(sold(i, s, day - k) for k in (0, 1, 7))
        assert r["rolling_mean_2"] == (sold(i, s, day - 1) + sold(i, s, day - 2)) / 2
        week = (day - 1) // 7
        assert (r["wm_yr_wk"], r["snap"], r["month"]) == (11601 + week, int(day in (12, 30)), 5 + (day > 31))
        assert r["sell_price"] == (0.0 if (i, week) == (3, 1) else pytest.approx(1.5 + i + week / 10))


def test_default_history_of_the_raw_panel(spark, raw_dir):
    rows = build_features(*read_raw_panel(spark, raw_dir)).where("item_id = 'bowl'").collect()
    assert {r["day_number"] for r in rows} == set(range(29, DAYS + 1))
    for r in rows:
        s, day = STORES.index(r["store_id"]), r["day_number"]
        assert r["lag_28"] == sold(1, s, day - 28)
        assert r["rolling_mean_28"] == pytest.approx(sum(sold(1, s, day - k) for k in range(1, 29)) / 28)


def test_a_small_panel_still_comes_out_in_many_tasks(spark):
    """Packed series are dealt out before their long rows are made, so no run-time coalescing joins them."""
    sales = wide_frame(spark, random_sales(64, 60, 5, nulls=0.0))
    features = build_features(sales, calendar_frame(spark, 60), price_frame(spark, 64, 9), SMALL)
    used = features.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used >= spark.sparkContext.defaultParallelism - 1


def test_column_types(spark, raw_dir):
    types = dict(build_features(*read_raw_panel(spark, raw_dir)).dtypes)
    doubles = {"sales", "lag_7", "lag_14", "lag_28", "rolling_mean_7", "rolling_mean_28",
               "sell_price", "item_hash"}
    integers = {"day_number", "wday", "month", "year", "snap", "wm_yr_wk"}
    assert {c for c, t in types.items() if t == "double"} == doubles
    assert {c for c, t in types.items() if t == "int"} == integers


def test_inferred_and_declared_types_give_the_same_table(spark, raw_dir):
    declared = build_features(*read_raw_panel(spark, raw_dir), SMALL)
    inferred = build_features(*read_raw_panel(spark, raw_dir, infer=True), SMALL)
    assert declared.dtypes == inferred.dtypes
    assert rows_of(declared) == rows_of(inferred)


def test_missing_price_is_zero_and_missing_day_drops_rows(spark):
    sales = random_sales(3, 40, 3, nulls=0.0)
    calendar = calendar_frame(spark, 40, leave_out=(20,))
    features = build_features(wide_frame(spark, sales), calendar, price_frame(spark, 2, 6), SMALL)
    rows = features.collect()
    assert {r["day_number"] for r in rows} == set(range(8, 41)) - {20}
    for r in rows:
        series = int(r["item_id"].split("_")[1])
        week = r["wm_yr_wk"] - 100
        expected = 1.0 + series + week / 100 if series < 2 else 0.0
        assert r["sell_price"] == pytest.approx(expected)


def test_null_sale_drops_the_rows_that_look_at_it(spark):
    sales = [[1] * 20]
    sales[0][11] = None  # day 12
    features = build_features(
        wide_frame(spark, sales), calendar_frame(spark, 20), price_frame(spark, 1, 3), SMALL
    )
    days = {r["day_number"] for r in features.collect()}
    assert days == set(range(8, 21)) - {12, 13, 14, 19}


def test_repeated_price_keys_repeat_rows(spark):
    sales = random_sales(4, 30, 4, nulls=0.0)
    prices = price_frame(spark, 4, 5, copies=lambda s, w: 3 if (s, w) == (1, 2) else 1)
    features = build_features(wide_frame(spark, sales), calendar_frame(spark, 30), prices, SMALL)
    rows = features.collect()
    assert len(rows) == 4 * 23 + 2 * 7
    hit = [r["sell_price"] for r in rows if r["item_id"] == "item_1" and r["day_number"] == 15]
    assert sorted(hit) == pytest.approx([2.02, 3.02, 4.02])


def test_repeated_prices_equal_a_row_by_row_join(spark, monkeypatch):
    """Nulls, equal copies and weeks of several prices, against the form for very many copies."""
    sales = random_sales(5, 60, 9)
    prices = price_frame(spark, 4, 8, copies=lambda s, w: (s * w) % 4)
    nulls = price_frame(spark, 2, 8).withColumn("sell_price", F.lit(None).cast("double"))
    parts = wide_frame(spark, sales), calendar_frame(spark, 60, leave_out=(33,)), prices.unionByName(nulls).unionByName(prices)
    folded = rows_of(build_features(*parts, SMALL))
    monkeypatch.setattr("shelfcast.plans.features.MOST_COPIES", 0)
    assert folded == rows_of(build_features(*parts, SMALL)) and len(folded) > 5 * 40


def test_a_day_in_two_weeks_comes_with_both(spark, monkeypatch):
    calendar = calendar_frame(spark, 30)
    twice = calendar.unionByName(calendar.where("d = 'd_20'").withColumn("wm_yr_wk", F.lit(104)))
    parts = wide_frame(spark, random_sales(3, 30, 9, nulls=0.0)), twice.unionByName(calendar.where("d = 'd_25'")), price_frame(spark, 3, 5)
    folded = rows_of(build_features(*parts, SMALL))
    monkeypatch.setattr("shelfcast.plans.features.MOST_COPIES", 0)
    assert folded == rows_of(build_features(*parts, SMALL)) and len(folded) == 3 * (23 + 2)


def test_prices_go_no_further_than_the_generated_rows(spark, tmp_path):
    """Without broadcasts neither the folded prices nor a long row with copies is exchanged or sorted by a window."""
    parts = {"wide": wide_frame(spark, random_sales(3, 60, 9)), "calendar": calendar_frame(spark, 60),
             "prices": price_frame(spark, 3, 9, copies=lambda s, w: 2)}
    for name, frame in parts.items():
        frame.write.parquet(f"{tmp_path}/{name}")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        features = build_features(*(spark.read.parquet(f"{tmp_path}/{n}") for n in parts), SMALL)
        plan = features._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Window" not in plan
    generates = plan.count("Generate")
    above = plan.split("Generate")[0]
    assert generates >= 2 and "_price_by_week" not in above
    assert len(features.collect()) == 2 * len(build_features(*parts.values(), SMALL).dropDuplicates(["id", "d"]).collect())


def test_prices_wrongly_called_unique_fail(spark):
    sales = random_sales(2, 20, 4, nulls=0.0)
    prices = price_frame(spark, 2, 3, copies=lambda s, w: 2 if (s, w) == (1, 2) else 1)
    parts = wide_frame(spark, sales), calendar_frame(spark, 20), prices
    with pytest.raises(Exception, match="two values for one place"):
        build_features(*parts, SMALL, unique_prices=True).collect()


def test_price_strategies_agree(spark):
    sales = random_sales(6, 50, 6)
    parts = wide_frame(spark, sales), calendar_frame(spark, 50), price_frame(spark, 5, 6)
    folded = build_features(*parts, SMALL, unique_prices=True)
    joined = build_features(*parts, SMALL, unique_prices=False)
    checked = build_features(*parts, SMALL)
    assert rows_of(folded) == rows_of(joined) == rows_of(checked)
    assert rows_of(folded)


def test_null_price_and_null_week_keys(spark):
    sales = random_sales(2, 20, 6, nulls=0.0)
    prices = price_frame(spark, 2, 3).unionByName(spark.createDataFrame(
        [(ids(0)[4], ids(0)[1], None, 9.0), (ids(0)[4], ids(0)[1], 102, 5.0)],
        "store_id string, item_id string, wm_yr_wk int, sell_price double",
    )).where("NOT (item_id = 'item_0' AND wm_yr_wk = 102 AND sell_price < 5)")
    parts = wide_frame(spark, sales), calendar_frame(spark, 20), prices
    folded = build_features(*parts, SMALL, unique_prices=True)
    assert rows_of(folded) == rows_of(build_features(*parts, SMALL, unique_prices=False))


@pytest.mark.parametrize("limit", [None, 9, 100])
def test_long_and_wide_panels_agree(spark, limit):
    config = FeatureConfig(lags=(1, 7), rolling_windows=(2,), limit_days=limit)
    sales = random_sales(5, 40, 11)
    calendar, prices = calendar_frame(spark, 40), price_frame(spark, 5, 6)
    wide = build_features(wide_frame(spark, sales), calendar, prices, config)
    long = build_features_from_long(long_frame(spark, sales), calendar, prices, config)
    assert rows_of(wide) == rows_of(long)
    if limit == 9:
        assert {r["day_number"] for r in wide.collect()} <= set(range(32, 41))


def test_limit_inside_warm_up_gives_no_rows(spark):
    config = FeatureConfig(limit_days=5)
    sales = random_sales(2, 20, 12, nulls=0.0)
    calendar, prices = calendar_frame(spark, 20), price_frame(spark, 2, 3)
    assert build_features(wide_frame(spark, sales), calendar, prices, config).count() == 0
    long = build_features_from_long(long_frame(spark, sales), calendar, prices, config)
    assert long.count() == 0


def test_long_rows_are_never_shuffled(spark, tmp_path):
    """Packed series may move to meet their prices; nothing moves after the generator."""
    wide_frame(spark, random_sales(3, 150, 9)).write.parquet(f"{tmp_path}/wide")
    calendar_frame(spark, 150).write.parquet(f"{tmp_path}/calendar")
    price_frame(spark, 3, 22).write.parquet(f"{tmp_path}/prices")
    features = build_features(
        *(spark.read.parquet(f"{tmp_path}/{n}") for n in ("wide", "calendar", "prices")),
        unique_prices=True,
    )
    plan = features._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Generate")[0]
    assert "Exchange" not in above and "Sort" not in above and "BroadcastHashJoin" in above
