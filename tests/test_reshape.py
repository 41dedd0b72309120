import pytest
from panels import ids, wide_frame

from shelfcast.operators.packed import pack_long, pack_wide
from shelfcast.operators.reshape import day_columns, union_by_name, unpivot_sales
from shelfcast.config import FeatureConfig


def test_days_are_ordered_as_numbers_and_repeats_are_named():
    shuffled = [f"d_{n}" for n in (900, 31, 4, 1000, 5)]
    assert day_columns([*shuffled, "date", "item_id"]) == [f"d_{n}" for n in (4, 5, 31, 900, 1000)]
    with pytest.raises(ValueError, match="'d_4' and 'd_004' name the same day"):
        day_columns([*shuffled, "d_004"])
    with pytest.raises(ValueError):
        day_columns(["d_total"])


@pytest.mark.parametrize("day", [0, -3, None])
def test_rows_outside_the_days_of_a_panel_fail(spark, day):
    rows = [(*ids(0), 1, 2.0), (*ids(0), day, 3.0)]
    schema = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, day_number int, sales double"
    with pytest.raises(Exception, match="no day of a panel"):
        pack_long(spark.createDataFrame(rows, schema)).frame.collect()


def test_unpivot_keeps_null_sales_and_type(spark):
    long = unpivot_sales(wide_frame(spark, [[1, None, 3], [4, 5, 6]]))
    assert dict(long.dtypes)["sales"] == "int"
    rows = {(r["id"], r["d"]): r["sales"] for r in long.collect()}
    assert rows == {
        (ids(0)[0], "d_1"): 1, (ids(0)[0], "d_2"): None, (ids(0)[0], "d_3"): 3,
        (ids(1)[0], "d_1"): 4, (ids(1)[0], "d_2"): 5, (ids(1)[0], "d_3"): 6,
    }


def test_unpivot_of_chosen_days_and_union_by_name(spark):
    wide = wide_frame(spark, [[1, 2, 3, 4]])
    first, second = unpivot_sales(wide, ["d_1", "d_3"]), unpivot_sales(wide, ["d_2", "d_4"])
    united = union_by_name([first, second.select("sales", "d", *first.columns[:-2])])
    assert {(r["d"], r["sales"]) for r in united.collect()} == {
        ("d_1", 1), ("d_2", 2), ("d_3", 3), ("d_4", 4)
    }


def test_unpivot_plan_does_not_grow_with_days(spark):
    plan = unpivot_sales(wide_frame(spark, [list(range(300))]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "Exchange" not in text


def test_pack_wide_reads_only_needed_days(spark, tmp_path):
    wide_frame(spark, [list(range(60))] * 2).write.parquet(f"{tmp_path}/wide")
    config = FeatureConfig(lags=(7,), rolling_windows=(3,), limit_days=5)
    panel = pack_wide(spark.read.parquet(f"{tmp_path}/wide"), config)
    text = panel.frame._jdf.queryExecution().executedPlan().toString()
    assert panel.start == 49  # seven days before day 56, the first of the last five
    assert "d_49" in text and "d_48" not in text


def test_pack_wide_names_gaps(spark):
    sales = wide_frame(spark, [list(range(12))]).drop("d_3", "d_4", "d_8")
    with pytest.raises(ValueError, match="d_3..d_4, d_8"):
        pack_wide(sales, FeatureConfig(lags=(1, 2), rolling_windows=()))


def test_pack_wide_accepts_gaps_that_no_day_needs(spark):
    sales = wide_frame(spark, [list(range(1, 13))]).drop("d_3")
    config = FeatureConfig(lags=(1,), rolling_windows=(2,), limit_days=5)
    panel = pack_wide(sales, config)
    assert panel.frame.select("history").first()[0] == [6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0]


def test_pack_wide_without_days_raises(spark):
    with pytest.raises(ValueError, match="no day columns"):
        pack_wide(wide_frame(spark, [[1]]).drop("d_1"), FeatureConfig())


@pytest.mark.parametrize("fill", [None, 0.0])
def test_pack_long_fills_gaps(spark, fill):
    rows = [("a", 2, 5.0), ("a", 4, 7.0), ("b", 1, 1.0), ("c", 6, 2.0)]
    long = spark.createDataFrame(rows, "id string, day_number int, sales double")
    panel = pack_long(long, attributes=["id"], fill=fill)
    found = {r["id"]: r["history"] for r in panel.frame.collect()}
    f = fill
    assert found == {
        "a": [f, 5.0, f, 7.0, f, f], "b": [1.0, f, f, f, f, f], "c": [f, f, f, f, f, 2.0]
    }


def test_pack_long_refuses_two_rows_for_a_day(spark):
    rows = [("a", 2, 5.0), ("a", 2, 7.0), ("b", 1, 1.0)]
    long = spark.createDataFrame(rows, "id string, day_number int, sales double")
    with pytest.raises(Exception, match="two values for one place of history"):
        pack_long(long, last_day=5, attributes=["id"]).frame.collect()
