import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from panels import DAYS, ITEMS, STORES, sold
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_dir(tmp_path_factory):
    """A panel as raw CSV files; two days have a snap flag and one item has no price in the second week."""
    folder = tmp_path_factory.mktemp("raw")
    days = range(1, DAYS + 1)
    sales = ["id,item_id,dept_id,cat_id,store_id,state_id," + ",".join(f"d_{n}" for n in days)]
    prices = ["store_id,item_id,wm_yr_wk,sell_price"]
    for s, store in enumerate(STORES):
        for i, item in enumerate(ITEMS):
            values = ",".join(str(sold(i, s, n)) for n in days)
            sales.append(f"{item}_{store},{item},home_{i % 2},home,{store},state_{s},{values}")
            prices += [
                f"{store},{item},{11601 + week},{1.5 + i + week / 10}" for week in range(6) if (i, week) != (3, 1)
            ]
    first = date(2016, 5, 1)
    calendar = ["date,wm_yr_wk,wday,month,year,d,snap_CA,snap_TX,snap_WI"]
    for n in days:
        day = first + timedelta(n - 1)
        calendar.append(
            f"{day},{11601 + (n - 1) // 7},{(n - 1) % 7 + 1},{day.month},{day.year},d_{n},{int(n == 12)},{int(n == 30)},0"
        )
    for name, lines in (
        ("sales_train_validation", sales), ("calendar", calendar), ("sell_prices", prices)
    ):
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)
