"""The three CSV files of a raw panel."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources.saved import open_path

# The file names of the panel and the types of the columns in use.
SALES_FILE = "sales_train_validation.csv"
CALENDAR_FILE = "calendar.csv"
PRICES_FILE = "sell_prices.csv"
_CALENDAR_TYPES = {
    "wm_yr_wk": "int", "wday": "int", "month": "int", "year": "int",
    "snap_CA": "int", "snap_TX": "int", "snap_WI": "int", "date": "date",
}
_PRICE_TYPES = {"wm_yr_wk": "int", "sell_price": "double"}


class RawPanel(NamedTuple):
    sales: DataFrame
    calendar: DataFrame
    prices: DataFrame


def child_path(root: str, name: str) -> str:
    """``root/name`` for local paths and for ``scheme://`` roots alike."""
    return f"{str(root).rstrip('/')}/{name}"


def read_raw_panel(
    spark: SparkSession, directory: str, *, day_type: str = "int", infer: bool = False
) -> RawPanel:
    """Sales, calendar and prices of a directory on any file system that Spark can reach.

    The header gives the column names and this module their types, so the files are not read twice
    for inference and unused day columns are never converted. A value that does not fit its type
    fails the job. ``infer=True`` leaves the types to Spark.
    """
    return RawPanel(
        read_raw_sales(spark, directory, day_type=day_type, infer=infer),
        _read(spark, directory, CALENDAR_FILE, lambda c: _CALENDAR_TYPES.get(c, "string"), infer),
        _read(spark, directory, PRICES_FILE, lambda c: _PRICE_TYPES.get(c, "string"), infer),
    )


def read_raw_sales(
    spark: SparkSession, directory: str, *, day_type: str = "int", infer: bool = False
) -> DataFrame:
    """The wide sales panel alone."""
    return _read(
        spark, directory, SALES_FILE, lambda c: day_type if c.startswith("d_") else "string", infer
    )


def _read(
    spark: SparkSession, directory: str, name: str, type_of: Callable[[str], str], infer: bool
) -> DataFrame:
    path = child_path(directory, name)
    reader = spark.read.option("header", True)
    if infer:
        return open_path(lambda: reader.csv(path, inferSchema=True), path)
    header = open_path(lambda: reader.csv(path).columns, path)
    schema = ", ".join(f"`{column}` {type_of(column)}" for column in header)
    return reader.option("mode", "FAILFAST").csv(path, schema=schema)
