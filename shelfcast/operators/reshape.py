"""Wide to long, and back together."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import ID_COLUMNS


def day_columns(columns: Iterable[str]) -> list[str]:
    """Names ``d_<number>`` in day order.

    A suffix that is no number raises ``ValueError``, and so do two labels of one number, such as ``d_1`` and
    ``d_01``: neither may be dropped without a word.
    """
    numbered: dict[int, str] = {}
    for name in columns:
        if name.startswith("d_"):
            other = numbered.setdefault(int(name.removeprefix("d_")), name)
            if other != name:
                raise ValueError(f"day columns {other!r} and {name!r} name the same day")
    return [numbered[number] for number in sorted(numbered)]


def array_of(names: Iterable[str | None]) -> Column:
    """Array of columns, with a null where there is no name.

    Given as one text: thousands of column objects would take seconds to make.
    """
    return F.expr("array({})".format(", ".join(f"`{name}`" if name else "NULL" for name in names)))


def unpivot_sales(sales: DataFrame, days: Sequence[str] | None = None) -> DataFrame:
    """Wide panel -> ``(ids, d, sales)`` with null sales kept.

    The day columns are gathered into one array and generated from it: the plan holds each column
    once, however many days there are, and rows are never copied through an expand of N projections.
    """
    days = list(days) if days is not None else day_columns(sales.columns)
    if not days:
        raise ValueError("there are no day columns to unpivot")
    names = F.expr("array({})".format(", ".join(f"'{day}'" for day in days)))
    gathered = sales.select(*ID_COLUMNS, array_of(days).alias("values"))
    # Outer, so that no filter on the size of the array is inferred, which would build it twice.
    numbered = gathered.select(*ID_COLUMNS, F.posexplode_outer("values").alias("position", "sales"))
    return numbered.select(*ID_COLUMNS, F.get(names, F.col("position")).alias("d"), "sales")


def union_by_name(pieces: Iterable[DataFrame]) -> DataFrame:
    """All rows of the pieces, columns matched by name."""
    return reduce(DataFrame.unionByName, pieces)
