"""Small panels made by hand, and their history by brute force."""

from __future__ import annotations

import random

from shelfcast.config import ID_COLUMNS, FeatureConfig


def ids(series: int) -> tuple[str, ...]:
    return (
        f"item_{series}_store_{series % 3}", f"item_{series}", f"dept_{series % 2}",
        f"cat_{series % 2}", f"store_{series % 3}", f"state_{series % 3}",
    )


def random_sales(series: int, days: int, seed: int, nulls: float = 0.05):
    draw = random.Random(seed)
    return [
        [None if draw.random() < nulls else draw.randrange(20) for _ in range(days)]
        for _ in range(series)
    ]


def wide_frame(spark, sales, first_day: int = 1):
    days = [f"d_{first_day + n}" for n in range(len(sales[0]))]
    schema = ", ".join([*(f"{c} string" for c in ID_COLUMNS), *(f"{d} int" for d in days)])
    return spark.createDataFrame([(*ids(s), *row) for s, row in enumerate(sales)], schema)


def long_frame(spark, sales, keep=lambda series, day: True):
    rows = [
        (*ids(s), n + 1, float(v) if v is not None else None)
        for s, row in enumerate(sales)
        for n, v in enumerate(row)
        if keep(s, n + 1)
    ]
    schema = ", ".join(f"{c} string" for c in ID_COLUMNS) + ", day_number int, sales double"
    return spark.createDataFrame(rows, schema)


def brute_force(sales, config: FeatureConfig, keep=lambda series, day: True):
    """``{(id, day): (sales, lags..., means...)}``."""
    result = {}
    for s, row in enumerate(sales):
        known = {n + 1: v for n, v in enumerate(row) if keep(s, n + 1)}
        for day, value in known.items():
            derived = [known.get(day - k) for k in config.lags]
            for w in config.rolling_windows:
                window = [known.get(d) for d in range(day - w, day)]
                derived.append(None if None in window else sum(window) / w)
            result[ids(s)[0], day] = (value, *derived)
    return result


def as_dict(frame, config: FeatureConfig):
    columns = ["sales", *config.history_columns]
    rows = frame.select("id", "day_number", *columns).collect()
    found = {(r["id"], r["day_number"]): tuple(r[c] for c in columns) for r in rows}
    assert len(found) == len(rows)
    return found


def assert_history(frame, expected, config: FeatureConfig):
    found = as_dict(frame, config)
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        for mine, theirs in zip(found[key], values):
            assert (mine is None) == (theirs is None), key
            assert mine is None or abs(mine - theirs) < 1e-9, key


# Four items in two stores of two states, 40 days from the first of May.
ITEMS, STORES, DAYS = ("apron", "bowl", "candle", "dish"), ("north", "south"), 40
SERIES = len(ITEMS) * len(STORES)


def sold(item: int, store: int, day: int) -> int:
    return (day * day + 5 * item + 2 * store) % 11
