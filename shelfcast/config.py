"""Settings of a feature build and of the forest that learns from it."""

from __future__ import annotations

from dataclasses import dataclass

# The columns of the panel model.
SERIES_KEY = "id"
ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
CATEGORY_COLUMNS = ("dept_id", "cat_id", "store_id", "state_id")
PRICE_KEYS = ("store_id", "item_id", "wm_yr_wk")
BASE_FEATURES = ("item_hash", "day_number", "wday", "month", "year", "snap", "sell_price")


@dataclass(frozen=True)
class FeatureConfig:
    """What history to derive, which days to keep and how to lay the result out.

    ``limit_days`` and ``days`` restrict the rows that come out, never the history they are computed from: to
    the last days of the panel, or to the day numbers given.
    ``partition_by`` names feature columns that become directories, so that a later stage which
    only needs recent days reads only their files.
    """

    # The defaults.
    lags: tuple[int, ...] = (7, 14, 28)
    rolling_windows: tuple[int, ...] = (7, 28)
    limit_days: int | None = None
    days: tuple[int, ...] | None = None
    validation_days: int = 28
    output_partitions: int | None = None
    auto_partitions: bool = False
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for name in ("lags", "rolling_windows"):
            values = getattr(self, name)
            if any(value < 1 for value in values) or len(set(values)) != len(values):
                raise ValueError(f"{name} must be distinct positive day counts, got {values}")
        for name in ("limit_days", "output_partitions"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be positive, got {value}")
        if self.days is not None:
            if not self.days or any(day < 1 for day in self.days) or len(set(self.days)) != len(self.days):
                raise ValueError(f"days must be distinct positive day numbers, got {self.days}")
            if self.limit_days is not None:
                raise ValueError("days and limit_days exclude each other")
        if self.validation_days < 0:
            raise ValueError(f"validation_days must not be negative, got {self.validation_days}")

    @property
    def reach(self) -> int:
        """How many earlier days a row may look back at."""
        return max((*self.lags, *self.rolling_windows), default=0)

    @property
    def history_columns(self) -> list[str]:
        return [
            *(f"lag_{k}" for k in self.lags),
            *(f"rolling_mean_{w}" for w in self.rolling_windows),
        ]

    @property
    def feature_columns(self) -> list[str]:
        """Numeric model inputs, in the order in which the forest sees them."""
        return [*BASE_FEATURES, *self.history_columns]

    @property
    def table_columns(self) -> list[str]:
        """Columns of the feature table, in order."""
        return [
            *PRICE_KEYS, "d", "id", "dept_id", "cat_id", "state_id", "sales",
            *self.history_columns,
            "day_number", "wday", "month", "year", "snap", "sell_price", "item_hash",
        ]


@dataclass(frozen=True)
class ForestConfig:
    """``partitions`` deals the training rows out by their content; with the seed it decides which rows a tree draws.

    The fit depends on it, and on nothing of how the table is stored or read. More rows want more partitions.
    """

    max_depth: int = 6
    num_trees: int = 40
    seed: int = 42
    max_bins: int = 32
    partitions: int = 64
