"""The panel with one row per series and its sales as an array over days.

A packed row is small (8 bytes a day), so whatever must move series between executors - a join with
prices, a re-balancing - moves this form and not the long one. The long form is made last, by a
generator in the same stage as the scan or the join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import ID_COLUMNS, SERIES_KEY, FeatureConfig
from shelfcast.operators.reshape import array_of, day_columns


@dataclass(frozen=True)
class PackedPanel:
    """``frame`` holds the ids and ``history``, whose first entry is day ``start``.

    Rows are put out for the days ``first ... last``, or for ``listed`` days where those have gaps.
    ``start``, ``first`` and ``last`` are literals or scalar subqueries: they fit into any frame.
    """

    frame: DataFrame
    start: int | Column
    first: Column
    last: Column
    listed: tuple[int, ...] | None = None

    @property
    def days(self) -> Column:
        if self.listed is not None:
            return F.array(*(F.lit(day) for day in self.listed)).cast("array<int>")
        some = F.sequence(self.first, self.last)
        return F.when(self.first <= self.last, some).otherwise(F.array().cast("array<int>"))

    def covers(self, day: Column) -> Column:
        """Whether rows are put out for a day."""
        if self.listed is not None:
            return day.isin(list(self.listed))
        return day.between(self.first, self.last)

    def after_warm_up(self, days: int) -> PackedPanel:
        """Leave out the days that cannot look back ``days`` days."""
        if self.listed is not None:
            return replace(self, listed=tuple(day for day in self.listed if day > days))
        return replace(self, first=F.greatest(self.first, F.lit(days + 1)))


def pack_wide(sales: DataFrame, config: FeatureConfig) -> PackedPanel:
    """Pack day columns ``d_1 ... d_N``; only the columns that the chosen days need are read."""
    columns = {}
    for name in day_columns(sales.columns):
        number = int(name[2:])
        if name != f"d_{number}":
            raise ValueError(f"day column {name!r} is not written as d_{number}")
        columns[number] = name
    if not columns:
        raise ValueError("the sales panel has no day columns d_1, d_2, ...")

    chosen = tuple(sorted(columns))
    if config.days is not None:
        unknown = sorted(set(config.days) - columns.keys())
        if unknown:
            raise ValueError(f"the sales panel lacks the chosen days: {_spans(unknown)}")
        chosen = tuple(sorted(config.days))
    elif config.limit_days is not None:
        chosen = chosen[-config.limit_days :]
    needed = set(chosen)
    for day in chosen:
        needed.update(day - k for k in config.lags if day > k)
        for window in config.rolling_windows:
            if day > window:
                needed.update(range(day - window, day))
    gaps = sorted(needed - columns.keys())
    if gaps:
        raise ValueError(f"the sales panel lacks day columns: {_spans(gaps)}")

    first, last = min(needed), max(needed)
    names = [columns.get(day) if day in needed else None for day in range(first, last + 1)]
    frame = sales.select(*ID_COLUMNS, array_of(names).cast("array<double>").alias("history"))
    whole = chosen[-1] - chosen[0] + 1 == len(chosen)
    return PackedPanel(
        frame, first, F.lit(chosen[0]), F.lit(chosen[-1]), None if whole else chosen
    )


def pack_long(
    sales: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    last_day: Column | int | None = None,
    *,
    attributes: Sequence[str] = ID_COLUMNS,
    key: str | Sequence[str] = SERIES_KEY,
    fill: float | None = None,
) -> PackedPanel:
    """Pack rows ``(ids, day_number, sales)``, unique per series and day, starting at day 1.

    A row without a day, or with one before day 1, fails the job. Missing days become ``fill``, or null if
    there is none: a gap is never closed by shifting. A series gathers at most one entry per day of the
    calendar, whatever the size of the table. Without a fill only the rows that the chosen days and their
    look-back need are read at all - the bounds reach the scan, as the last day is found beforehand by a
    look at its column; with one, every series counts, also one that last sold long ago.
    """
    keys = [key] if isinstance(key, str) else list(key)
    chosen = tuple(sorted(config.days)) if config.days is not None else None
    if last_day is None and config.limit_days is not None and fill is None:
        last_day = sales.agg(F.max("day_number")).first()[0] or 0
    if chosen is not None and fill is None:
        last_day = chosen[-1]
    elif last_day is None:
        last_day = sales.agg(F.max("day_number")).scalar()
    last_day, day = F.lit(last_day), F.col("day_number")
    first, last, skipped, needed = F.lit(1), last_day, F.lit(0), None
    if chosen is not None:
        first, last = F.lit(chosen[0]), F.lit(chosen[-1])
        skipped = F.lit(max(chosen[0] - 1 - config.reach, 0) if fill is None else 0)
        needed = (day > skipped) & (day <= last_day)
    elif config.limit_days is not None:
        first = F.greatest(last_day - config.limit_days + 1, first)
        if fill is None:
            skipped = F.greatest(last_day - config.limit_days - config.reach, skipped)
        needed = day > skipped
    if fill is None and needed is not None:
        # a wrong day passes, to be refused where its place is asked for
        sales = sales.where(needed | day.isNull() | (day < 1))
    frame = gather_dense(
        sales,
        keys,
        checked_day(day) - skipped,
        F.col("sales").cast("double"),
        "history",
        last=last_day - skipped,
        fill=fill,
        keep=[name for name in attributes if name not in keys],
    ).select(*attributes, "history")
    whole = chosen is None or chosen[-1] - chosen[0] + 1 == len(chosen)
    return PackedPanel(frame, skipped + 1, first, last, None if whole else chosen)


def checked_day(day: Column) -> Column:
    """The day number itself; a null or one before day 1 raises, as an array has no place for it."""
    wrong = F.raise_error(F.concat(F.lit("no day of a panel: "), F.coalesce(day.cast("string"), F.lit("null"))))
    return F.when(day >= 1, day).otherwise(wrong.cast("int"))


#: Ranges of days that a series is cut into where files are laid out, and the fewest days of one: each range takes a
#: look-back of its own along.
_RANGES, _RANGE_DAYS = 32, 32
DAYS, START, RANGE = "_days", "_start", "_range"


def spread_series(panel: PackedPanel, parts: int | None = None) -> PackedPanel:
    """Deal packed series to a number of partitions that run-time coalescing leaves alone.

    Packed rows are few and small, so coalescing would put them into one task and with them all the long rows
    that come out of them.
    """
    return replace(panel, frame=panel.frame.repartition(parts or _parts(panel.frame), SERIES_KEY))


def _parts(frame: DataFrame) -> int:
    spark = frame.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def output_partitions(spark: SparkSession, config: FeatureConfig) -> int | None:
    """The number of files asked for; ``auto_partitions`` means four per core and at least 32."""
    if config.output_partitions is not None:
        return config.output_partitions
    if config.auto_partitions:
        return max(32, 4 * spark.sparkContext.defaultParallelism)
    return None


def lay_out_series(
    panel: PackedPanel, config: FeatureConfig, files: int | None, days: Column, day_of: Callable[[Column], Column]
) -> PackedPanel:
    """Deal ranges of days of packed series to partitions as the files of the long rows are wanted.

    A given number of ``files`` is filled by hash of series and range. For directories by columns of the series, the
    ranges of their series come together; for directories by anything else, which depends on the day, each range of
    all series is in one place - or in a few, if there are many more partitions than ranges - so a day's directory
    gets few files. The long rows come out where they are written.

    ``days`` is the array of days that rows are put out for and ``day_of`` the number of an entry.
    """
    number = F.explode(F.sequence(F.lit(0), F.lit(_RANGES - 1)))
    frame = panel.frame.withColumn(RANGE, number)
    size = F.greatest(F.ceil(F.size(days) / _RANGES).cast("int"), F.lit(_RANGE_DAYS))
    own = F.slice(days, F.col(RANGE) * size + 1, size)
    frame = frame.withColumn(DAYS, own).where(F.size(DAYS) > 0)
    first, last = day_of(F.element_at(DAYS, 1)), day_of(F.element_at(DAYS, -1))
    start = F.greatest(first - config.reach, F.lit(panel.start))
    needed = F.slice("history", F.col(START) - panel.start + 1, F.greatest(last - F.col(START) + 1, F.lit(0)))
    frame = frame.withColumn(START, start).withColumn("history", needed)
    by_series = [c for c in config.partition_by if c in ID_COLUMNS]
    if files is not None:
        frame = frame.repartition(files, SERIES_KEY, RANGE)
    elif len(by_series) == len(config.partition_by):
        frame = frame.repartition(_parts(frame), *by_series, RANGE)
    else:
        share = F.pmod(F.xxhash64(SERIES_KEY), F.lit(max(_parts(frame) // _RANGES, 1)))
        frame = frame.repartition(max(_parts(frame), _RANGES), *by_series, RANGE, share)
    return replace(panel, frame=frame.drop(RANGE), start=F.col(START))


def gather_dense(
    rows: DataFrame,
    keys: Sequence[str],
    place: Column,
    value: Column,
    name: str,
    *,
    last: Column | None = None,
    fill: float | None = None,
    keep: Sequence[str] = (),
    kind: str = "double",
) -> DataFrame:
    """One row per key with an array ``name`` of its values (of type ``kind``), each at its 1-based ``place``.

    The array reaches to ``last``, or to the last place of the key, and holds ``fill`` where there is no
    value. Two values for one place raise. ``keep`` names columns that the keys determine.
    """
    entry = F.struct(place.alias("place"), value.alias("value"))
    gathered = rows.groupBy(*keys).agg(
        *(F.any_value(column).alias(column) for column in keep),
        F.sort_array(F.collect_list(entry)).alias("entries"),
    )
    entries, array = F.col("entries"), F.col(name)
    own_last = F.element_at(entries, -1)["place"]
    length = own_last if last is None else F.greatest(last, own_last)
    dense = gathered.select(
        *keys, *keep, length.alias("length"), _dense(entries, length, F.lit(fill).cast(kind)).alias(name)
    )
    repeated = F.raise_error(F.lit(f"two values for one place of {name} by {', '.join(keys)}"))
    whole = F.when(F.size(array) == F.col("length"), array).otherwise(repeated)
    return dense.select(*keys, *keep, whole.alias(name))


def _dense(entries: Column, length: Column, blank: Column) -> Column:
    """Walks sorted entries once, with a run of ``blank`` before each of them and behind the last."""
    places = F.transform(entries, lambda entry: entry["place"])
    previous = F.concat(F.array(F.lit(0)), F.slice(places, 1, F.size(places) - 1))
    runs = F.zip_with(
        entries,
        previous,
        lambda entry, before: F.concat(
            F.array_repeat(blank, entry["place"] - before - 1), F.array(entry["value"])
        ),
    )
    tail = F.array_repeat(blank, length - F.element_at(entries, -1)["place"])
    return F.concat(F.flatten(runs), tail)


def _spans(days: list[int]) -> str:
    """``[3, 4, 5, 9]`` -> ``'d_3..d_5, d_9'``."""
    spans: list[list[int]] = []
    for day in days:
        if spans and day == spans[-1][1] + 1:
            spans[-1][1] = day
        else:
            spans.append([day, day])
    return ", ".join(f"d_{a}" if a == b else f"d_{a}..d_{b}" for a, b in spans)
