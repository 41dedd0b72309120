"""One row per finished stage of a run, and the totals over them."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.saved import open_path

# The stages in the order in which they run, and the stages of each total.
STAGES = ("prepare", "train", "predict", "benchmark")
_TOTALS = {
    "prepare_train_seconds": ("prepare", "train"),
    "prepare_train_predict_seconds": ("prepare", "train", "predict"),
}
REPORT_SCHEMA = (
    "run_id string, stage string, duration_seconds double, created_at_utc timestamp, "
    "master string, default_parallelism int, inputs map<string,string>, "
    "outputs map<string,string>, metrics map<string,double>"
)


def append_report(
    spark: SparkSession,
    table: str,
    run_id: str,
    stage: str,
    duration_seconds: float,
    *,
    inputs: dict[str, object] | None = None,
    outputs: dict[str, object] | None = None,
    metrics: dict[str, float] | None = None,
) -> None:
    """Add one row to the report table at path ``table``."""

    def text(values: dict[str, object] | None) -> dict[str, str]:
        return {key: str(value) for key, value in (values or {}).items()}

    context = spark.sparkContext
    row = (
        run_id, stage, float(duration_seconds), datetime.now(timezone.utc),
        context.master, context.defaultParallelism,
        text(inputs), text(outputs), {k: float(v) for k, v in (metrics or {}).items()},
    )
    report = spark.createDataFrame([row], REPORT_SCHEMA).coalesce(1)
    report.write.mode("append").parquet(table)


def read_reports(spark: SparkSession, table: str) -> DataFrame:
    return open_path(lambda: spark.read.schema(REPORT_SCHEMA).parquet(table), table, "run")


def latest_reports(reports: DataFrame) -> DataFrame:
    """The last report of each run and stage: a repeated stage replaces what it reported before.

    Of reports of one time the longer counts. Maxima are combined before the shuffle, so a run or stage
    with very many reports is no large group.
    """
    order = F.struct("created_at_utc", "duration_seconds")
    last = F.max_by(F.struct(*reports.columns), order).alias("last")
    return reports.groupBy("run_id", "stage").agg(last).select("last.*")


def stage_listing(reports: DataFrame, run_id: str | None = None) -> DataFrame:
    """The stages of a run, or of all runs, with their ``place`` in running order and their last report.

    A stage without a report is left out, and so is one of another name.
    """
    if run_id is not None:
        reports = reports.where(F.col("run_id") == run_id)
    place = F.array_position(F.array(*(F.lit(stage) for stage in STAGES)), F.col("stage")).cast("int")
    listed = latest_reports(reports.where(F.col("stage").isin(*STAGES)))
    return listed.withColumn("place", place).orderBy("run_id", "place")


def _folder_of(table: str) -> str:
    return table.rstrip("/").rpartition("/")[0] or table


@contextmanager
def reported(
    spark: SparkSession, table: str | None, run_id: str | None, stage: str, **details: dict
) -> Iterator[dict[str, float]]:
    """Time a stage and add its report to ``table``, if there is one; metrics go into the dict given.

    Without a ``run_id`` the run is named after the folder of the table, so stages that are run one by one and report to
    one table are one run.
    """
    metrics: dict[str, float] = {}
    started = time.perf_counter()
    yield metrics
    if table is not None:
        seconds = time.perf_counter() - started
        append_report(spark, table, run_id or _folder_of(table), stage, seconds, metrics=metrics, **details)


def stage_time_rollup(reports: DataFrame) -> DataFrame:
    """Per run: total seconds up to training and up to prediction, a missing duration being 0.

    Of a repeated stage the last report counts.
    """

    def total(stages: tuple[str, ...]) -> Column:
        seconds = F.coalesce(F.col("duration_seconds"), F.lit(0.0))
        return F.sum(F.when(F.col("stage").isin(*stages), seconds).otherwise(0.0))

    return latest_reports(reports).groupBy("run_id").agg(*(total(s).alias(n) for n, s in _TOTALS.items()))
