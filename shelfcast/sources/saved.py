"""What one stage leaves for the next: features, predictions, models."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import cache
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfcast.config import FeatureConfig
from shelfcast.operators.packed import output_partitions

T = TypeVar("T")


class MissingInputError(RuntimeError):
    """A path that a stage needs is not there."""


def open_path(read: Callable[[], T], path: str, made_by: str | None = None) -> T:
    """Run a reader; a missing path becomes an error that says which stage writes it."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        found = "nothing" if error.getCondition() == "PATH_NOT_FOUND" else "no readable table"
        origin = f"; it is what `{made_by}` writes" if made_by else ""
        raise MissingInputError(f"there is {found} at {path}{origin}") from error


# The text columns of a feature table.
_TEXT_COLUMNS = ("d", "id", "item_id", "dept_id", "cat_id", "store_id", "state_id")


def read_features(spark: SparkSession, directory: str) -> DataFrame:
    """The stored table. Ids that became directories are read as text, so ``01`` does not turn into 1."""
    found = open_path(lambda: spark.read.parquet(directory), directory, "prepare").schema
    fields = [
        StructField(f.name, StringType()) if f.name in _TEXT_COLUMNS else f for f in found.fields
    ]
    return spark.read.schema(StructType(fields)).parquet(directory)


#: The layout in which single days can be replaced: a directory for each day.
BY_DAY = ("day_number",)


def replace_days(features: DataFrame, directory: str, days: Sequence[int], *, laid_out: bool = False) -> None:
    """Write the features of some days into a table with a directory for each day, in place of what it has of them.

    Files of other days are not touched, and a second run leaves the same table. A day that has no rows any more
    goes: of the days' directories, those that the write has left as they were are removed after it.
    """
    spark = features.sparkSession
    before = _files_of_days(spark, directory, days)
    features = features.where(F.col("day_number").isin(list(days)))
    if not laid_out:
        features = features.hint("rebalance", *BY_DAY)
    features.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*BY_DAY).parquet(directory)
    after = _files_of_days(spark, directory, days)
    for day, files in before.items():
        if files and after[day] == files:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/day_number={day}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _files_of_days(spark: SparkSession, directory: str, days: Sequence[int]) -> dict[int, set[str]]:
    """The names of the data files of each day; names are never used again by a write."""
    found = {}
    for day in days:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/day_number={day}")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        entries = system.listStatus(path) if system.exists(path) else []
        found[day] = {entry.getPath().getName() for entry in entries}
    return found


def write_features(features: DataFrame, directory: str, config: FeatureConfig, *, laid_out: bool = False) -> None:
    """One write for all days, or for the chosen days of a table by day, whose other days stay.

    Features that ``assemble`` built with this ``config`` are ``laid_out``: its long rows come out in the task that
    writes them. Other frames are shuffled if the files ask for it: a given number of files is filled by hash of series
    and day, directories without a number of files are balanced at run time.
    """
    if config.days is not None and config.partition_by == BY_DAY:
        return replace_days(features, directory, config.days, laid_out=laid_out)
    files = output_partitions(features.sparkSession, config)
    if files is not None and not laid_out:
        features = features.repartition(files, "id", "day_number")
    elif config.partition_by and not laid_out:
        features = features.hint("rebalance", *config.partition_by)
    writer = features.write.mode("overwrite")
    if config.partition_by:
        writer = writer.partitionBy(*config.partition_by)
    writer.parquet(directory)


def load_model(spark: SparkSession, directory: str) -> PipelineModel:
    open_path(lambda: spark.read.text(f"{directory.rstrip('/')}/metadata"), directory, "train")
    return PipelineModel.load(directory)


def save_model(model: PipelineModel, directory: str) -> None:
    model.write().overwrite().save(directory)


def write_predictions(predictions: DataFrame, directory: str) -> None:
    predictions.select("id", "d", "prediction").write.mode("overwrite").csv(directory, header=True)


def read_predictions(spark: SparkSession, directory: str) -> DataFrame:
    schema = "id string, d string, prediction double"
    return open_path(
        lambda: spark.read.csv(directory, header=True, schema=schema), directory, "predict"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own machine, which goes
    when Python ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or _set_folder(spark)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder().name
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _set_folder(spark: SparkSession) -> str | None:
    """The folder given by ``SparkContext.setCheckpointDir``, if any."""
    context = getattr(spark.sparkContext, "_jsc", None)
    found = context.sc().getCheckpointDir() if context is not None else None
    return found.get() if found is not None and found.isDefined() else None


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="shelfcast-", ignore_cleanup_errors=True)
