"""Random-forest regression on the feature table, with Spark ML."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import CATEGORY_COLUMNS, SERIES_KEY, FeatureConfig, ForestConfig
from shelfcast.functions.columns import non_negative
from shelfcast.operators.split import split_by_time
from shelfcast.operators.summaries import score_values

INDEX_COLUMNS = [f"{name}_idx" for name in CATEGORY_COLUMNS]


def category_counts(rows: DataFrame) -> DataFrame:
    """Rows of each combination of labels, ``rows``: counted where the rows are made, before anything is moved."""
    return rows.groupBy(*CATEGORY_COLUMNS).agg(F.count("*").alias("rows"))


def label_counts(counts: DataFrame) -> DataFrame:
    """``category, label, rows`` with the place of each label as ``index``: by falling rows, ties by name.

    Takes ``category_counts``; a null is no label.
    """
    labels = F.array(*(F.struct(F.lit(c).alias("category"), F.col(c).alias("label")) for c in CATEGORY_COLUMNS))
    each = counts.select(F.inline(labels), "rows").where(F.col("label").isNotNull())
    summed = each.groupBy("category", "label").agg(F.sum("rows").alias("rows"))
    order = Window.partitionBy("category").orderBy(F.desc("rows"), "label")
    return summed.withColumn("index", F.row_number().over(order) - 1)


def category_indexer(rows: DataFrame) -> PipelineModel:
    """One indexer for each category: the index of each label among those of ``rows``; unseen and null labels share the index after the last.

    Only labels and their counts reach the driver, where a model holds them anyway.
    """
    found = label_counts(category_counts(rows)).orderBy("category", "index").collect()
    labels = {c: [r["label"] for r in found if r["category"] == c] for c in CATEGORY_COLUMNS}
    return PipelineModel(stages=[
        StringIndexerModel.from_labels(labels[c], c, index, "keep") for c, index in zip(CATEGORY_COLUMNS, INDEX_COLUMNS)
    ])


def vector_inputs(config: FeatureConfig) -> list[str]:
    return [*config.feature_columns, *INDEX_COLUMNS]


def vector_assembler(config: FeatureConfig) -> VectorAssembler:
    """All model inputs as ``features``; a null becomes NaN and the row is kept."""
    return VectorAssembler(
        inputCols=vector_inputs(config), outputCol="features", handleInvalid="keep"
    )


def forest_regressor(forest: ForestConfig) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol="sales",
        maxBins=forest.max_bins,
        maxDepth=forest.max_depth,
        numTrees=forest.num_trees,
        seed=forest.seed,
    )


def placed_rows(rows: DataFrame, config: FeatureConfig, partitions: int) -> DataFrame:
    """The columns that a fit reads, each row in a place that follows from its content alone.

    Trees draw rows by partition and order, so rows go to partitions by hash of series and day and are sorted
    there. Only model inputs, labels and the series move.
    """
    columns = [SERIES_KEY, *dict.fromkeys([*config.feature_columns, *CATEGORY_COLUMNS, "sales"])]
    needed = rows.select(*columns)
    return needed.repartition(partitions, SERIES_KEY, "day_number").sortWithinPartitions(SERIES_KEY, "day_number", *columns)


def fit_and_score(
    features: DataFrame, last_day: int, config: FeatureConfig, forest: ForestConfig
) -> tuple[PipelineModel, dict[str, float]]:
    """Fit on all but the last ``validation_days`` days and score those.

    ``max_bins`` grows to the number of labels where a category has more than that. Two tables of the same rows give
    the same model, however they are stored.
    """
    training, validation = split_by_time(features, config.validation_days, last_day)
    indexer, assembler = category_indexer(training), vector_assembler(config)
    most_labels = max(len(stage.labels) for stage in indexer.stages)
    forest = replace(forest, max_bins=max(forest.max_bins, most_labels + 1))
    placed = placed_rows(training, config, forest.partitions)
    fitted = forest_regressor(forest).fit(assembler.transform(indexer.transform(placed)))
    model = PipelineModel(stages=[indexer, assembler, fitted])
    return model, score_values(model.transform(validation))


def forecast(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``id, d, prediction`` with predictions of at least 0."""
    scored = model.transform(rows)
    return scored.select("id", "d", non_negative(F.col("prediction")).alias("prediction"))
