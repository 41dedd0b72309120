import math

import pytest
from panels import wide_frame
from pyspark.ml.functions import vector_to_array
from test_features import calendar_frame, price_frame

from shelfcast.config import CATEGORY_COLUMNS, FeatureConfig, ForestConfig
from shelfcast.operators.split import last_day_value, split_by_time
from shelfcast.operators.summaries import score_values
from shelfcast.plans.features import build_features
from shelfcast.plans.forest import (
    INDEX_COLUMNS,
    category_indexer,
    fit_and_score,
    forecast,
    vector_assembler,
    vector_inputs,
)
from pyspark.sql import functions as F


def categories(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CATEGORY_COLUMNS))


def test_index_by_frequency_then_name_with_unseen_last(spark):
    seen = categories(spark, [("b", "x", "s", "t")] * 2 + [("a", "x", "s", "t")] * 2
                      + [("c", "x", "s", "t")] * 3)
    model = category_indexer(seen)
    asked = categories(spark, [(v, "x", "s", "t") for v in ("c", "a", "b", "new", None)])
    found = [r["dept_id_idx"] for r in model.transform(asked).select(*INDEX_COLUMNS).collect()]
    assert found == [0.0, 1.0, 2.0, 3.0, 3.0]


def test_vector_keeps_rows_with_nulls_as_nan(spark):
    config = FeatureConfig(lags=(1,), rolling_windows=())
    names = vector_inputs(config)
    schema = ", ".join(f"{n} double" for n in names)
    frame = spark.createDataFrame([tuple([None, *map(float, range(1, len(names)))])], schema)
    values = vector_assembler(config).transform(frame).select(vector_to_array("features")).first()[0]
    assert math.isnan(values[0]) and values[1:] == [float(n) for n in range(1, len(names))]


@pytest.fixture(scope="module")
def features(spark):
    sales = [[(s * 3 + n) % 7 + (5 if s % 2 else 0) for n in range(90)] for s in range(8)]
    config = FeatureConfig(lags=(1, 7), rolling_windows=(7,))
    frame = build_features(
        wide_frame(spark, sales), calendar_frame(spark, 90), price_frame(spark, 8, 13), config
    )
    return frame.cache(), config


def test_forest_beats_the_mean(spark, features):
    frame, config = features
    last = last_day_value(frame)
    model, scores = fit_and_score(frame, last, config, ForestConfig(max_depth=4, num_trees=10))
    training, validation = split_by_time(frame, config.validation_days, last)
    mean = training.agg(F.avg("sales")).first()[0]
    baseline = score_values(validation.withColumn("prediction", F.lit(mean)))
    assert scores["rmse"] < baseline["rmse"] and scores["mae"] < baseline["mae"]

    predictions = forecast(model, validation)
    assert predictions.columns == ["id", "d", "prediction"]
    assert predictions.count() == validation.count()
    assert predictions.where("prediction < 0 OR prediction IS NULL").count() == 0


def test_the_fit_does_not_depend_on_how_the_table_is_stored(spark, features):
    frame, config = features
    last, forest = last_day_value(frame), ForestConfig(max_depth=5, num_trees=8, partitions=5)
    layouts = frame.repartition(3, "sales"), frame.orderBy(F.desc("day_number"), "id").coalesce(1)
    found = []
    for layout in layouts:
        model, scores = fit_and_score(layout, last, config, forest)
        found.append((sorted(map(tuple, forecast(model, frame).collect())), model.stages[-1].toDebugString.split("\n", 1)[1]))
        assert scores["rmse"] > 0
    assert found[0] == found[1]


def test_the_indexer_equals_one_fitted_by_counting_rows(spark, features):
    from pyspark.ml.feature import StringIndexer

    frame, _ = features
    fitted = StringIndexer(inputCols=list(CATEGORY_COLUMNS), outputCols=INDEX_COLUMNS, handleInvalid="keep").fit(frame)
    assert [list(stage.labels) for stage in category_indexer(frame).stages] == [list(x) for x in fitted.labelsArray]


def test_unseen_category_is_scored(spark, features):
    frame, config = features
    model, _ = fit_and_score(frame, last_day_value(frame), config, ForestConfig(2, 3))
    row = frame.limit(1).withColumn("store_id", F.lit("new store"))
    assert forecast(model, row).first()["prediction"] >= 0.0


def test_a_category_of_more_labels_than_bins_is_fitted(spark):
    sales = [[(s + n) % 5 for n in range(40)] for s in range(40)]
    config = FeatureConfig(lags=(1,), rolling_windows=(), validation_days=5)
    frame = build_features(
        wide_frame(spark, sales), calendar_frame(spark, 40), price_frame(spark, 40, 6), config
    ).withColumn("store_id", F.col("item_id"))
    assert frame.select("store_id").distinct().count() == 40
    model, scores = fit_and_score(frame, 40, config, ForestConfig(max_depth=2, num_trees=2))
    assert model.stages[-1].getOrDefault("maxBins") == 41 and scores["rmse"] >= 0
