import pytest

from shelfcast.operators import split, summaries


def days(spark, *numbers):
    return spark.createDataFrame([(n, float(n)) for n in numbers], "day_number int, sales double")


def test_split_holds_out_the_last_days(spark):
    train, validation = split.split_by_time(days(spark, *range(1, 11)), 3)
    assert sorted(r[0] for r in train.collect()) == list(range(1, 8))
    assert sorted(r[0] for r in validation.collect()) == [8, 9, 10]


def test_split_label_and_known_last_day(spark):
    labelled = split.with_split_label(days(spark, 1, 2, 3, 4), 1)
    assert {r["day_number"]: r["split"] for r in labelled.collect()} == {
        1: "train", 2: "train", 3: "train", 4: "validation"
    }
    train, validation = split.split_by_time(days(spark, 1, 2, 3), 1, known_last_day=10)
    assert (train.count(), validation.count()) == (3, 0)


def test_scoring_window(spark):
    recent = split.scoring_window(days(spark, 1, 2, 5, 9, 10), 2)
    assert sorted(r[0] for r in recent.collect()) == [9, 10]


def test_empty_table_fails_clearly(spark):
    empty = days(spark, 1).where("day_number > 1")
    assert split.last_day(empty).first()["max_day"] is None
    with pytest.raises(ValueError, match="no last day"):
        split.last_day_value(empty)
    with pytest.raises(Exception, match="no last day"):
        split.split_by_time(empty, 1)[0].collect()


def test_scores_skip_null_pairs(spark):
    rows = [(1.0, 2.0), (3.0, 1.0), (None, 5.0), (4.0, None)]
    frame = spark.createDataFrame(rows, "y double, p double")
    scores = summaries.score_values(frame, "y", "p")
    assert scores == pytest.approx({"rmse": 2.5**0.5, "mae": 1.5})


def test_scores_of_nothing_fail_clearly(spark):
    frame = spark.createDataFrame([(None, 1.0)], "sales double, prediction double")
    with pytest.raises(ValueError, match="to score"):
        summaries.score_values(frame)
