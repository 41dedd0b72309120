import glob

import pytest
from panels import DAYS, SERIES

from shelfcast.config import FeatureConfig, ForestConfig
from shelfcast.plans import reports, stages
from shelfcast.plans.features import build_features
from shelfcast.sources import saved
from shelfcast.sources.raw_panel import child_path, read_raw_panel

SMALL = FeatureConfig(lags=(1, 7), rolling_windows=(2,), validation_days=7)
FOREST = ForestConfig(max_depth=3, num_trees=4)


@pytest.mark.parametrize("root", ["hdfs://name:8020/panels/2016", "viewfs://cluster/p", "panels", "file:///p"])
def test_child_path_joins_with_one_slash(root):
    assert child_path(root, "x.csv") == child_path(f"{root}//", "x.csv") == f"{root}/x.csv"


def test_missing_raw_file_is_named(spark, tmp_path):
    with pytest.raises(saved.MissingInputError, match="sales_train_validation.csv"):
        read_raw_panel(spark, str(tmp_path))


def test_missing_stage_outputs_name_the_stage(spark, tmp_path):
    with pytest.raises(saved.MissingInputError, match="nothing at .*/nothing; .*`prepare`"):
        stages.train(spark, f"{tmp_path}/nothing", f"{tmp_path}/model")
    with pytest.raises(saved.MissingInputError, match="`prepare`"):
        stages.profile_scan(spark, f"{tmp_path}/nothing")


def test_missing_model_names_the_stage(spark, raw_dir, tmp_path):
    stages.prepare(spark, raw_dir, f"{tmp_path}/features", SMALL)
    with pytest.raises(saved.MissingInputError, match="model.*`train`"):
        stages.predict(spark, f"{tmp_path}/features", f"{tmp_path}/model", f"{tmp_path}/out")


def test_value_of_a_wrong_type_fails_the_job(spark, raw_dir, tmp_path):
    for path in glob.glob(f"{raw_dir}/*.csv"):
        name = path.rsplit("/", 1)[1]
        text = open(path).read()
        if name.startswith("sales"):
            text = text.replace(",3,", ",three,", 1)
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception, match="(?i)malformed|three"):
        read_raw_panel(spark, str(tmp_path)).sales.collect()


def day_files(path):
    return {f: open(f, "rb").read() for f in glob.glob(f"{path}/day_number=*/part-*.parquet")}


def test_chosen_days_replace_just_those_days(spark, raw_dir, tmp_path):
    path = f"{tmp_path}/features"
    by_day = FeatureConfig(lags=(1, 7), rolling_windows=(2,), partition_by=("day_number",))
    stages.prepare(spark, raw_dir, path, by_day, days=[12, "d_9", 30])
    whole = {tuple(r) for r in saved.read_features(spark, path).select(*by_day.table_columns).collect()}
    assert {r[by_day.table_columns.index("day_number")] for r in whole} == {9, 12, 30} and len(whole) == 3 * SERIES
    before = day_files(path)
    stages.prepare(spark, raw_dir, path, by_day, days=["d_12", 20])
    after = day_files(path)
    assert {f for f in before if "=12/" not in f} <= after.keys()
    assert all(before[f] == after[f] for f in before if "=12/" not in f)
    assert not any(f in after for f in before if "=12/" in f)
    again = saved.read_features(spark, path).select(*by_day.table_columns).collect()
    assert whole <= {tuple(r) for r in again} and len(again) == 4 * SERIES
    built = build_features(*read_raw_panel(spark, raw_dir), FeatureConfig(lags=(1, 7), rolling_windows=(2,)))
    assert {tuple(r) for r in again} == {tuple(r) for r in built.where("day_number IN (9, 12, 20, 30)").collect()}


def test_a_chosen_day_without_rows_goes(spark, raw_dir, tmp_path):
    path = f"{tmp_path}/features"
    by_day = FeatureConfig(lags=(1,), rolling_windows=(), partition_by=("day_number",))
    stages.prepare(spark, raw_dir, path, by_day, days=[9, 12])
    features = saved.read_features(spark, path)
    saved.replace_days(features.where("false"), path, [12])
    assert {r["day_number"] for r in saved.read_features(spark, path).select("day_number").distinct().collect()} == {9}


def test_single_days_need_a_table_by_day(spark, raw_dir, tmp_path):
    with pytest.raises(ValueError, match="partition_by"):
        stages.prepare(spark, raw_dir, f"{tmp_path}/features", SMALL, days=[9])


@pytest.mark.parametrize("layout", [
    {"output_partitions": 3}, {"partition_by": ("state_id",)}, {"partition_by": ("day_number",)},
    {"partition_by": ("store_id", "month")}, {"output_partitions": 4, "partition_by": ("cat_id",)}, {"auto_partitions": True},
])
def test_files_are_laid_out_before_the_long_rows_are_made(spark, raw_dir, tmp_path, layout):
    config = FeatureConfig(lags=(1, 7), rolling_windows=(2,), **layout)
    features = build_features(*read_raw_panel(spark, raw_dir), config)
    above = features._jdf.queryExecution().executedPlan().toString().split("Generate")[0]
    assert "Exchange" not in above.replace("BroadcastExchange", "")
    plain = build_features(*read_raw_panel(spark, raw_dir), FeatureConfig(lags=(1, 7), rolling_windows=(2,)))
    assert sorted(map(tuple, features.collect())) == sorted(map(tuple, plain.collect()))
    saved.write_features(features, f"{tmp_path}/f", config, laid_out=True)
    assert saved.read_features(spark, f"{tmp_path}/f").count() == features.count()
    if layout == {"partition_by": ("day_number",)}:
        files = glob.glob(f"{tmp_path}/f/day_number=*/part-*.parquet")
        assert len(files) == len(glob.glob(f"{tmp_path}/f/day_number=*"))


def test_stages_run_one_by_one_share_the_folder_of_their_reports(spark, raw_dir, tmp_path):
    table, features = f"{tmp_path}/run_reports", f"{tmp_path}/features"
    stages.prepare(spark, raw_dir, features, SMALL, reports=table)
    stages.train(spark, features, f"{tmp_path}/model", SMALL, FOREST, reports=table)
    total = reports.stage_time_rollup(reports.read_reports(spark, table)).collect()
    assert [r["run_id"] for r in total] == [str(tmp_path)]
    assert total[0]["prepare_train_seconds"] == total[0]["prepare_train_predict_seconds"] > 0


def test_output_partitions(spark, raw_dir, tmp_path):
    path = f"{tmp_path}/features"
    config = FeatureConfig(lags=(1,), rolling_windows=(), output_partitions=3)
    stages.prepare(spark, raw_dir, path, config)
    assert len(glob.glob(f"{path}/part-*.parquet")) == 3
    parallelism = spark.sparkContext.defaultParallelism
    assert saved.output_partitions(spark, FeatureConfig(auto_partitions=True)) == max(
        32, 4 * parallelism
    )
    assert saved.output_partitions(spark, FeatureConfig()) is None


def test_directories_by_month(spark, raw_dir, tmp_path):
    path = f"{tmp_path}/features"
    config = FeatureConfig(lags=(1,), rolling_windows=(), partition_by=("year", "month"))
    stages.prepare(spark, raw_dir, path, config)
    assert {p.split("month=")[1][0] for p in glob.glob(f"{path}/year=2016/*/*.parquet")} == {"5", "6"}
    table = saved.read_features(spark, path)
    assert set(table.columns) == set(config.table_columns)
    assert dict(table.dtypes)["year"] == "int" and table.count() == SERIES * (DAYS - 1)


def test_ids_of_directories_stay_text(spark, tmp_path):
    frame = spark.createDataFrame([("01", "x", 1.5)], "store_id string, id string, sales double")
    frame.write.partitionBy("store_id").parquet(f"{tmp_path}/features")
    assert saved.read_features(spark, f"{tmp_path}/features").select("store_id", "sales").collect() == [("01", 1.5)]


def test_fractional_sales_are_prepared(spark, raw_dir, tmp_path):
    for path in glob.glob(f"{raw_dir}/*.csv"):
        text = open(path).read()
        (tmp_path / path.rsplit("/", 1)[1]).write_text(text.replace(",3,", ",3.5,") if "sales_" in path else text)
    config = FeatureConfig(lags=(1,), rolling_windows=())
    for kind in ({"day_type": "double"}, {"infer": True}):
        folder = f"{tmp_path}/{next(iter(kind))}"
        stages.prepare(spark, str(tmp_path), folder, config, **kind)
        assert saved.read_features(spark, folder).where("sales = 3.5").count() > 0


def test_whole_run(spark, raw_dir, tmp_path):
    work = f"{tmp_path}/work"
    totals = stages.run(spark, raw_dir, work, SMALL, FOREST, horizon=5, run_id="first").collect()
    predictions = saved.read_predictions(spark, f"{work}/predictions").collect()
    assert len(predictions) == SERIES * 5
    assert {r["d"] for r in predictions} == {f"d_{n}" for n in range(DAYS - 4, DAYS + 1)}
    assert all(r["prediction"] >= 0 for r in predictions)

    table = reports.read_reports(spark, f"{work}/run_reports")
    listed = reports.stage_listing(table, "first").collect()
    assert [r["stage"] for r in listed] == ["prepare", "train", "predict", "benchmark"]
    assert set(listed[1]["metrics"]) == {"rmse", "mae"}
    assert listed[3]["metrics"]["input_rows"] == SERIES * (DAYS - 7)
    assert listed[3]["metrics"]["aggregation_groups"] == 2
    assert listed[3]["metrics"]["input_partitions"] >= 1
    seconds = {r["stage"]: r["duration_seconds"] for r in listed}
    assert totals[0]["run_id"] == "first" and len(totals) == 1
    assert totals[0]["prepare_train_seconds"] == pytest.approx(
        seconds["prepare"] + seconds["train"]
    )
    assert totals[0]["prepare_train_predict_seconds"] == pytest.approx(
        seconds["prepare"] + seconds["train"] + seconds["predict"]
    )

    stages.run(spark, raw_dir, work, SMALL, FOREST, benchmark=False, run_id="second")
    table = reports.read_reports(spark, f"{work}/run_reports")
    assert reports.stage_listing(table, "second").count() == 3


def test_a_repeated_stage_counts_with_its_last_report(spark, tmp_path):
    path = f"{tmp_path}/reports"
    for run, stage, seconds in (
        ("a", "prepare", 10), ("a", "prepare", 12), ("a", "train", 5), ("b", "predict", 1.25), ("b", "cleanup", 70),
    ):
        reports.append_report(spark, path, run, stage, seconds)
    table = reports.read_reports(spark, path)
    rows = {r["run_id"]: tuple(r)[1:] for r in reports.stage_time_rollup(table).collect()}
    assert rows == {"a": (17.0, 17.0), "b": (0.0, 1.25)}
    listed = [(r["run_id"], r["place"], r["duration_seconds"]) for r in reports.stage_listing(table).collect()]
    assert listed == [("a", 1, 12.0), ("a", 2, 5.0), ("b", 3, 1.25)]


def test_single_stages_report_themselves(spark, raw_dir, tmp_path):
    features, table = f"{tmp_path}/features", f"{tmp_path}/reports"
    stages.prepare(spark, raw_dir, features, SMALL, reports=table, run_id="r")
    found = stages.profile_scan(spark, features, reports=table, run_id="r")
    listed = reports.stage_listing(reports.read_reports(spark, table), "r").collect()
    assert [r["stage"] for r in listed] == ["prepare", "benchmark"]
    assert listed[1]["metrics"] == {k: float(v) for k, v in found.items()}


def test_rollup_takes_a_missing_duration_as_zero(spark):
    table = spark.createDataFrame(
        [("a", "prepare", None, None), ("a", "train", 2.0, None)],
        "run_id string, stage string, duration_seconds double, created_at_utc timestamp",
    )
    assert tuple(reports.stage_time_rollup(table).first()) == ("a", 2.0, 2.0)


def test_scratch_path_follows_the_session():
    class Session:
        class conf:
            setting = None

            @classmethod
            def get(cls, key, default):
                assert key == "spark.checkpoint.dir"
                return cls.setting or default

        class sparkContext:
            master = "spark://host:7077"
            _jsc = None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        saved.scratch_path(Session, "x")
    Session.conf.setting = "hdfs://shared/tmp/"
    first, second = saved.scratch_path(Session, "x"), saved.scratch_path(Session, "x")
    assert first.startswith("hdfs://shared/tmp/x-") and first != second
