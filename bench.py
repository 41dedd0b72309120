"""Times the headline queries and prints one JSON line.

Each query is written whole to a sink that drops its rows, so nothing is pruned. ``BENCH_SF_DIR``,
``BENCH_CPUS`` and ``BENCH_RUNS`` choose tables, cores and repetitions; the median counts. All but the fit,
which runs once, have one run before that is not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfcast.config import FeatureConfig, ForestConfig  # noqa: E402
from shelfcast.operators.split import last_day_value  # noqa: E402
from shelfcast.plans.forest import fit_and_score, forecast  # noqa: E402
from shelfcast.plans.features import build_features  # noqa: E402
from shelfcast.plans.stages import profile_scan  # noqa: E402
from shelfcast.operators.split import scoring_window  # noqa: E402
from shelfcast.queries import QUERIES, features_of  # noqa: E402
from shelfcast.operators.history import history_long, history_wide  # noqa: E402
from shelfcast.operators.prices import join_prices  # noqa: E402
from shelfcast.operators.calendar import calendar_features, join_calendar, numbered_days  # noqa: E402
from shelfcast.sources.order_lines import OrderLinePanel  # noqa: E402
from shelfcast.sources.raw_panel import (  # noqa: E402
    CALENDAR_FILE,
    PRICES_FILE,
    SALES_FILE,
    read_raw_panel,
)
from shelfcast.sources.saved import read_features, scratch_path, write_features  # noqa: E402

CONFIG = FeatureConfig()


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfcast-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    # The panel as files: raw CSV for the stages that start there, Parquet for single operators.
    panel = OrderLinePanel(spark, sf_dir)
    raw, stored = scratch_path(spark, "raw"), scratch_path(spark, "stored")
    panel.wide().write.csv(f"{raw}/{SALES_FILE}", header=True)
    panel.calendar().write.csv(f"{raw}/{CALENDAR_FILE}", header=True)
    panel.prices().write.csv(f"{raw}/{PRICES_FILE}", header=True)
    panel.long().write.parquet(f"{stored}/long")
    features_dir = f"{stored}/features"
    write_features(features_of(panel), features_dir, FeatureConfig(auto_partitions=True))
    features = read_features(spark, features_dir)
    fitted = {}

    def price_join():
        sales, calendar, prices = read_raw_panel(spark, raw, day_type="double")
        days = numbered_days(calendar_features(calendar))
        long = spark.read.parquet(f"{stored}/long")
        drain(join_prices(join_calendar(long, days), prices))

    def fit():
        fitted["model"], _ = fit_and_score(features, last_day_value(features), CONFIG, ForestConfig())

    def score():
        drain(forecast(fitted["model"], scoring_window(features, 28, last_day_value(features))))

    def query(name):
        return lambda: drain(QUERIES[name](spark, sf_dir))

    measured = {
        "feature_table": query("feature_table"),
        "feature_table_recent": query("feature_table_recent"),
        "features_from_csv": lambda: drain(build_features(*read_raw_panel(spark, raw, day_type="double"), CONFIG)),
        "history_wide": lambda: drain(history_wide(read_raw_panel(spark, raw, day_type="double").sales, CONFIG)),
        "history_long": lambda: drain(history_long(spark.read.parquet(f"{stored}/long"), CONFIG)),
        "panel_price_join": price_join,
        "group_profile": lambda: profile_scan(spark, features_dir),
        "split_sizes": query("split_sizes"),
        "stage_time_rollup": query("stage_time_rollup"),
        "category_index": query("category_index"),
        "forest_fit": fit,
        "forest_score": score,
    }
    seconds = {}
    for name, run in measured.items():
        times = []
        if name != "forest_fit":
            run()  # compiles, untimed
        for _ in range(1 if name == "forest_fit" else runs):
            started = time.perf_counter()
            run()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
