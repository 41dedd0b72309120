"""For each registered query the same result as plain SQL over the tables."""

from __future__ import annotations

_PANEL = """
WITH bounds AS (
  SELECT min(CAST(l_shipdate AS DATE)) AS first_date, max(CAST(l_shipdate AS DATE)) AS last_date
  FROM lineitem
),
panel_base AS (
  SELECT p_brand AS item_id,
         'DEPT_' || (CAST(substr(p_brand, 7) AS INT) % 7) AS dept_id,
         'CAT_' || (CAST(substr(p_brand, 7) AS INT) % 3) AS cat_id,
         n_name AS store_id, r_name AS state_id, p_brand || '_' || n_name AS id,
         CAST(date_diff('day', first_date, CAST(l_shipdate AS DATE)) + 1 AS INT) AS day_number,
         l_quantity AS sales, p_retailprice
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN bounds
),
spine AS (
  SELECT CAST(n AS INT) AS day_number, CAST(first_date + CAST(n - 1 AS INT) AS DATE) AS date
  FROM bounds, range(1, date_diff('day', first_date, last_date) + 2) AS days(n)
),
panel_series AS (
  SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM panel_base
),
panel_long AS (
  SELECT s.*, 'd_' || g.day_number AS d, g.day_number, coalesce(b.sales, 0.0) AS sales
  FROM panel_series s CROSS JOIN spine g
  LEFT JOIN (SELECT id, day_number, sum(sales) AS sales FROM panel_base GROUP BY ALL) b
  ON b.id = s.id AND b.day_number = g.day_number
),
calendar AS (
  SELECT 'd_' || day_number AS d, day_number,
         CAST(1 + (day_number - 1) // 7 AS INT) AS wm_yr_wk,
         CAST((day_number - 1) % 7 + 1 AS INT) AS wday,
         CAST(month(date) AS INT) AS month, CAST(year(date) AS INT) AS year,
         CASE WHEN day(date) <= 5 OR day(date) IN (10, 20) OR day(date) % 15 = 0
              THEN 1 ELSE 0 END AS snap
  FROM spine
),
prices AS (
  SELECT store_id, item_id, CAST(1 + (day_number - 1) // 7 AS INT) AS wm_yr_wk,
         max(p_retailprice) AS sell_price
  FROM panel_base GROUP BY ALL
),
history AS (
  SELECT *,
         max(sales) OVER (PARTITION BY id ORDER BY day_number
                          RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING) AS lag_7,
         max(sales) OVER (PARTITION BY id ORDER BY day_number
                          RANGE BETWEEN 14 PRECEDING AND 14 PRECEDING) AS lag_14,
         max(sales) OVER (PARTITION BY id ORDER BY day_number
                          RANGE BETWEEN 28 PRECEDING AND 28 PRECEDING) AS lag_28,
         CASE WHEN day_number > 7 THEN sum(sales) OVER (PARTITION BY id ORDER BY day_number
              RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) / CAST(7 AS DOUBLE) END AS rolling_mean_7,
         CASE WHEN day_number > 28 THEN sum(sales) OVER (PARTITION BY id ORDER BY day_number
              RANGE BETWEEN 28 PRECEDING AND 1 PRECEDING) / CAST(28 AS DOUBLE) END AS rolling_mean_28
  FROM panel_long
)"""

# The five 64-bit primes of XXH64.
_PRIMES = (
    11400714785074694791,
    14029467366897019727,
    1609587929392839161,
    9650029242287828579,
    2870177450012600261,
)
_SEED = 42


def _wrapped(text: str) -> str:
    return f"(({text}) % 18446744073709551616::UHUGEINT)"


def _times(text: str, prime: int) -> str:
    return _wrapped(f"{text} * {_PRIMES[prime - 1]}::UHUGEINT")


def _plus(text: str, number: int | str) -> str:
    return _wrapped(f"{text} + {number}::UHUGEINT")


def _item_hash() -> str:
    """CTEs hashing each brand with XXH64, seed 42, for names of up to 15 bytes.

    A name is eaten as one lane of 8 bytes if it has them, one of 4 if that many are left, and single
    bytes. ``h`` and ``rest`` are the state after each step.
    """
    steps: list[str] = []

    def step(name: str, source: str, **values: str) -> None:
        kept = [f"{text} AS {column}" for column, text in values.items()]
        steps.append(f"{name} AS (SELECT * REPLACE ({', '.join(kept)}) FROM {source})")

    def rotated(text: str, bits: int) -> str:
        return f"({_wrapped(f'{text} * {2**bits}::UHUGEINT')} + {text} // {2 ** (64 - bits)}::UHUGEINT)"

    def lane(width: int) -> str:
        parts = (
            f"ascii(substr(rest, {n + 1}, 1))::UHUGEINT * {256**n}::UHUGEINT" for n in range(width)
        )
        return f"({' + '.join(parts)})"

    def when(width: int, text: str, otherwise: str) -> str:
        return f"CASE WHEN length(rest) >= {width} THEN {text} ELSE {otherwise} END"

    steps.append(
        "hash_0 AS (SELECT DISTINCT p_brand AS item_id, p_brand AS rest, 0::UHUGEINT AS lane, "
        f"({_SEED + _PRIMES[4]}::UHUGEINT + length(p_brand)::UHUGEINT) AS h FROM part)"
    )
    step("hash_1", "hash_0", lane=when(8, _times(lane(8), 2), "lane"))
    step("hash_2", "hash_1", lane=_times(rotated("lane", 31), 1))
    step("hash_3", "hash_2", h=when(8, "xor(h, lane)", "h"))
    step(
        "hash_4", "hash_3",
        h=when(8, _plus(_times(rotated("h", 27), 1), _PRIMES[3]), "h"),
        rest=when(8, "substr(rest, 9)", "rest"),
    )
    step("hash_5", "hash_4", h=when(4, f"xor(h, {_times(lane(4), 1)})", "h"))
    step(
        "hash_6", "hash_5",
        h=when(4, _plus(_times(rotated("h", 23), 2), _PRIMES[2]), "h"),
        rest=when(4, "substr(rest, 5)", "rest"),
    )
    last = "hash_6"
    for n in range(3):
        step(f"hash_{7 + 2 * n}", last, h=when(1, f"xor(h, {_times(lane(1), 5)})", "h"))
        last = f"hash_{8 + 2 * n}"
        step(
            last, f"hash_{7 + 2 * n}",
            h=when(1, _times(rotated("h", 11), 1), "h"), rest=when(1, "substr(rest, 2)", "rest"),
        )
    for name, shift, prime in (("mix_1", 33, 2), ("mix_2", 29, 3)):
        step(name, last, h=_times(f"xor(h, h // {2**shift}::UHUGEINT)", prime))
        last = name
    step("mix_3", last, h=f"xor(h, h // {2**32}::UHUGEINT)")
    steps.append("item_hash AS (SELECT item_id, CAST(h % 1024 AS DOUBLE) AS item_hash FROM mix_3)")
    return ",\n".join(steps)


_FEATURES = f"""{_PANEL},
{_item_hash()},
joined AS (
  SELECT h.* EXCLUDE (day_number), h.day_number, c.wm_yr_wk, c.wday, c.month, c.year, c.snap,
         coalesce(p.sell_price, 0.0) AS sell_price, i.item_hash
  FROM history h LEFT JOIN calendar c ON h.day_number = c.day_number
  LEFT JOIN prices p
  ON p.store_id = h.store_id AND p.item_id = h.item_id AND p.wm_yr_wk = c.wm_yr_wk
  LEFT JOIN item_hash i ON i.item_id = h.item_id
),
features AS (SELECT * FROM joined WHERE rolling_mean_28 IS NOT NULL AND lag_28 IS NOT NULL
             AND lag_14 IS NOT NULL AND lag_7 IS NOT NULL AND rolling_mean_7 IS NOT NULL
             AND wday IS NOT NULL AND sales IS NOT NULL)"""

_TABLE = (
    "store_id, item_id, wm_yr_wk, d, id, dept_id, cat_id, state_id, sales, lag_7, lag_14, lag_28, "
    "rolling_mean_7, rolling_mean_28, day_number, wday, month, year, snap, sell_price, item_hash"
)
_HISTORY = "id, d, day_number, sales, lag_7, lag_14, lag_28, rolling_mean_7, rolling_mean_28"
_LAST = "(SELECT max(day_number) FROM spine)"


def _indexes(category: str) -> str:
    return (
        f"SELECT '{category}' AS category, {category} AS label, CAST(row_number() OVER "
        f"(ORDER BY count(*) DESC, {category}) - 1 AS INT) AS index, count(*) AS rows "
        f"FROM features GROUP BY {category}"
    )


def _vector() -> str:
    numeric = (
        "item_hash", "day_number", "wday", "month", "year", "snap", "sell_price", "lag_7", "lag_14",
        "lag_28", "rolling_mean_7", "rolling_mean_28",
    )
    categories = ("dept_id", "cat_id", "store_id", "state_id")
    indexes = ", ".join(f"index_{c} AS ({_indexes(c)})" for c in categories)
    columns = [f"CAST(f.{c} AS DOUBLE) AS v_{c}" for c in numeric]
    columns += [f"CAST(i_{c}.index AS DOUBLE) AS v_{c}_idx" for c in categories]
    joins = " ".join(f"JOIN index_{c} i_{c} ON i_{c}.label = f.{c}" for c in categories)
    return f"{_FEATURES}, {indexes} SELECT f.id, f.d, {', '.join(columns)} FROM features f {joins}"


# The last report of each run and stage; of one time the longer.
_REPORTS = """WITH reports AS (
  SELECT user_id AS run_id, ts, value,
         CASE event_type WHEN 'view' THEN 'prepare' WHEN 'click' THEN 'train' WHEN 'purchase' THEN 'predict'
                         WHEN 'signup' THEN 'benchmark' ELSE 'other' END AS stage
  FROM events
), latest AS (
  SELECT * FROM reports QUALIFY row_number() OVER (
    PARTITION BY run_id, stage ORDER BY ts DESC NULLS LAST, value DESC NULLS LAST) = 1
)"""

ORACLES: dict[str, str] = {
    "csv_round_trip": f"""{_PANEL}
SELECT l.id, l.d, l.sales, c.wm_yr_wk, p.sell_price
FROM panel_long l JOIN calendar c ON l.d = c.d LEFT JOIN prices p
ON p.store_id = l.store_id AND p.item_id = l.item_id AND p.wm_yr_wk = c.wm_yr_wk""",
    "feature_round_trip": f"""{_FEATURES}
SELECT id, d, sales, lag_28, rolling_mean_28, snap, sell_price FROM features""",
    "prediction_round_trip": f"""{_FEATURES}
SELECT id, d, lag_28 AS prediction FROM features
WHERE day_number > (SELECT max(day_number) FROM features) - 28""",
    "panel_recent_days": f"{_PANEL} SELECT {_HISTORY} FROM history WHERE day_number > {_LAST} - 128",
    "calendar_snap": f"{_PANEL} SELECT d, wm_yr_wk, wday, month, year, snap FROM calendar",
    "item_bucket": f"""{_PANEL}, {_item_hash()}
SELECT b.item_id, count(*) AS lines, any_value(i.item_hash) AS item_hash
FROM panel_base b JOIN item_hash i ON b.item_id = i.item_id GROUP BY b.item_id""",
    "day_number_parse": f"{_PANEL} SELECT d, CAST(substr(d, 3) AS INT) AS day_number FROM calendar",
    "clamp_predictions": f"""{_PANEL}
SELECT id, day_number, greatest(coalesce(lag_7 * 2 - lag_14, 0.0), 0.0) AS prediction
FROM history""",
    "complete_rows": f"{_FEATURES} SELECT id, day_number, lag_28, rolling_mean_28 FROM features",
    "split_label": f"""{_PANEL}
SELECT id, day_number, sales,
       CASE WHEN day_number <= {_LAST} - 28 THEN 'train' ELSE 'validation' END AS split
FROM panel_long""",
    "split_sizes": f"""{_PANEL}
SELECT CASE WHEN day_number <= {_LAST} - 28 THEN 'train' ELSE 'validation' END AS split,
       count(*) AS rows, min(day_number) AS first_day, max(day_number) AS last_day,
       sum(sales) AS sales
FROM panel_long GROUP BY 1""",
    "score_window": f"""{_PANEL}
SELECT id, d, day_number, sales, lag_28 FROM history WHERE day_number > {_LAST} - 28""",
    "panel_unpivot": f"""{_PANEL}
SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, sales
FROM panel_long""",
    "panel_union": f"{_PANEL} SELECT id, d, sales FROM panel_long",
    "lag_features": f"{_PANEL} SELECT id, day_number, lag_7, lag_14, lag_28 FROM history",
    "trailing_means": f"{_PANEL} SELECT id, day_number, rolling_mean_7, rolling_mean_28 FROM history",
    "trailing_mean_quarter": f"""{_PANEL}
      SELECT id, day_number, CASE WHEN day_number > 90 THEN round(sum(sales) OVER (PARTITION BY id ORDER BY day_number
        RANGE BETWEEN 90 PRECEDING AND 1 PRECEDING) / CAST(90 AS DOUBLE), 6) END AS rolling_mean_90 FROM panel_long""",
    "history_wide": f"{_PANEL} SELECT {_HISTORY} FROM history",
    "history_long": f"{_PANEL} SELECT {_HISTORY} FROM history",
    "price_week_prune": f"""{_PANEL}
SELECT store_id, item_id, wm_yr_wk, sell_price FROM prices
WHERE wm_yr_wk IN (SELECT wm_yr_wk FROM calendar WHERE day_number > {_LAST} - 128)""",
    "panel_calendar_join": f"""{_PANEL}
SELECT l.id, l.d, c.wm_yr_wk, c.wday, c.month, c.year, c.snap
FROM panel_long l LEFT JOIN calendar c ON l.d = c.d""",
    "panel_price_join": f"""{_PANEL}
SELECT l.id, l.day_number, c.wm_yr_wk, coalesce(p.sell_price, 0.0) AS sell_price
FROM panel_long l LEFT JOIN calendar c ON l.d = c.d LEFT JOIN prices p
ON p.store_id = l.store_id AND p.item_id = l.item_id AND p.wm_yr_wk = c.wm_yr_wk""",
    "feature_table": f"{_FEATURES} SELECT {_TABLE} FROM features",
    "feature_table_recent": f"""{_FEATURES}
SELECT {_TABLE} FROM features WHERE day_number > {_LAST} - 128""",
    "feature_table_days": f"""{_FEATURES}
        SELECT {_TABLE} FROM features
        WHERE day_number IN (5, 29, 30, 31, 365, 366, 900, 1001, 1002, 1003, 1004, 1800, 2200, 2201, 2499)""",
    "feature_table_repeated": f"""{_FEATURES},
      recent AS (SELECT {_TABLE} FROM features WHERE day_number > {_LAST} - 128)
      SELECT * FROM recent
      UNION ALL
      SELECT recent.* REPLACE (p.sell_price * 2 AS sell_price)
      FROM recent JOIN prices p USING (store_id, item_id, wm_yr_wk) WHERE wm_yr_wk % 2 = 0""",
    "max_day": f"{_PANEL} SELECT max(day_number) AS max_day FROM panel_base",
    "selected_weeks": f"""{_PANEL}
SELECT DISTINCT wm_yr_wk FROM calendar WHERE day_number > {_LAST} - 128""",
    "regression_scores": f"""{_PANEL}
SELECT round(sqrt(avg(power(sales - lag_28, 2))), 6) AS rmse,
       round(avg(abs(sales - lag_28)), 6) AS mae
FROM history""",
    "scan_rows": f"{_FEATURES} SELECT count(*) AS input_rows FROM features",
    "group_profile": f"""{_FEATURES}
SELECT store_id, cat_id, count(*) AS rows, round(avg(sales), 6) AS avg_sales
FROM features GROUP BY store_id, cat_id""",
    "group_count": f"""{_FEATURES}
SELECT count(*) AS aggregation_groups FROM (SELECT DISTINCT store_id, cat_id FROM features)""",
    "stage_time_rollup": f"""{_REPORTS}
SELECT run_id,
       round(sum(CASE WHEN stage IN ('prepare', 'train') THEN coalesce(value, 0) ELSE 0 END), 4)
         AS prepare_train_seconds,
       round(sum(CASE WHEN stage IN ('prepare', 'train', 'predict')
                      THEN coalesce(value, 0) ELSE 0 END), 4) AS prepare_train_predict_seconds
FROM latest GROUP BY run_id""",
    "stage_listing": f"""{_REPORTS}
SELECT run_id, CAST(list_position(['prepare', 'train', 'predict', 'benchmark'], stage) AS INT) AS place,
       stage, value AS duration_seconds
FROM latest WHERE stage <> 'other'""",
    "category_index": _FEATURES + " " + " UNION ALL ".join(
        f"({_indexes(c)})" for c in ("dept_id", "cat_id", "store_id", "state_id")
    ),
    "feature_vector": _vector(),
    "forest_stable": f"""{_FEATURES}
SELECT id, d, TRUE AS equal FROM features WHERE day_number > {_LAST} - 28""",
    "forest_forecast_bounds": f"""{_FEATURES}
SELECT id, d, TRUE AS inside FROM features WHERE day_number > {_LAST} - 28""",
    "forest_fit_rows": f"""{_FEATURES}, mean AS (
  SELECT avg(sales) AS mean, count(*) AS training_rows FROM features WHERE day_number <= {_LAST} - 28
)
SELECT training_rows, count(*) AS validation_rows,
       round(sqrt(avg((sales - mean) * (sales - mean))), 4) AS mean_rmse, TRUE AS forest_better
FROM features, mean WHERE day_number > {_LAST} - 28 GROUP BY training_rows""",
}
