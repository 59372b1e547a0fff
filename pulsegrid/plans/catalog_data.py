"""Registered dataset-preparation queries (smartwatch and sensor datasets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.operators import datasets as DS
from pulsegrid.operators.clean import movement_event, vitals_event
from pulsegrid.plans.catalog import W, register
from pulsegrid.plans.fixtures import fx_sensor, fx_watch
from pulsegrid.plans.layers import r6
from pulsegrid.sources.sensor import parse_sensor_lines

# DuckDB formulation of the typed and cleaned smartwatch rows.
_WATCH = """w_typed AS (SELECT TRY_CAST(user_id AS DOUBLE) AS user_id, TRY_CAST(heart_rate AS DOUBLE) AS heart_rate,
    TRY_CAST(spo2 AS DOUBLE) AS spo2, TRY_CAST(step_count AS DOUBLE) AS step_count,
    TRY_CAST(sleep_duration AS DOUBLE) AS sleep_duration, TRY_CAST(stress_level AS DOUBLE) AS stress_level,
    trim(CASE WHEN activity_level = 'nan' THEN NULL WHEN activity_level = 'Actve' THEN 'Active'
              WHEN activity_level = 'Seddentary' THEN 'Sedentary' WHEN activity_level = 'Highly_Active' THEN 'Highly Active'
              ELSE activity_level END) AS activity_level
  FROM fx_watch),
w_step AS (SELECT *, CASE WHEN user_id IS NULL THEN 1
    WHEN NOT coalesce(heart_rate BETWEEN 40 AND 200, false) THEN 5
    WHEN NOT coalesce(spo2 BETWEEN 90 AND 100, false) THEN 6
    WHEN NOT coalesce(step_count BETWEEN 0 AND 25000, false) THEN 7
    WHEN NOT coalesce(sleep_duration BETWEEN 0 AND 12, false) THEN 8
    WHEN NOT coalesce(stress_level BETWEEN 0 AND 10, false) THEN 9
    WHEN activity_level IS NULL THEN 10 ELSE 0 END AS step FROM w_typed),
w_clean AS (SELECT CAST(trunc(user_id) AS INTEGER) AS user_id, round_even(heart_rate * 100, 0) / 100 AS heart_rate,
    round_even(spo2 * 100, 0) / 100 AS spo2, CAST(round_even(step_count, 0) AS INTEGER) AS step_count,
    round_even(sleep_duration * 100, 0) / 100 AS sleep_duration, activity_level, CAST(trunc(stress_level) AS INTEGER) AS stress_level
  FROM w_step WHERE step = 0)"""


def _clean(spark, d):
    return DS.clean_smartwatch(fx_watch(spark, d))


@register("p24_clean_smartwatch", W(_WATCH) + "SELECT * FROM w_clean")
def q_clean_watch(spark, d):
    return _clean(spark, d)


@register("p21_activity_labels", W(_WATCH) + """
SELECT activity_level AS raw_label, trim(CASE activity_level WHEN 'nan' THEN NULL WHEN 'Actve' THEN 'Active'
  WHEN 'Seddentary' THEN 'Sedentary' WHEN 'Highly_Active' THEN 'Highly Active' ELSE activity_level END) AS label,
  count(*) AS n
FROM fx_watch GROUP BY 1, 2""")
def q_labels(spark, d):
    from pulsegrid.operators.clean import standardise_activity
    w = fx_watch(spark, d)
    return (w.select(F.col("activity_level").alias("raw_label"), standardise_activity(F.col("activity_level")).alias("label"))
            .groupBy("raw_label", "label").agg(F.count(F.lit(1)).alias("n")))


@register("a26_cleaning_report", W(_WATCH) + """
, steps(step, check_name) AS (VALUES (1, 'no user'), (5, 'heart rate not in 40..200'),
  (6, 'oxygen not in 90..100'), (7, 'steps not in 0..25000'),
  (8, 'sleep not in 0..12 h'), (9, 'stress not in 0..10'),
  (10, 'no activity label'), (0, 'kept'))
SELECT s.step, s.check_name, count(w.step) AS n_rows,
  round_even(CAST(count(w.step) AS DOUBLE) / (SELECT count(*) FROM w_step) * 100, 1) AS pct_of_input
FROM steps s LEFT JOIN w_step w ON w.step = s.step GROUP BY s.step, s.check_name""".replace("\n, steps", ", steps", 1))
def q_report(spark, d):
    return DS.cleaning_report(fx_watch(spark, d))


_NULL_COLS = ["user_id", "heart_rate", "spo2", "step_count", "sleep_duration", "activity_level", "stress_level"]


def _na_sql(c: str) -> str:
    from pulsegrid.sources.files import PANDAS_NA_TOKENS
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in PANDAS_NA_TOKENS)
    return f"CASE WHEN {c} IN ({toks}) THEN NULL ELSE {c} END"


@register("a22_null_profile", W() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE ({_na_sql(c)}) IS NULL) AS nulls FROM fx_watch"
    for c in _NULL_COLS))
def q_nulls(spark, d):
    """Missing values per column as the dataset is read (missing-value texts count)."""
    from pulsegrid.sources.files import na_tokens_to_null
    return DS.null_profile(na_tokens_to_null(fx_watch(spark, d)))


# the numeric columns of the cleaned dataset, user id included (a describe of
# the cleaned table covers every numeric column)
_NUM = ["user_id", "heart_rate", "spo2", "step_count", "sleep_duration", "stress_level"]


@register("a24_describe_clean", W(_WATCH) + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM w_clean""" for c in _NUM))
def q_describe(spark, d):
    return r6(DS.describe_numeric(_clean(spark, d)), "mean", "std", "p25", "p50", "p75")


@register("a23_impute_median", W(_WATCH) + """
SELECT user_id, heart_rate, coalesce(sleep_duration, (SELECT median(sleep_duration) FROM w_typed)) AS sleep_duration,
  coalesce(stress_level, (SELECT median(stress_level) FROM w_typed)) AS stress_level FROM w_typed""")
def q_impute(spark, d):
    t = DS.typed_smartwatch(fx_watch(spark, d))
    return DS.impute_median(t, ["sleep_duration", "stress_level"]).select(
        "user_id", "heart_rate", "sleep_duration", "stress_level")


@register("a25_activity_counts", W(_WATCH) + """
SELECT activity_level, count(*) AS count FROM w_clean GROUP BY activity_level ORDER BY count DESC, activity_level""")
def q_activity_counts(spark, d):
    return DS.value_counts(_clean(spark, d), "activity_level")


@register("a25_stress_counts", W(_WATCH) + """
SELECT stress_level, count(*) AS count FROM w_clean GROUP BY stress_level ORDER BY stress_level""")
def q_stress_counts(spark, d):
    return DS.value_counts(_clean(spark, d), "stress_level", by_value=True)


@register("a16_alert_distribution", W(_WATCH) + """
, t AS (SELECT count(*) AS total, count(*) FILTER (WHERE stress_level >= 8) AS a0,
    count(*) FILTER (WHERE heart_rate > 130) AS a1, count(*) FILTER (WHERE heart_rate < 40) AS a2,
    count(*) FILTER (WHERE spo2 < 90) AS a3 FROM w_clean),
d AS (SELECT 0 AS rule_order, 'HIGH_STRESS' AS alert_type, a0 AS alerts, total FROM t UNION ALL
      SELECT 1, 'TACHYCARDIA', a1, total FROM t UNION ALL SELECT 2, 'BRADYCARDIA', a2, total FROM t UNION ALL
      SELECT 3, 'HYPOXIA', a3, total FROM t)
SELECT alert_type, alerts, round_even(CAST(alerts AS DOUBLE) / total * 100, 1) AS pct,
  repeat('█', CAST(floor(CAST(alerts AS DOUBLE) / total * 100 * 2) AS INTEGER)) AS bar, total, rule_order
FROM d ORDER BY alerts DESC, rule_order""".replace("\n, t AS", ", t AS", 1))
def q_alert_dist(spark, d):
    return DS.alert_distribution(_clean(spark, d))


@register("a17_stress_breakdown", W(_WATCH) + """
SELECT l.stress_level, count(w.stress_level) AS records
FROM (VALUES (8), (9), (10)) l(stress_level) LEFT JOIN w_clean w ON w.stress_level = l.stress_level
GROUP BY l.stress_level""")
def q_stress(spark, d):
    return DS.stress_breakdown(_clean(spark, d))


@register("a18_vital_ranges", W(_WATCH) + """
SELECT min(heart_rate) AS hr_min, max(heart_rate) AS hr_max, min(spo2) AS spo2_min, max(spo2) AS spo2_max FROM w_clean""")
def q_ranges(spark, d):
    return DS.vital_ranges(_clean(spark, d))


@register("p13_vitals_event", W(_WATCH) + """
SELECT CAST(CAST(trunc(user_id) AS BIGINT) AS VARCHAR) AS patient_id, 'vital_monitor' AS device_type,
  CAST(trunc(heart_rate) AS DOUBLE) AS heart_rate, CAST(trunc(spo2) AS DOUBLE) AS spo2,
  CAST(trunc(step_count) AS DOUBLE) AS step_count, sleep_duration, activity_level,
  CAST(trunc(stress_level) AS DOUBLE) AS stress_level FROM w_clean""")
def q_vitals_event(spark, d):
    return vitals_event(_clean(spark, d)).drop("timestamp")


# --- sensor dataset -------------------------------------------------------------
_SENSOR = """s_parsed AS (SELECT device_type, sensor_type, f,
    CAST(TRY_CAST(f[1] AS DOUBLE) AS BIGINT) AS subject_id, trim(f[2]) AS activity_code,
    CAST(TRY_CAST(f[3] AS DOUBLE) AS BIGINT) AS timestamp, TRY_CAST(f[4] AS DOUBLE) AS x,
    TRY_CAST(f[5] AS DOUBLE) AS y, TRY_CAST(f[6] AS DOUBLE) AS z
  FROM (SELECT device_type, sensor_type, string_split(rtrim(line, ';'), ',') AS f FROM fx_sensor WHERE trim(line) <> '')
  WHERE len(f) <= 6)"""

def _names_case(col: str) -> str:
    from pulsegrid import schemas as S
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.ACTIVITY_NAMES.items()) + " END"


@register("s09_sensor_lines", W(_SENSOR) + f"""
SELECT device_type, sensor_type, subject_id, activity_code, timestamp, x, y, z, {_names_case('activity_code')} AS activity_name
FROM s_parsed""")
def q_sensor_lines(spark, d):
    return parse_sensor_lines(fx_sensor(spark, d))


@register("a19_sensor_statistics", W(_SENSOR) + """
SELECT device_type, sensor_type, count(*) AS total_readings, count(DISTINCT subject_id) AS unique_subjects,
  count(DISTINCT activity_code) AS unique_activities,
  CAST(min(subject_id) AS VARCHAR) || ' - ' || CAST(max(subject_id) AS VARCHAR) AS subject_range,
  round(avg(x), 6) AS x_mean, round(avg(y), 6) AS y_mean, round(avg(z), 6) AS z_mean,
  device_type || '_' || sensor_type AS dataset
FROM s_parsed GROUP BY device_type, sensor_type""")
def q_sensor_stats(spark, d):
    return r6(DS.sensor_statistics(parse_sensor_lines(fx_sensor(spark, d))), "x_mean", "y_mean", "z_mean")


@register("p14_movement_event", W(_SENSOR) + f"""
SELECT CAST(subject_id AS VARCHAR) AS patient_id, 'imu_sensor' AS device_type, 'accelerometer' AS sensor_type,
  CAST(timestamp AS DOUBLE) / 1e9 AS timestamp, activity_code, {_names_case('activity_code')} AS activity_name,
  x, y, z, round_even(sqrt(x * x + y * y + z * z), 4) AS svm
FROM s_parsed WHERE sensor_type = 'accelerometer'""")
def q_movement_event(spark, d):
    return movement_event(parse_sensor_lines(fx_sensor(spark, d)))


@register("o08_head_records", W(_SENSOR) + """
SELECT device_type, sensor_type, subject_id, activity_code, timestamp, x, y, z FROM s_parsed
ORDER BY timestamp, device_type, sensor_type LIMIT 100""")
def q_head(spark, d):
    p = parse_sensor_lines(fx_sensor(spark, d)).drop("activity_name")
    return DS.head_records(p, 100, ["timestamp", "device_type", "sensor_type"])


@register("p25_activity_names", W(_SENSOR) + f"""
SELECT activity_code, {_names_case('activity_code')} AS activity_name, count(*) AS readings FROM s_parsed GROUP BY 1, 2""")
def q_names(spark, d):
    p = parse_sensor_lines(fx_sensor(spark, d))
    return p.groupBy("activity_code", "activity_name").agg(F.count(F.lit(1)).alias("readings"))


from pulsegrid.plans import catalog_storage  # noqa: E402,F401  (registers storage queries)
