"""Medallion layers over the fixture adapter, Spark side and DuckDB side.

`silver`/`gold` build the layers from the driver's tables with the library
operators; `DUCK_LAYERS` is the independent DuckDB formulation used only by
the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import utc_wall
from pulsegrid.operators.clean import clean_movement, clean_vitals, route
from pulsegrid.operators.gold import gold_movement, gold_vitals
from pulsegrid.plans.fixtures import duck_fixture_ctes, fx_events


def silver_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_vitals(route(fx_events(spark, sf_dir))[0])


def silver_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_movement(route(fx_events(spark, sf_dir))[1])


def gold_v(spark: SparkSession, sf_dir: str, minutes: int = 10) -> DataFrame:
    return gold_vitals(silver_v(spark, sf_dir), minutes)


def gold_m(spark: SparkSession, sf_dir: str, minutes: int = 10) -> DataFrame:
    return gold_movement(silver_m(spark, sf_dir), minutes=minutes)


def silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = fx_events(spark, sf_dir)
    v, m, _ = route(ev)
    return clean_vitals(v), clean_movement(m)


def gold(spark: SparkSession, sf_dir: str, minutes: int = 10) -> tuple[DataFrame, DataFrame]:
    sv, sm = silver(spark, sf_dir)
    return gold_vitals(sv, minutes), gold_movement(sm, minutes=minutes)


def wall(df: DataFrame, *cols: str) -> DataFrame:
    """Present instants as UTC wall-clock TIMESTAMP_NTZ (zone independent)."""
    return df.withColumns({c: utc_wall(c) for c in cols if c in df.columns})


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round non-exact means to 6 places so engines with another summation
    order agree."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def _duck_gold_v(minutes: int) -> str:
    return f"""(SELECT patient_id, window_start, window_start + INTERVAL {minutes} MINUTE AS window_end,
      avg_hr, peak_hr, avg_spo2, peak_spo2, mews_hr_score, mews_spo2_score,
      mews_hr_score + mews_spo2_score AS mews_score
    FROM (SELECT *,
        CASE WHEN avg_hr > 130 THEN 3 WHEN avg_hr >= 111 THEN 2 WHEN avg_hr >= 101 THEN 1
             WHEN avg_hr >= 51 THEN 0 WHEN avg_hr >= 41 THEN 1 ELSE 2 END AS mews_hr_score,
        CASE WHEN avg_spo2 < 90 THEN 3 WHEN avg_spo2 < 93 THEN 2 WHEN avg_spo2 < 95 THEN 1 ELSE 0 END AS mews_spo2_score
      FROM (SELECT patient_id, time_bucket(INTERVAL {minutes} MINUTE, event_timestamp) AS window_start,
              avg(heart_rate) AS avg_hr, max(heart_rate) AS peak_hr, avg(spo2) AS avg_spo2, max(spo2) AS peak_spo2
            FROM fx_silver_v GROUP BY 1, 2) g0) g1)"""


def _duck_gold_m(minutes: int, thr: float = 25.0) -> str:
    return f"""(SELECT patient_id, time_bucket(INTERVAL {minutes} MINUTE, event_timestamp) AS window_start,
      time_bucket(INTERVAL {minutes} MINUTE, event_timestamp) + INTERVAL {minutes} MINUTE AS window_end,
      avg(svm) AS avg_activity, max(svm) AS peak_impact,
      CAST(sum(CASE WHEN svm > {thr} THEN 1 ELSE 0 END) AS BIGINT) AS fall_events_detected
    FROM fx_silver_m GROUP BY 1, 2, 3)"""


DUCK_SILVER = """fx_silver_v AS (SELECT *, make_timestamp(CAST(epoch_s * 1000000 AS BIGINT)) AS event_timestamp
  FROM fx_raw WHERE device_type = 'vital_monitor' AND heart_rate IS NOT NULL AND heart_rate BETWEEN 30 AND 220
   AND spo2 IS NOT NULL AND spo2 BETWEEN 90 AND 100),
fx_silver_m AS (SELECT *, make_timestamp(CAST(epoch_s * 1000000 AS BIGINT)) AS event_timestamp,
   sqrt(x * x + y * y + z * z) AS svm
  FROM fx_raw WHERE device_type = 'imu_sensor' AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL)"""


def duck_with(*extra: str, minutes: int = 10) -> str:
    """`WITH` clause of every oracle: fixtures, Silver and Gold CTEs."""
    ctes = [duck_fixture_ctes(), DUCK_SILVER,
            f"fx_gold_v AS {_duck_gold_v(minutes)}", f"fx_gold_m AS {_duck_gold_m(minutes)}", *extra]
    return "WITH " + ",\n".join(ctes) + "\n"
