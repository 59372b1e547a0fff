"""Adapter from the driver's `events` table to wearable-device inputs.

The SELECT lists below are the shared contract of FIXTURES.md: the very same
text runs in Spark SQL (over the parquet scan) and in DuckDB (oracle side), so
both engines see identical inputs. Everything downstream is computed by the
library from these frames; the adapters only map columns, row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import activity_name

# --- fixed values: fixture column mappings (FIXTURES.md section B) ----------
FX_RAW_SELECT = """event_id,
  CAST(1600 + user_id % 8 AS STRING) AS patient_id,
  CASE WHEN event_id % 20 = 19 THEN 'other'
       WHEN user_id % 8 = 7 THEN 'vital_monitor'
       WHEN user_id % 8 = 6 THEN 'imu_sensor'
       WHEN event_id % 20 < 9 THEN 'vital_monitor' ELSE 'imu_sensor' END AS device_type,
  CAST(1704067200 + event_id * 20 AS DOUBLE) AS epoch_s,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(25 + ((user_id % 8) * 17 + CAST(floor(event_id / 480) AS BIGINT) * 29) % 140
       + (event_id * 7919) % 60 AS DOUBLE) END AS heart_rate,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(85 + ((user_id % 8) * 3 + CAST(floor(event_id / 480) AS BIGINT) * 5) % 11
       + (event_id * 31) % 7 AS DOUBLE) END AS spo2,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 13) % 11 AS DOUBLE) END AS stress_level,
  CASE WHEN event_id % 83 = 0 THEN NULL ELSE value / 10 END AS x,
  CAST((event_id * 37) % 200 AS DOUBLE) / 10 - 10 AS y,
  CAST((event_id * 53) % 200 AS DOUBLE) / 10 - 10 AS z,
  substr('ABCDEFGHIJKLMOPQRSZ', CAST(1 + event_id % 19 AS INT), 1) AS activity_code"""

FX_WATCH_SELECT = """CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(1000 + user_id AS STRING) END AS user_id,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(30 + (event_id * 7919) % 190 AS STRING) || '.' || CAST(event_id % 1000 AS STRING) END AS heart_rate,
  CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST(88 + (event_id * 31) % 14 AS STRING) || '.' || CAST(event_id % 100 AS STRING) END AS spo2,
  CAST((event_id * 104729) % 30000 AS STRING) || '.5' AS step_count,
  CASE WHEN event_id % 41 = 0 THEN 'ERROR' WHEN event_id % 43 = 0 THEN NULL
       ELSE CAST((event_id * 17) % 15 - 1 AS STRING) || '.25' END AS sleep_duration,
  CASE event_id % 8 WHEN 0 THEN 'Active' WHEN 1 THEN 'Actve' WHEN 2 THEN 'Seddentary' WHEN 3 THEN 'Sedentary'
       WHEN 4 THEN 'Highly_Active' WHEN 5 THEN '  Highly Active ' WHEN 6 THEN NULL ELSE 'nan' END AS activity_level,
  CASE WHEN event_id % 37 = 0 THEN 'Very High' ELSE CAST((event_id * 13) % 12 AS STRING) END AS stress_level"""

FX_SENSOR_SELECT = """CASE WHEN event_id % 2 = 0 THEN 'phone' ELSE 'watch' END AS device_type,
  CASE WHEN event_id % 3 = 0 THEN 'gyroscope' ELSE 'accelerometer' END AS sensor_type,
  CAST(1600 + user_id % 51 AS STRING) || ',' || substr('ABCDEFGHIJKLMOPQRSZ', CAST(1 + event_id % 19 AS INT), 1) || ','
  || CAST(1704067200000000000 + event_id * 50000000 AS STRING) || ',' || CAST(event_id % 50 - 25 AS STRING) || '.5,'
  || CAST((event_id * 7) % 40 - 20 AS STRING) || '.25,' || CAST((event_id * 3) % 30 AS STRING) || '.125'
  || CASE WHEN event_id % 101 = 0 THEN ',extra' ELSE '' END || ';' AS line"""


# the `events` columns the adapters use; declaring them skips the footer-reading
# schema job of every scan (Parquet resolves columns by name)
EVENTS_SCHEMA = "event_id BIGINT, user_id BIGINT, value DOUBLE"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `events`, with its own time: ``ts`` as wall-clock time and
    ``epoch_s``, seconds since 1970 with micro-seconds."""
    df = spark.read.schema(EVENTS_SCHEMA + ", ts TIMESTAMP_NTZ, event_type STRING, props STRING").parquet(f"{sf_dir}/events.parquet")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return df.withColumn("epoch_s", micros / 1e6)


def _fx(spark: SparkSession, sf_dir: str, select_list: str) -> DataFrame:
    return spark.sql(f"SELECT {select_list} FROM {{events}}", events=events(spark, sf_dir))


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed device readings, one per event (FIXTURES.md `fx_raw`)."""
    return _fx(spark, sf_dir, FX_RAW_SELECT)


def fx_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty smartwatch rows, all text (FIXTURES.md `fx_watch`)."""
    return _fx(spark, sf_dir, FX_WATCH_SELECT)


def fx_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sensor file lines (FIXTURES.md `fx_sensor`)."""
    return _fx(spark, sf_dir, FX_SENSOR_SELECT)


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fx_raw` as device events: `epoch_s` becomes `timestamp`; movement rows
    carry sensor type and activity name. Readings of the other device kind
    are left in place (routing and the per-device rules ignore them); the
    landing writer drops them from the encoded events."""
    r = fx_raw(spark, sf_dir)
    mov = F.col("device_type") != F.lit("vital_monitor")
    return r.select(
        "event_id", "patient_id", "device_type",
        F.col("epoch_s").alias("timestamp"),
        "heart_rate", "spo2", "stress_level",
        F.when(mov, F.lit("accelerometer")).alias("sensor_type"),
        "activity_code",
        activity_name("activity_code").alias("activity_name"),
        "x", "y", "z",
    )


VITALS_FIELDS = ["heart_rate", "spo2", "stress_level"]
MOVEMENT_FIELDS = ["sensor_type", "activity_code", "activity_name", "x", "y", "z"]


def device_fields_only(ev: DataFrame) -> DataFrame:
    """Null the readings a device does not produce (vitals on movement rows
    and vice versa), so encoded events carry only their own fields."""
    vit = F.col("device_type") != F.lit("imu_sensor")
    mov = F.col("device_type") != F.lit("vital_monitor")
    return ev.withColumns({**{c: F.when(vit, F.col(c)) for c in VITALS_FIELDS},
                           **{c: F.when(mov, F.col(c)) for c in MOVEMENT_FIELDS}})


# --- DuckDB side: the same adapters plus the layer CTEs ---------------------
def duck_fixture_ctes() -> str:
    return (f"fx_raw AS (SELECT {FX_RAW_SELECT} FROM events),\n"
            f"fx_watch AS (SELECT {FX_WATCH_SELECT} FROM events),\n"
            f"fx_sensor AS (SELECT {FX_SENSOR_SELECT} FROM events)")
